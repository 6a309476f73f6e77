"""Mixing sources to target weights by cube-method balanced sampling (operator 10).

Each source has a target in words; the ratio target / source size gives every
document a whole number of copies and a fractional inclusion probability. The
cube method moves those probabilities along the null space of the balancing
constraints (documents and words), three units at a time, until at most two of
a cell stay fractional. Sources are cut into cells of bounded size; what stays
fractional meets in further rounds, and the last round lands the final units
on the rounding with the smallest word error; a few swaps of a taken for an
untaken document of that last cell then bring its words to their goal.

Defined results: a null text has size 0; a null source is a source, sorted
last; very long texts are counted whole; repeated rows are drawn separately, equal ones
apart by number; extra columns are carried or not read; an empty table or one without words
takes nothing. Draws depend on the rows and the seed alone, so reruns agree; only
where an id (or null) repeats for over a quarter of a cell, on the order of rows too.
"""

from __future__ import annotations

import random
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, stored, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
CELL = 4_000
EPS = 1e-9


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, size) rows.

    Water level: sources are ordered by cap / weight. Stopping those before a
    source at their caps leaves a level for the rest, which rises while the
    caps passed lie below it and falls afterwards; its peak is where no cap is
    exceeded any more.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())          # over one row per source
    pick = F.array(*[F.lit(float(w)) for w in weights])
    by = by.withColumn("w", F.get(pick, ((F.row_number().over(order) - 1) % len(weights))))
    by = by.withColumn("cap", most * F.col("source_size").cast("double"))
    rising = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    after = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    goal = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    by = by.withColumn("level", (goal - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    by = by.withColumn("level", F.max("level").over(Window.partitionBy()))
    return by.select("source", "source_size", "n_docs", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def _flight(p: list[float], x: list[float], rng: random.Random) -> list[int]:
    """Flight phase in place over units in order; the indexes that stay fractional (at most two)."""
    active: list[int] = []
    for nxt in range(len(p)):
        if EPS < p[nxt] < 1 - EPS:
            active.append(nxt)
        while len(active) == 3:
            i, j, k = active
            u = (x[j] - x[k], x[k] - x[i], x[i] - x[j])           # null space of (1, x)
            if u[0] == u[1] == u[2] == 0:
                u = (1.0, -1.0, 0.0)
            up = min((1 - p[a]) / v if v > 0 else p[a] / -v for a, v in zip(active, u) if v)
            down = min((1 - p[a]) / -v if v < 0 else p[a] / v for a, v in zip(active, u) if v)
            step = up if rng.random() * (up + down) < down else -down
            for a, v in zip(active, u):
                p[a] += step * v
                if p[a] < EPS or p[a] > 1 - EPS:
                    p[a] = float(round(p[a]))
            active = [a for a in active if 0 < p[a] < 1]
    return active


def _land(p: list[float], x: list[float], left: list[int]) -> None:
    """Round the last units so that words, then documents, come nearest to what they stood for."""
    words, docs = sum(p[i] * x[i] for i in left), sum(p[i] for i in left)
    best = min(product((0.0, 1.0), repeat=len(left)),
               key=lambda c: (abs(sum(v * x[i] for v, i in zip(c, left)) - words), abs(sum(c) - docs), c))
    for i, v in zip(left, best):
        p[i] = v


def _exchange(p: list[float], x: list[float], error: float, rounds: int = 4) -> None:
    """Swap a taken for an untaken unit while that brings the words of a landed cell nearer to their goal."""
    p_, x_ = np.array(p), np.array(x)
    for _ in range(rounds):
        inside, outside = np.flatnonzero(p_ == 1), np.flatnonzero(p_ == 0)
        if not len(inside) or not len(outside):
            break
        outside = outside[np.argsort(x_[outside], kind="stable")]
        want = x_[inside] - error                       # the size that would cancel the error
        at = np.searchsorted(x_[outside], want)
        near = np.stack([np.clip(at - 1, 0, len(outside) - 1), np.clip(at, 0, len(outside) - 1)])
        gap = np.abs(x_[outside][near] - want)
        side, i = np.unravel_index(np.argmin(gap), gap.shape)
        if gap[side, i] >= abs(error):
            break
        out, into = inside[i], outside[near[side, i]]
        error += x_[into] - x_[out]
        p_[out], p_[into] = 0.0, 1.0
    p[:] = p_.tolist()


def _cell(land: bool, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "h", "doc_id", "rid"], ascending=[False, True, True, True], kind="stable")
        p, x = rows["p"].tolist(), rows["size"].astype(float).tolist()
        first = rows.iloc[0]
        words = sum(a * b for a, b in zip(p, x))
        left = _flight(p, x, random.Random(f"{seed}|{first['source']}|{first['cell']}|{first['round']}"))
        if land:
            _land(p, x, left)
            _exchange(p, x, sum(a * b for a, b in zip(p, x)) - words)
        return rows.assign(p=p)[["rid", "doc_id", "source", "size", "h", "p"]]
    return run


def _numbered(docs: DataFrame, *more: Column) -> DataFrame:
    """(rid, doc_id, source, size, *more) of every row of ``docs``."""
    return docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"), *more)


def mix(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """(rid, doc_id, size, source_size, target, copies, taken) for every row of ``docs``; rid numbers the rows within this result."""
    return _draw(spark, stored(spark, _numbered(docs), "mix-sizes"), **how)


def _draw(spark: SparkSession, rows: DataFrame, seed: int = 17, cell: int = CELL, share: float = SHARE,
          most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """The mix of ``rows``, a stored table with (rid, doc_id, source, size)."""
    goal = stored(spark, targets(rows, share, most, weights), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # ids (and null) with a good part of a cell's rows: their rows are dealt by row number too, so no cell grows with an id
    often = stored(spark, rows.groupBy("source", "doc_id").agg(F.count("*").alias("n")).filter(F.col("n") > cell // 4)
                   .select("source", "doc_id", F.lit(True).alias("often")), "mix-repeated")
    r = rows.alias("r").join(goal.alias("g"), F.expr("r.source <=> g.source")).join(
        often.alias("o"), F.expr("r.source <=> o.source and r.doc_id <=> o.doc_id"), "left").select(
        "rid", "r.doc_id", "r.source", "size", "source_size", "n_docs", "target", F.floor(ratio).cast("int").alias("whole"),
        (ratio - F.floor(ratio)).alias("p"), F.when(F.col("often"), F.xxhash64("r.doc_id", "rid")).otherwise(F.xxhash64("r.doc_id")).alias("h"))
    most_docs = goal.agg(F.max("n_docs")).first()[0] or 0
    cells = F.ceil(F.col("n_docs") / cell)
    open_ = r.filter(f"p > {EPS}").select("rid", "doc_id", "source", "size", "h", "p", F.pmod("h", cells).cast("long").alias("cell"))
    done, level, per = [], 0, max(1, -(-most_docs // cell))
    while True:
        last = per == 1
        flown = stored(spark, open_.withColumn("round", F.lit(level)).groupBy("source", "cell").applyInPandas(
            _cell(last, seed), "rid long, doc_id long, source string, size long, h long, p double"), "mix-round")
        done.append(flown.filter("p >= 1").select("rid"))
        if last:
            break
        # at most two units a cell are left: the next round's cells hold the units of cell / 2 cells of this one
        per, level = -(-2 * per // cell), level + 1
        open_ = flown.filter("p > 0 and p < 1").withColumn("cell", F.pmod("h", F.lit(per)).cast("long"))
    picked = done[0]
    for d in done[1:]:
        picked = picked.unionByName(d)
    return (r.join(picked.withColumn("pick", F.lit(1)), "rid", "left")
            .withColumn("copies", (F.col("whole") + F.coalesce("pick", F.lit(0))).cast("long"))
            .select("rid", "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """``docs`` rows that the mix takes, each once with a ``mix_copies`` column behind its own columns.

    The rows are stored with their numbers in one scan, so that number and row belong together however later scans are split.
    """
    rows = stored(spark, _numbered(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")), "mix-docs")
    m = _draw(spark, rows.select("rid", "doc_id", "source", "size"), **how).filter("copies > 0").select("rid", "copies")
    return rows.select("rid", "d").join(m, "rid").select("d.*", F.col("copies").alias("mix_copies"))
