"""Hard-negative mining over a secondary-sort shuffle (operator 12).

Every anchor is scored against every row, in blocks: rows are dealt into cells
of a bounded size and the anchors, a fixed share of the rows, visit each cell.
A cell keeps of an anchor's scores only those that can be in the answer, so
pair scores are cut down before they are shuffled:

1. the best POSITIVES rows of the anchor's label; a window over the cells'
   bests gives the anchor's positives and so its score windows;
2. in a second visit, per score window the best NEGATIVES rows of other labels.

Positives and negatives then go through one secondary-sort shuffle: dealt by
anchor and sorted within the partition by (anchor, descending score, positives
first, id). A streaming iterator reads the sorted rows: a positive opens its
window, a negative is emitted for every open window it falls into that is not
full. It holds the open windows of one anchor, never the anchor's rows.

No step groups by label, so a label of a third of all rows is no hot key.

Defined results: rows with a null id, label or vector, with a null or
non-finite component, or with a component of LARGEST / 256 and more in size
(their scores might leave 64 bits) take no part. Repeated rows and rows that
share an id are rows of their own: each is an anchor, positive or negative by
itself. Vectors of different length have no score and never pair, empty ones
score 0. Ties go to the smaller id. An anchor without positives, and a positive without negatives in its window, has
no row; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, stored

POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95        # a negative's score in percent of the positive's
SCALE = 256
LARGEST = 1 << 24               # size of a scaled component from which a row takes no part
CELL_MB = 64                    # component bytes of a cell at most
LEAST_CELL_MB, SPREAD = 1, 64   # smaller tables: cells of at least so much, up to so many
TILE = 1 << 21                  # scores computed at once
FLOAT_EXACT, INT_EXACT = 1 << 53, 1 << 63

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_PAIRS = "anchor long, anchor_id long, positive boolean, score long, row_id long"


def _rows(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """Stored (rid, vec_id, label, vec, dim) of the rows that take part, components scaled and floored."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < LARGEST))
    label = F.col("label").cast("long")
    rows = (vectors.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull()).filter(fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                    F.transform(scaled, lambda x: x.cast("int")).alias("vec")))
    return stored(spark, rows.select(F.monotonically_increasing_id().alias("rid"), "*", F.size("vec").alias("dim")), "negatives-rows")


def _cells(rows: DataFrame) -> int:
    """Number of cells: in proportion to the bytes of all vectors, spread over some tasks where they are few."""
    size = 4 * (rows.agg(F.sum("dim")).first()[0] or 0)
    return max(1, -(-size // (CELL_MB << 20)), min(SPREAD, -(-size // (LEAST_CELL_MB << 20))))


def _vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length: places in the batch and the matrix of vectors."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = np.asarray(column.offsets)
    flat, sizes = np.asarray(column.values), np.diff(off)
    dims, out = np.unique(sizes), {}
    if len(dims) == 1:
        return {int(dims[0]): (np.arange(len(sizes)), flat[off[0]:off[-1]].reshape(len(sizes), dims[0]))}
    for dim in dims:
        at = np.flatnonzero(sizes == dim)
        out[int(dim)] = at, flat[(off[at][:, None] + np.arange(dim)[None, :])].reshape(len(at), dim)
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: as doubles where all partial sums are below 2^53, else as 64-bit integers."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < FLOAT_EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if top >= INT_EXACT:
        raise ValueError(f"scores of vectors with {a.shape[1]} components may leave 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def _best(score: np.ndarray, fits: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(anchor, row) places of the k best fitting scores per anchor; of equals the earlier row, so the smaller id."""
    low = -np.inf if score.dtype.kind == "f" else np.iinfo(np.int64).min
    left = np.where(fits, score, low)
    every = np.arange(len(left))
    for _ in range(min(k, left.shape[1])):
        at = left.argmax(axis=1)
        some = np.flatnonzero(left[every, at] != low)
        if not len(some):
            return
        yield some, at[some]
        left[some, at[some]] = low


def _visit(rows: DataFrame, anchors: DataFrame, cells: int, choose) -> DataFrame:
    """Pairs that ``choose`` picks of (anchors x rows), cell by cell.

    Anchors have the columns of ``rows`` and an array ``wins`` of positive scores. A task reads a cell's rows, then the anchors as a stream.
    """
    columns = ["cell", "anchor", "rid", "vec_id", "label", "vec", "wins"]
    dealt = rows.select(F.pmod(F.xxhash64("rid"), F.lit(cells)).cast("int").alias("cell"), F.lit(False).alias("anchor"), "rid", "vec_id", "label", "vec",
                        F.array().cast("array<long>").alias("wins"))
    visits = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), F.lit(True).alias("anchor"), "rid", "vec_id", "label", "vec", "wins")
    both = dealt.unionByName(visits).select(columns).repartition(cells, "cell").sortWithinPartitions("cell", "anchor", "vec_id", "rid")
    arrow = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("positive", pa.bool_()), ("score", pa.int64()), ("row_id", pa.int64())])

    def scan(batches):
        cell, parts, table = None, [], {}
        for b in batches:
            kinds = np.stack([np.asarray(b.column(0)), np.asarray(b.column(1)).astype(np.int32)], 1)
            edges = [0, *(np.flatnonzero((kinds[1:] != kinds[:-1]).any(axis=1)) + 1).tolist(), len(kinds)]
            for lo, hi in zip(edges, edges[1:]):
                part = b.slice(lo, hi - lo)
                here, is_anchor = kinds[lo].tolist()
                if here != cell:
                    cell, parts, table = here, [], {}
                if not is_anchor:
                    parts.append(part)
                    continue
                if parts:
                    table, parts = _table(pa.Table.from_batches(parts)), []
                yield from _meet(part, table, choose, arrow)

    return both.mapInArrow(scan, _PAIRS)


def _table(rows: pa.Table) -> dict:
    """The rows of a cell by vector length: (ids, numbers, labels, vectors), ids ascending."""
    rid, ids, labels = (np.asarray(rows.column(c)) for c in ("rid", "vec_id", "label"))
    return {dim: (ids[at], rid[at], labels[at], m) for dim, (at, m) in _vectors(rows.column("vec")).items()}


def _meet(anchors: pa.RecordBatch, table: dict, choose, arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    rid, ids, labels = (np.asarray(anchors.column(c)) for c in (2, 3, 4))
    wins = anchors.column(6).to_pylist()
    for dim, (at, mine) in _vectors(anchors.column(5)).items():
        if dim not in table:
            continue
        row_ids, row_rid, row_labels, matrix = table[dim]
        step = max(1, TILE // 64)
        for r in range(0, len(matrix), step):
            tile = matrix[r:r + step]
            many = max(1, TILE // len(tile))
            for a in range(0, len(at), many):
                some = at[a:a + many]
                score = _scores(mine[a:a + many], tile)
                same = labels[some][:, None] == row_labels[None, r:r + step]
                own = rid[some][:, None] == row_rid[None, r:r + step]
                x, y, positive = choose(score, same, own, [wins[i] for i in some])
                if len(x):
                    picked = some[x]
                    yield pa.RecordBatch.from_arrays([pa.array(rid[picked]), pa.array(ids[picked]), pa.array(np.full(len(x), positive)),
                                                      pa.array(score[x, y].astype(np.int64)), pa.array(row_ids[r + y])], schema=arrow)


def _join(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Places of several searches, each once."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.stack([np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])], 1), axis=0)
    return both[:, 0], both[:, 1]


def _choose_positives(k: int):
    def choose(score, same, own, wins):
        return *_join(list(_best(score, same & ~own, k))), True
    return choose


def _bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest score of a window: low * score <= 100 * x <= high * score."""
    return -(-low * score // 100), high * score // 100


def _choose_negatives(k: int, low: int, high: int):
    def choose(score, same, own, wins):
        found, kind = [], score.dtype.type
        for j in range(max(map(len, wins), default=0)):
            # An anchor with fewer windows gets one that is empty.
            pair = [_bounds(w[j], low, high) if j < len(w) else (1, 0) for w in wins]
            lo, hi = (np.array([p[i] for p in pair], kind)[:, None] for i in (0, 1))
            found += list(_best(score, ~same & (score >= lo) & (score <= hi), k))
        return *_join(found), False
    return choose


def mine(spark: SparkSession, vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOWEST, high: int = HIGHEST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, the rows with vec_id divisible by ``every``."""
    small_batches(spark, rows=4096, mb=8)
    rows = _rows(spark, vectors)
    cells = _cells(rows)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    none = F.array().cast("array<long>")
    local = _visit(rows, anchors.withColumn("wins", none), cells, _choose_positives(positives))
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "row_id")
    best = stored(spark, local.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives).drop("place"), "negatives-positives")
    opened = best.groupBy(F.col("anchor").alias("rid")).agg(F.sort_array(F.collect_set("score")).alias("wins"))     # at most ``positives`` scores
    pairs = best.unionByName(_visit(rows, anchors.join(opened, "rid"), cells, _choose_negatives(negatives, low, high)))
    packed = (pairs.select("anchor", (-F.col("score")).alias("down"), (~F.col("positive")).alias("after"), "row_id", "anchor_id")
              .repartition("anchor").sortWithinPartitions("anchor", "down", "after", "row_id"))
    arrow = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                       ("positive_score", pa.int64()), ("negative_score", pa.int64())])

    def emit(batches):
        anchor, windows = None, []
        for b in batches:
            out = []
            for who, down, after, row_id, anchor_id in zip(*(b.column(i).to_pylist() for i in range(5))):
                if who != anchor:
                    anchor, windows = who, []
                score = -down
                if not after:
                    windows.append([row_id, score, 0, *_bounds(score, low, high)])
                    continue
                for w in windows:
                    if w[2] < negatives and w[3] <= score <= w[4]:
                        w[2] += 1
                        out.append((anchor_id, w[0], w[2], row_id, w[1], score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return packed.mapInArrow(emit, RESULT)
