"""Merkle dataset manifest with a butterfly exchange (operator 11).

Each row of ``documents`` is a leaf; per lang the leaves, ascending by doc_id,
form a tree of fanout 8, and the trees' roots, by lang, form the top tree.

1. Leaf digests are computed beside the scan; only ids and digests go on. One
   range shuffle orders them and a prefix sum over partitions gives each its
   position in its tree.
2. Aligned runs of 8^LOCAL leaves are blocks, one row each: the partitions of
   the exchange. A block hashes its own subtree.
3. Butterfly: in round r blocks that agree in all base-8 digits of their number
   but digit r meet in a group of at most 8, swap their subtree roots, and each
   hashes the common ancestor itself. After log8(blocks) rounds every block
   holds the root and the siblings of all its ancestors; nothing is passed
   down. Where the last subtree is short, its blocks send to several groups.
4. Each block finishes its leaves: siblings inside the block, then the
   block's upper siblings; proof digest, folded root, verdict.

A third of all rows in one lang, under one doc_id or all alike is spread: the
order ends with the row number, blocks have a fixed size, and a group of the
exchange never has more than 8 members and their senders.

Defined results: a null column is ``-`` in its leaf; a null lang is a tree of
its own, the first; a null doc_id comes first in its tree, counts as empty text
in the choice of tampered rows (its crc32 is 0, which 3 divides) and is kept;
rows that share a doc_id are ordered by leaf digest, rows alike in all columns
have equal leaves and proofs of their own places; very long texts are hashed whole. An empty text is
``0:``, a lone leaf is its subroot and its proof the digest of nothing; an empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, id_crc, small_batches, stored

FANOUT = 8
LOCAL = 4                   # levels inside a block: 4096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIBLINGS = "array<struct<before:string,after:string>>"      # per level, the digests of a run before and after one's own


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    """Hex SHA-256 of a row's fields, each with its length."""
    return F.sha2(F.concat(*[_field(columns[c]) for c in FIELDS]).cast("binary"), 256)


# ---------------------------------------------------------------- positions
def positions(spark: SparkSession, rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """Stored rows with ``pos`` (from 0) in their tree by ``order``, and ``n``, the size of the tree.

    A range shuffle, then a prefix sum of (partition, tree) counts: no task sees a whole tree.
    """
    ordered = (rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
               .withColumn("at", F.monotonically_increasing_id()))
    ordered = stored(spark, ordered, name)
    part = F.shiftright("at", 33)
    runs = ordered.groupBy(tree, part.alias("part")).agg(F.count("*").alias("here"), F.min("at").alias("start"))
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(tree, "part", "start", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("offset"),
                       F.sum("here").over(Window.partitionBy(tree)).alias("n"))
    return (ordered.withColumn("part", part).join(runs, [tree, "part"])
            .withColumn("pos", F.col("at") - F.col("start") + F.col("offset")).drop("part", "at", "start", "offset"))


# ---------------------------------------------------------------- the exchange
def _pow(k: int) -> Column:
    return F.lit(FANOUT ** k).cast("long")


def butterfly(spark: SparkSession, nodes: DataFrame, rounds_of: int, name: str) -> DataFrame:
    """(tree, p, digest, path) of ``nodes`` (tree, p, m, digest, path): digest is the tree's root, path has the siblings of all levels.

    ``p`` is a node's number from 0, ``m`` the tree's number of nodes, ``rounds_of`` the largest of them.
    """
    cur, r = nodes.select("tree", "p", "m", "digest", "path"), 0
    while FANOUT ** r < rounds_of:
        width = _pow(r)
        s = cur.select("*", F.expr(f"p div {FANOUT ** r}").alias("node"), F.expr(f"(m + {FANOUT ** r - 1}) div {FANOUT ** r}").alias("nodes"))
        low = F.col("p") % width
        members = F.least(width, F.col("m") - F.col("node") * width)         # blocks of the node; fewer in the last one
        # A block of a short last node stands in for the blocks its node lacks.
        sent = s.filter("nodes > 1").select(
            "tree", F.expr(f"node div {FANOUT}").alias("parent"), F.explode(F.sequence(low, width - 1, members)).alias("group"),
            "node", "digest", low.alias("low"), "p", "m", "path")
        own = F.when(F.col("group") == F.col("low"), F.struct("node", "p", "m", "path"))
        met = sent.groupBy("tree", "parent", "group").agg(
            F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("run"), F.collect_list(own).alias("holders"))   # at most 8
        up = F.sha2(F.concat_ws("", F.col("run.digest")).cast("binary"), 256)
        held = met.select("tree", "run", up.alias("digest"), F.inline("holders"))
        side = lambda keep: F.concat_ws("", F.transform(F.filter("run", keep), lambda x: x["digest"]))
        step = F.struct(side(lambda x: x["node"] < F.col("node")).alias("before"), side(lambda x: x["node"] > F.col("node")).alias("after"))
        swapped = held.select("tree", "p", "m", "digest", F.concat("path", F.array(step)).alias("path"))
        done = s.filter("nodes = 1").select("tree", "p", "m", "digest", "path")
        cur, r = stored(spark, swapped.unionByName(done), f"{name}-{r}"), r + 1
    return cur.select("tree", "p", "digest", "path")


def _most(df: DataFrame, column: str) -> int:
    return df.agg(F.max(column)).first()[0] or 0


# ---------------------------------------------------------------- blocks
def _levels(digests: list[str], n: int, local: int) -> list[list[str]]:
    """Levels of a block's subtree, leaves first: ``local`` hashes up, fewer where the whole tree of n leaves ends before."""
    levels, size = [digests], n
    for _ in range(local):
        if size <= 1:
            break
        last = levels[-1]
        levels.append([hashlib.sha256("".join(last[i:i + FANOUT]).encode()).hexdigest() for i in range(0, len(last), FANOUT)])
        size = -(-size // FANOUT)
    return levels


def _hex(digest: bytes, count: int) -> list[str]:
    text = digest.hex()
    return [text[i * 64:i * 64 + 64] for i in range(count)]


def _block_roots(local: int):
    def roots(batches):
        for b in batches:
            out = [_levels(_hex(d, len(d) // 32), n, local)[-1][0] for d, n in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(out, pa.string())], ["lang_key", "block", "n", "digest"])
    return roots


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a digest and the siblings of its path give."""
    for before, after in path:
        digest = hashlib.sha256((before + digest + after).encode()).hexdigest()
    return digest


def _finish(local: int, batch_rows: int = 4096):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def finish(batches):
        for b in batches:
            for row in b.to_pylist():
                leaves = _hex(row["digests"], len(row["digests"]) // 32)
                levels = _levels(leaves, row["n"], local)
                upper = [(s["before"], s["after"]) for s in row["path"]]
                tail = "".join(x + y for x, y in upper)
                # Per node of each level: the siblings of its run, and all siblings from there up.
                sides, above = [], [tail] * len(levels[-1])
                for level in reversed(levels[:-1]):
                    runs = [level[i:i + FANOUT] for i in range(0, len(level), FANOUT)]
                    side = [("".join(run[:k]), "".join(run[k + 1:])) for run in runs for k in range(len(run))]
                    above = [x + y + above[i // FANOUT] for i, (x, y) in enumerate(side)]
                    sides.insert(0, side)
                out = []
                for i, (doc_id, good, bad) in enumerate(zip(row["ids"], leaves, row["tampered"])):
                    path, k = [], i
                    for side in sides:
                        path.append(side[k])
                        k //= FANOUT
                    folded = fold(bad or good, path + upper)
                    out.append((doc_id, good, row["subroot"], row["root"], hashlib.sha256(above[i].encode()).hexdigest(), folded, folded == row["root"]))
                for i in range(0, len(out), batch_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + batch_rows]), [pa.int64()] + [pa.string()] * 5 + [pa.bool_()])], names)
    return finish


def manifest(spark: SparkSession, docs: DataFrame, local: int = LOCAL) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    ``folded_root`` starts at the leaf of the row's text with A-Z lowered where 3 divides crc32(doc_id), else at the leaf itself.
    """
    own = {c: F.col(f"`{c}`") for c in FIELDS}
    lowered = {**own, "text": ascii_lower(own["text"].cast("string"))}
    tampered = F.when((id_crc() % 3 == 0) & F.col("text").isNotNull(), leaf(lowered))
    leaves = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("lang_key"),      # a null lang first
                         F.unhex(leaf(own)).alias("leaf"), tampered.alias("tampered"))
    leaves = stored(spark, leaves, "merkle-leaves")
    placed = positions(spark, leaves, "lang_key", ["doc_id", "leaf", "rid"], "merkle-order")
    size = FANOUT ** local
    one = F.struct("pos", "doc_id", "leaf", "tampered")
    blocks = placed.groupBy("lang_key", F.expr(f"pos div {size}").alias("block"), "n").agg(F.array_sort(F.collect_list(one)).alias("of"))    # at most ``size``
    blocks = stored(spark, blocks.select("lang_key", "block", "n", F.unhex(F.concat_ws("", F.transform("of", lambda x: F.hex(x["leaf"])))).alias("digests"),
                                         F.col("of.doc_id").alias("ids"), F.col("of.tampered").alias("tampered")), "merkle-blocks")
    small_batches(spark, rows=64, mb=16)
    roots = blocks.select("lang_key", "block", "digests", "n").mapInArrow(_block_roots(local), "lang_key string, block long, n long, digest string")
    nodes = stored(spark, roots.select(F.col("lang_key").alias("tree"), F.col("block").alias("p"), F.expr(f"(n + {size - 1}) div {size}").alias("m"), "digest",
                                       F.array().cast(SIBLINGS).alias("path")), "merkle-roots")
    within = butterfly(spark, nodes, _most(nodes, "m"), "merkle-exchange")

    tops = within.filter("p = 0").select(F.lit("").alias("tree"), F.col("tree").alias("lang_key"), "digest")
    tops = stored(spark, positions(spark, tops, "tree", ["lang_key"], "merkle-tops"), "merkle-top-nodes")
    top = butterfly(spark, tops.select("tree", F.col("pos").alias("p"), F.col("n").alias("m"), "digest", F.array().cast(SIBLINGS).alias("path")),
                    _most(tops, "n"), "merkle-top-exchange")
    top = (top.select(F.col("p").alias("pos"), F.col("digest").alias("root"), F.col("path").alias("top_path"))
           .join(tops.select("pos", "lang_key", F.col("digest").alias("subroot")), "pos").drop("pos"))
    proofs = (within.select(F.col("tree").alias("lang_key"), F.col("p").alias("block"), F.col("path"))
              .join(top, "lang_key").select("lang_key", "block", "subroot", "root", F.concat("path", "top_path").alias("path")))
    full = blocks.join(proofs, ["lang_key", "block"]).select("n", "digests", "ids", "tampered", "subroot", "root", "path")
    return full.mapInArrow(_finish(local), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
