"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    ``edges``: two long columns a, b, any direction, repeats and loops allowed.
    Each round writes its edges to the shared folder, so a lost executor never
    replays earlier rounds. Rounds grow with the logarithm of the longest chain.
    Raises if the edges still change after ``max_rounds``.
    """
    cur = stored(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "edges")
    state = _state(cur)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        nxt = stored(spark, small, "edges")
        last, state = state, _state(nxt)
        cur = nxt
        if state == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
