"""SimHash near-duplicates with pigeonhole blocks (operator 8).

Fingerprints are 64 majority bits over the XXH64 (seed 42) hashes of word
shingles. Two fingerprints that differ in at most ``max_bits`` bits agree on
at least ``blocks - max_bits`` of the ``blocks`` blocks, so joining on every
such choice of blocks finds every close pair; the Hamming distance is verified
before a link is made. Copies share one fingerprint and are linked once per
fingerprint, never pair by pair; a bucket returns a spanning forest of its
links (same components, at most one edge a member), not its pairs.

A bucket of very many distinct fingerprints is dealt over many tasks: the bits
outside its blocks are cut into ``max_bits + 1`` pieces, one of which a close
pair shares, and the fingerprints meet again by piece. A sample of the
fingerprints tells which buckets are that large; it decides where the work
runs, never which links are found.

Defined results: null or blank text has fingerprint 0 and is linked like any
other; fewer words than a shingle make one shingle of all words; repeated rows
each get a row; a null doc_id takes part but is never a component id unless
all ids of the component are null. Very long texts are hashed whole; a bit set
in exactly half the hashes is 0; of rows that share the smallest id one stays;
an empty table gives an empty result; extra columns are carried or not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER_BYTES, small_batches, stored, text_of
from .graph import components

CHUNK = 1 << 16
HOT = 1 << 17       # distinct fingerprints of a bucket from which on it is dealt over more tasks
SHARE = 64          # one in so many fingerprints is looked at to find such buckets


def fingerprint(text: str, k: int = 3) -> int:
    """The 64-bit SimHash of one whole text."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - k + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(k, len(words)) - 1:].tolist()
    h64, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, CHUNK):
        h = np.array([h64(joined[s:e], 42) for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_udf(k: int = 3):
    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t or "", k) for t in texts.to_pylist()], np.uint64).view(np.int64))
    return simhash


def _masks(blocks: int, same: int) -> list[int]:
    """Bit masks (as signed longs) of every choice of ``same`` of ``blocks`` blocks."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]
    return [int(np.array([sum(c)], np.uint64).view(np.int64)[0]) for c in combinations(block, same)]


def _pieces(mask: int, n: int) -> list[int]:
    """The bits outside ``mask`` cut into n masks (as signed longs)."""
    rest = np.array([b for b in range(64) if not mask >> b & 1])
    return [int(np.array([sum(1 << int(b) for b in part)], np.uint64).view(np.int64)[0]) for part in np.array_split(rest, n)]


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Breadth-first search over the links among fps: at most len(fps) - 1 edges, same components."""
    out, left = [], fps
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            out += [(int(x), int(y)) for y in left[near]]
            front += list(left[near])
            left = left[~near]
    return out


def _links(fps: np.ndarray, max_bits: int, small: int = 2048, depth: int = 0) -> list[tuple[int, int]]:
    """Links of one bucket; a large bucket is cut again by pigeonhole over the bits in which it varies."""
    bits = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(fps ^ fps[0]).reshape(1).view(np.uint8), bitorder="little"))
    if len(fps) <= small or depth == 3 or len(bits) <= max_bits + 1:
        return _forest(fps, max_bits)
    out = []
    for part in np.array_split(bits, max_bits + 1):
        key = fps & np.uint64(sum(1 << int(b) for b in part))
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for group in np.split(fps[order], cuts):
            if len(group) > 1:
                out += _links(group, max_bits, small, depth + 1)
    return out


def _bucket_links(max_bits: int):
    """mapInArrow over (c, key, fp) rows sorted by bucket: the verified links of each bucket."""
    def emit(c, key, fp):
        new = np.concatenate(([True], (np.diff(c) != 0) | (np.diff(key) != 0)))
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(c)))
        two = at[size == 2]
        x, y = fp[two], fp[two + 1]
        ok = np.bitwise_count(x ^ y) <= max_bits
        a, b = [x[ok]], [y[ok]]
        for s, n in zip(at[size > 2].tolist(), size[size > 2].tolist()):
            if links := _links(fp[s:s + n], max_bits):
                e = np.array(links, np.uint64)
                a.append(e[:, 0])
                b.append(e[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        last = None
        for batch in batches:
            c, key, fp = (batch.column(i).to_numpy() for i in range(3))
            if not len(c):
                continue
            cut = 0
            if last is not None and (c[-1], key[-1]) == last:
                parts.append((c, key, fp))      # the whole batch may still belong to the open bucket
                if (c[0], key[0]) == last:
                    continue
                c, key, fp = (np.concatenate(v) for v in zip(*parts))
            else:
                parts.append((c, key, fp))
                c, key, fp = (np.concatenate(v) for v in zip(*parts))
            last = (c[-1], key[-1])
            cut = len(c) - int(np.argmin(((c == last[0]) & (key == last[1]))[::-1])) if not ((c == last[0]) & (key == last[1])).all() else 0
            if cut:
                yield emit(c[:cut], key[:cut], fp[:cut].view(np.uint64))
            parts = [(c[cut:], key[cut:], fp[cut:])]
        if parts:
            c, key, fp = (np.concatenate(v) for v in zip(*parts))
            yield emit(c, key, fp.view(np.uint64))
    return run


def hot_buckets(keyed: DataFrame, hot: int = HOT, share: int = SHARE) -> DataFrame:
    """(c, key) of the buckets of (c, key, fp) rows with about ``hot`` fingerprints or more, by one fingerprint in ``share``."""
    some = keyed.filter(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0)
    return some.groupBy("c", "key").agg(F.count("*").alias("n")).filter(F.col("n") * share >= hot).select("c", "key")


def links(fps: DataFrame, max_bits: int = 3, blocks: int = 6, hot: int = HOT, share: int = SHARE) -> DataFrame:
    """(a, b) links between the distinct fingerprints of ``fps`` (one long column fp); connects what the distance connects."""
    masks = _masks(blocks, blocks - max_bits)
    keyed = fps.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("c", "key"), "fp")
    large = stored(fps.sparkSession, hot_buckets(keyed, hot, share), "hot-buckets")      # a stored table has a size, by which Spark picks the join
    pieces = F.array(*[F.array(*map(F.lit, _pieces(m, max_bits + 1))) for m in masks])
    by_piece = F.transform(F.get(pieces, F.col("c")), lambda m, i: F.struct(i.alias("piece"), F.col("fp").bitwiseAND(m).alias("sub")))
    whole = F.array(F.struct(F.lit(-1).alias("piece"), F.lit(0).cast("long").alias("sub")))
    dealt = (keyed.join(large.withColumn("large", F.lit(True)), ["c", "key"], "left")
             .select("c", "key", "fp", F.explode(F.when(F.col("large"), by_piece).otherwise(whole)).alias("p")))
    # the sub-bucket is one more part of the key: a hash of all four keeps the rows narrow, as a clash only makes a bucket larger
    bucket = F.when(F.col("p.piece") < 0, F.col("key")).otherwise(F.xxhash64("key", "p.piece", "p.sub"))
    return (dealt.select("c", bucket.alias("key"), "fp").repartition("c", "key").sortWithinPartitions("c", "key")
            .mapInArrow(_bucket_links(max_bits), "a long, b long"))


def _groups(spark: SparkSession, fps: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(rid, doc_id, fp, grp, component_id) of ``fps``, a stored table with (rid, doc_id, fp)."""
    each = stored(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fps")
    comp = components(spark, links(each.select("fp"), max_bits, blocks))
    member = each.join(comp, each.fp == comp.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("grp"))
    low = member.groupBy("grp").agg(F.min("low").alias("component_id"))
    return fps.join(member.select("fp", "grp").join(low, "grp"), "fp").select("rid", "doc_id", "fp", "grp", "component_id")


def simhash_groups(spark: SparkSession, docs: DataFrame, k: int = 3, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """One row per row of ``docs``: (rid, doc_id, fp, grp, component_id).

    rid numbers the rows within this result; another scan of ``docs`` may number them otherwise.
    grp is the component's smallest fingerprint.
    """
    small_batches(spark)
    fps = stored(spark, docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"),
                                    fingerprint_udf(k)(text_of()).alias("fp")), "simhash")
    return _groups(spark, fps, max_bits, blocks)


def keep_one(spark: SparkSession, docs: DataFrame, k: int = 3, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id, of repeated ids the first row (null ids last).

    The rows are stored with their numbers in one scan, so that number and row belong together however later scans are split.
    """
    small_batches(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = stored(spark, docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"), row.alias("d"),
                                     fingerprint_udf(k)(text_of()).alias("fp")), "simhash-docs")
    g = _groups(spark, rows.select("rid", "doc_id", "fp"), max_bits, blocks)
    keep = g.groupBy("grp").agg(F.min_by("rid", F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("rid"))
    return rows.join(keep.select("rid"), "rid", "left_semi").select("d.*")
