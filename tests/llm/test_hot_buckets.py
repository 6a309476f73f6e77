"""Buckets of very many fingerprints are dealt over more tasks and lose no link."""

import random

import numpy as np
import pytest

from ledgerlight.llm import graph, simhash


def family(seed, n):
    """Distinct fingerprints around four centres that share 40 bits, so they meet in the same buckets."""
    rng = random.Random(seed)
    head, out = rng.getrandbits(40) << 24, set()
    centres = [head | rng.getrandbits(24) for _ in range(4)]
    while len(out) < n:
        out.add(rng.choice(centres) ^ sum(1 << b for b in set(rng.choices(range(24), k=rng.randrange(7)))))
    return sorted(out)


def components_of(spark, fps, **how):
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    root = {r.node: r.root for r in graph.components(spark, simhash.links(df, **how)).collect()}
    return [root.get(v, v) for v in signed]


@pytest.mark.parametrize("max_bits,blocks", [(3, 6), (2, 4)])
def test_dealt_buckets_give_the_same_components(spark, max_bits, blocks):
    fps = family(3, 300) + [random.Random(8).getrandbits(64), 0]
    as_one = components_of(spark, fps, max_bits=max_bits, blocks=blocks)
    dealt = components_of(spark, fps, max_bits=max_bits, blocks=blocks, hot=2, share=1)
    assert as_one == dealt
    links = {(i, j) for i, x in enumerate(fps) for j, y in enumerate(fps[:i]) if (x ^ y).bit_count() <= max_bits}
    assert all(as_one[i] == as_one[j] for i, j in links) and len(set(as_one)) > 1


def test_only_large_buckets_count_as_hot(spark):
    signed = np.array(family(5, 400), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(0, 7, v) for v in signed] + [(1, 7, v) for v in signed[:9]], "c int, key long, fp long")
    assert [tuple(r) for r in simhash.hot_buckets(df, hot=100, share=1).collect()] == [(0, 7)]
    assert [tuple(r) for r in simhash.hot_buckets(df, hot=100, share=8).collect()] == [(0, 7)]
    assert simhash.hot_buckets(df.limit(0), hot=1, share=1).count() == 0


def test_pieces_are_the_bits_outside_the_blocks():
    for mask in simhash._masks(6, 3):
        pieces = simhash._pieces(mask, 4)
        assert sum(p & (2**64 - 1) for p in pieces) == ~mask & (2**64 - 1)
