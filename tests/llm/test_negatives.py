"""Hard-negative mining against brute force, over several cells and tiles, and its edge rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=50):
    own = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) or abs(256 * x) >= 1 << 24 for x in v):
            continue
        own.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for k, (i, v, label) in enumerate(own):
        if i % every:
            continue
        near = sorted((-sum(a * b for a, b in zip(v, w)), j, m, x) for x, (j, w, m) in enumerate(own) if x != k and len(w) == len(v))
        for s, j, _, _ in [n for n in near if n[2] == label][:5]:
            fits = [n for n in near if n[2] != label and 50 * -s <= 100 * -n[0] <= 95 * -s][:3]
            out += [(i, j, r, n[1], -s, -n[0]) for r, n in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("cell", F.lit(1)).withColumn("score", F.lit(1)).withColumn("rid", F.lit(1))
    return sorted(tuple(r) for r in negatives.mine(spark, df, **kw).collect())


def vectors(rng, n, labels, dim=6):
    return [(i, [float(np.float32(rng.gauss(0.1, 0.3))) for _ in range(dim)], rng.choice(labels)) for i in range(n)]


@pytest.mark.parametrize("labels", [list(range(10)), [0] * 8 + [1], [3]], ids=["even", "hot label", "one label"])
def test_negatives_are_those_of_brute_force(spark, monkeypatch, labels):
    monkeypatch.setattr(negatives, "_cells", lambda rows: 5)
    monkeypatch.setattr(negatives, "TILE", 64 * 16)          # tiles of 16 rows and 64 anchors
    rows = vectors(random.Random(1), 900, labels)
    got = mined(spark, rows, every=10)
    assert got == plain(rows, 10) and (len(got) > 50 or labels == [3])


def test_ties_go_to_the_smaller_id(spark, monkeypatch):
    monkeypatch.setattr(negatives, "_cells", lambda rows: 4)
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 1.0, 1.4]), rng.choice([1.0, 2.0])], rng.randrange(3)) for i in range(400)]
    rng.shuffle(rows)
    assert mined(spark, rows) == plain(rows)


def test_rows_that_take_no_part_and_odd_vectors(spark):
    nan, inf, rng = float("nan"), float("inf"), random.Random(3)
    rows = vectors(rng, 160, [0, 1, 2], 3)
    rows += [(None, [1.0, 1.0, 1.0], 1), (201, None, 1), (202, [1.0, None, 1.0], 1), (203, [nan, 1.0, 1.0], 0), (204, [inf, 1.0, 1.0], 0), (205, [1.0, 1.0, 1.0], None),
             (206, [70000.0, 0.0, 0.0], 1), (250, [1.0, 1.0], 1), (251, [1.0, 2.0], 1), (252, [1.0, 1.2], 0), (300, [], 4), (302, [], 4), (303, [], 5)]
    rows += [rows[50], rows[50], rows[3], (100, [0.5, 0.5, 0.5], 2), (-50, [0.4, 0.4, 0.4], 2), (350, [0.0, 0.0, 0.0], 9)]
    got = mined(spark, rows)
    assert got == plain(rows)
    assert [g for g in got if g[0] == 300] == [(300, 302, 1, 303, 0, 0)]


def test_scores_beyond_doubles_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.uniform(30_000, 65_000))) for _ in range(200)], rng.randrange(2)) for i in range(120)]
    assert mined(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert negatives.mine(spark, spark.createDataFrame([], SCHEMA)).count() == 0
