"""Quality classifier: random Fourier features, ridge scores, isotonic calibration (operator 1).

Each whole text becomes a vector of document statistics. Cosines of random
projections approximate a Gaussian kernel over them; every partition sums its
part of the normal equations, Spark adds the parts, and the driver solves one
system of fixed size. Scores of rows outside each fold are calibrated by an
isotonic fit over a fixed grid of score bins.

Defined results: a null text counts as empty and is scored; labels that are
null are no labels; several labels of one id are averaged; a null id never
trains; without any label every score is 0.5. All labelled rows are used.
Very long texts are read whole, by their statistics; repeated rows each get a
row and train as often as they occur; equal statistics get equal scores; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_crc, small_batches, stored, text_of, utf8_buffer

#: Byte classes whose shares describe a text.
CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c", b"\n\r",
           b".,;:", b"!?", b"|", b"#$%&*@^~+=<>/\\_`", b"'\"()[]{}-", bytes(range(128, 256))]
FOLDS = 5
N_FEATURES = 192
RIDGE = 3.0
WIDTH = 2.5
BINS = 2000


def _class_table() -> np.ndarray:
    t = np.full(256, len(CLASSES), np.int64)
    for i, c in enumerate(CLASSES):
        t[list(c)] = i
    return t


def statistics(texts: pa.Array) -> np.ndarray:
    """Document statistics, one row per text: sizes, word shape, byte-class shares, repetition."""
    raw, off = utf8_buffer(texts)
    n, k = len(off) - 1, len(CLASSES) + 1
    size = np.diff(off)
    cls = _class_table()[raw]
    doc = np.repeat(np.arange(n), size)
    share = np.bincount(doc * k + cls, minlength=n * k).reshape(n, k) / np.maximum(size, 1)[:, None]
    words, distinct = np.zeros(n), np.zeros(n)
    for i, t in enumerate(texts.to_pylist()):
        w = t.split()
        words[i], distinct[i] = len(w), len(set(w))
    per = np.maximum(words, 1)
    return np.column_stack([np.log1p(size), np.log1p(words), np.log1p(size / per), distinct / per, np.sqrt(share[:, :-1])])


@F.arrow_udf(T.ArrayType(T.FloatType()))
def statistics_udf(texts: pa.Array) -> pa.Array:
    x = statistics(texts).astype(np.float32)
    flat = pa.array(x.ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), flat)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


@dataclass
class Model:
    """Standardisation, projection, ridge weights of all folds and calibration knots."""
    mean: np.ndarray
    std: np.ndarray
    w: np.ndarray
    b: np.ndarray
    coef: np.ndarray
    by_fold: dict
    knots: tuple

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -4, 4)
        return np.column_stack([np.cos(z @ self.w + self.b), np.ones(len(x))])

    def score(self) -> Column:
        """score column from a ``stats`` column."""
        m = self

        @F.arrow_udf(T.DoubleType())
        def score(stats: pa.Array) -> pa.Array:
            if not len(stats):
                return pa.array([], pa.float64())
            return pa.array(np.interp(m.lift(_matrix(stats)) @ m.coef, *m.knots))
        return score("stats")


def _partial_sums(model: Model):
    """mapInArrow: one partition's part of the normal equations of [features, label], per fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z = np.column_stack([model.lift(_matrix(batch.column(0))), batch.column(1).to_numpy()])
            fold = batch.column(2).to_numpy()
            for f in np.unique(fold):
                part = z[fold == f]
                sums[int(f)] = sums.get(int(f), 0) + part.T @ part
        for f, a in sums.items():
            i, j = np.triu_indices(len(a))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), f, np.int32)), pa.array(i.astype(np.int32)),
                                              pa.array(j.astype(np.int32)), pa.array(a[i, j])], ["fold", "i", "j", "v"])
    return run


def _solve(a: np.ndarray) -> np.ndarray:
    g = a[:-1, :-1].copy()
    g[np.arange(len(g) - 1), np.arange(len(g) - 1)] += RIDGE
    return np.linalg.solve(g + 1e-6 * np.eye(len(g)), a[:-1, -1])


def isotonic(x: np.ndarray, n: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins x with n rows and pos positives: knots of a non-decreasing map."""
    blocks: list[list[float]] = []
    for xi, ni, pi in zip(x, n, pos):
        blocks.append([xi * ni, ni, pi])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 1], b[:, 2] / b[:, 1]


def fit(train: DataFrame, seed: int = 7) -> Model | None:
    """Fit from rows (stats, y, fold in 1..4); None if there are none."""
    x = [F.col("stats")[i].cast("double") for i in range(len(CLASSES) + 4)]
    r = train.agg(F.count("*"), *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x]).first()
    if not r[0]:
        return None
    d = len(x)
    rng = np.random.default_rng(seed)
    model = Model(np.array(r[1:d + 1]), np.maximum(np.array(r[d + 1:]), 1e-3), rng.normal(size=(d, N_FEATURES)) / WIDTH,
                  rng.uniform(0, 2 * np.pi, N_FEATURES), np.zeros(N_FEATURES + 1), {}, (np.array([0.0]), np.array([0.5])))
    cells = (train.select("stats", F.col("y").cast("double"), F.col("fold").cast("int"))
             .mapInArrow(_partial_sums(model), "fold int, i int, j int, v double")
             .groupBy("fold", "i", "j").agg(F.sum("v").alias("v")).collect())   # fixed size: folds x features^2 / 2
    k = N_FEATURES + 2
    sums = {f: np.zeros((k, k)) for f in range(1, FOLDS)}
    for f, i, j, v in cells:
        sums[f][i, j] = sums[f][j, i] = v
    total = sum(sums.values())
    model.coef = _solve(total)
    model.by_fold = {f: _solve(total - s) for f, s in sums.items()}
    m = model

    @F.arrow_udf(T.IntegerType())
    def out_of_fold_bin(stats: pa.Array, fold: pa.Array) -> pa.Array:
        if not len(stats):
            return pa.array([], pa.int32())
        z, f = m.lift(_matrix(stats)), fold.to_numpy(zero_copy_only=False)
        raw = np.zeros(len(f))
        for g in np.unique(f):
            raw[f == g] = z[f == g] @ m.by_fold[int(g)]
        return pa.array(((np.clip(raw, -0.5, 1.5) + 0.5) * (BINS / 2)).astype(np.int32))

    bins = sorted(train.groupBy(out_of_fold_bin("stats", F.col("fold").cast("int")).alias("bin"))
                  .agg(F.count("*").alias("n"), F.sum("y").alias("pos")).collect())      # at most BINS + 1 rows
    model.knots = isotonic(np.array([b[0] * 2 / BINS - 0.5 for b in bins]), np.array([float(b[1]) for b in bins]),
                           np.array([float(b[2]) for b in bins]))
    return model


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: labelled documents outside the held-out fold 0."""
    y = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("y"))
    return (stats.join(y, "doc_id").withColumn("fold", F.pmod(id_crc(), F.lit(FOLDS)).cast("int"))
            .filter("fold <> 0").select("stats", "y", "fold"))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    small_batches(spark)
    stats = stored(spark, docs.select("doc_id", statistics_udf(text_of()).alias("stats")), "quality-stats")
    model = fit(labelled(stats, labels))
    score = model.score() if model else F.lit(0.5)
    return (stats.select("doc_id", (F.pmod(id_crc(), F.lit(FOLDS)) == 0).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay as they are."""
    small_batches(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    stats = stored(spark, docs.select("doc_id", statistics_udf(text_of()).alias("stats")), "quality-stats")
    model = fit(labelled(stats, labels))
    if not model:
        return docs
    return (docs.select(row.alias("d"), statistics_udf(text_of()).alias("stats"))
            .withColumn("s", model.score()).filter(F.col("s") >= threshold).select("d.*"))
