"""Merkle manifest against a plain tree, with small blocks so that the exchange takes several rounds, and its edge rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlight.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    fields = [row[0], row[1], row[2], row[3], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, i):
    path = []
    for level in tree[:-1]:
        run = level[i // 8 * 8:i // 8 * 8 + 8]
        path.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        i //= 8
    return path


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    """The contract, read literally."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees, places = {}, {}
    for lang in langs:
        mine = sorted((r[0] is not None, r[0] or 0, leaf_of(r, r[4]), k) for k, r in enumerate(rows) if r[2] == lang)
        trees[lang] = levels([m[2] for m in mine])
        places.update({m[3]: i for i, m in enumerate(mine)})
    top = levels([trees[lang][-1][0] for lang in langs]) if langs else None
    out = []
    for k, r in enumerate(rows):
        path = siblings(trees[r[2]], places[k]) + siblings(top, langs.index(r[2]))
        digest = leaf_of(r, r[4])
        if r[4] is not None and zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0:
            digest = leaf_of(r, lowered(r[4]))
        for before, after in path:
            digest = sha(before + digest + after)
        root = top[-1][0]
        out.append((r[0], leaf_of(r, r[4]), trees[r[2]][-1][0], root, sha("".join(a + b for a, b in path)), digest, digest == root))
    return out


def awkward(n):
    langs = ["en"] * 6 + ["de", "fr", None, ""] + [f"l{i}" for i in range(9)]
    rows = [(i * 7 % 5003, "s" if i % 3 else None, langs[i * 31 % len(langs)], i if i % 5 else None, f"Text Éa {i % 11}" * (i % 4)) for i in range(n)]
    return rows + rows[3:4] * 5 + [(None, None, None, None, None)] * 3 + [(9, "a", "zz", 1, "ONE"), (10, "a", "en", 2, "W" * 300_000), (10, "b", "en", 2, "")]


def result(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("local, n", [(1, 700), (2, 700), (4, 700), (1, 9)])
def test_manifest_is_the_plain_tree(spark, local, n):
    rows = awkward(n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("leaf", F.lit(1)).withColumn("pos", F.lit(1)).withColumn("tree", F.lit("x"))
    assert result(manifest.manifest(spark, df, local)) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("size", [*range(1, 20), 63, 64, 65, 120, 513, 520])
def test_every_tree_size(spark, size):
    """Blocks of 8 leaves: short last runs and last subtrees at every level."""
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(size)]
    assert result(manifest.manifest(spark, spark.createDataFrame(rows, SCHEMA), 1)) == sorted(plain(rows), key=str)


def test_only_tampered_leaves_with_capitals_fail(spark):
    rows = [(i, "s", "en", 1, "Abc" if i % 2 else "abc") for i in range(400)]
    got = {r.doc_id: r.verified for r in manifest.manifest(spark, spark.createDataFrame(rows, SCHEMA), 1).collect()}
    assert got == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 3 == 0) for i in range(400)}


def test_empty_table(spark):
    out = manifest.manifest(spark, spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
