"""Rows keep their numbers when the scan that stores them and the last one are split differently."""

import random
from collections import Counter

import pytest

from ledgerlight.llm import mixing, simhash

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def many_files(spark, tmp_path):
    """240 rows in 12 files of growing rows: 60 texts, each four times, in two sources."""
    words = [" ".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=60)) for i in range(60)]
    rows = [(i, f"s{i % 2}", words[i % 60]) for i in range(240)]
    for n in range(12):
        spark.createDataFrame(rows[n * 20:n * 20 + 20], "doc_id long, source string, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    yield spark.read.parquet(str(tmp_path / "docs"))
    spark.conf.unset(SPLIT)


def split_otherwise(spark, out):
    """The rows of ``out``, its remaining scans cut into far more partitions than those before."""
    spark.conf.set(SPLIT, "256")
    return out.collect()


def test_one_of_each_group_stays_when_scans_are_split_differently(spark, many_files):
    got = split_otherwise(spark, simhash.keep_one(spark, many_files))
    assert sorted(r.doc_id for r in got) == list(range(60))


def test_the_drawn_rows_are_those_returned_when_scans_are_split_differently(spark, many_files):
    want = Counter({r.doc_id: r.copies for r in mixing.mix(spark, many_files).collect() if r.copies})
    got = split_otherwise(spark, mixing.mixed_documents(spark, many_files))
    assert Counter({r.doc_id: r.mix_copies for r in got}) == want and len(got) == len(want)
