"""What keeps the jobs' disk, shuffles and broadcasts small, and that their rows stay the same."""

import glob
import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerlight import fixtures as fx
from ledgerlight import registry as reg
from ledgerlight.operators import slices as S
from ledgerlight.plans import feeds, jobs
from ledgerlight.session import checkpoint_dir, scratch_path
from ledgerlight.sources import landing as L


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _local(spark, path):
    return path.removeprefix("file:")


def test_a_job_leaves_only_its_table_and_lanes(spark, small_dir):
    fx.register(spark, small_dir)
    base = scratch_path(spark, "test-left")
    sheets = L.write_sheets(spark.table("fx_in_paid_search"), f"{base}/sheets", feeds.PAID_SEARCH_HEADER)
    before = set(glob.glob(f"{_local(spark, checkpoint_dir(spark))}/scratch/*"))
    jobs.run_job(spark, "paid_search", sheets, f"{base}/table", f"{base}/refused", reg._initiatives(spark), reg.RUN_STAMP, "month")
    left = set(glob.glob(f"{_local(spark, checkpoint_dir(spark))}/scratch/*")) - before
    assert all(p.rsplit("/", 1)[-1].startswith("initiatives-") for p in left)
    rows, named = feeds.paid_search_load(spark.table("fx_in_paid_search").toDF(*feeds.PAID_SEARCH_HEADER), fail_on_bad_name=False)
    assert S.read_table(spark, f"{base}/table").count() == rows.count() > 0
    assert spark.read.text(f"{base}/refused/names").count() == named.count() > 0


def test_large_parts_are_not_broadcast(spark, small_dir, monkeypatch):
    monkeypatch.setattr(fx, "PART_BROADCAST", 0, raising=False)
    fx._registered.clear()
    try:
        fx.register(spark, small_dir)
        for view in ("fx_product_sales", "fx_embed_games", "fx_game_activity"):
            joins = [line for line in _plan(spark.table(view)).splitlines() if "Join" in line and "l_partkey" in line]
            assert joins and all("SortMergeJoin" in line for line in joins)
    finally:
        fx._registered.clear()


def test_a_small_lookup_is_known_by_its_stored_size(spark):
    pairs = spark.createDataFrame([("u1", "a"), ("U1", "b"), ("u2", "c"), (None, "d"), ("u3", None)], "URL string, INICIATIVA string")
    lookup = S.store_initiatives(spark, pairs, scratch_path(spark, "test-lookup"))
    target = spark.createDataFrame([("U2", "old"), ("U3", "old"), (None, "old"), ("U9", "old")], "NOM_URL string, NOM_INICIATIVA string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")                               # as if the table behind the lookup were large
    try:
        assert lookup.small and "SortMergeJoin" not in _plan(S.update_initiative(target, lookup))
        got = {r.NOM_URL: r.NOM_INICIATIVA for r in S.update_initiative(target, lookup).collect()}
        with pytest.raises(Exception, match="at most one source row"):
            S.update_initiative(spark.createDataFrame([("U1", "old")], target.schema), lookup).collect()
    finally:
        spark.conf.set(key, before)
    assert got == {"U2": "C", "U3": None, None: "old", "U9": "old"}


def test_clustered_rows_are_written_without_a_shuffle(spark):
    days = spark.range(0, 4000, 1, 8).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).cast("string").alias("Day"), "id")
    odd = days.withColumn("Day", F.when(F.col("id") % 1000 == 1, "no date").when(F.col("id") % 1000 == 2, "20200105").otherwise(F.col("Day")))
    rows = S.clustered_by_period(odd, "Day", S.MONTH)
    assert rows.columns == odd.columns and sorted(rows.collect()) == sorted(odd.collect())
    dated = S.clustered_by_period(days, "Day", S.MONTH).select(F.col("Day").cast("date").alias(S.DATE_COL), F.lit("X").alias(S.SOURCE_COL), "id")
    table = scratch_path(spark, "test-clustered")
    S.append_rows(dated, table, S.MONTH, clustered=True)
    assert S.read_table(spark, table).count() == 4000
    for month in glob.glob(f"{_local(spark, table)}/*/PERIODO=*"):
        assert len(glob.glob(f"{month}/*.parquet")) == 1
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_report_pages_hold_the_same_documents(spark):
    rows = spark.createDataFrame([("a\"b\\\n,", None, 1.5, 2), (None, "ü", None, None)], "d1 string, d2 string, m1 double, m2 long").coalesce(1)
    path = L.write_analytics_reports(rows, scratch_path(spark, "test-pages"), ["d1", "d2"], ["m1", "m2"])
    (file,) = glob.glob(f"{_local(spark, path)}/*.txt.gz")
    with gzip.open(file, "rt", encoding="utf-8") as f:
        (doc,) = [json.loads(line) for line in f]
    assert doc == {"reports": [{
        "columnHeader": {"dimensions": ["ga:d1", "ga:d2"], "metricHeader": {"metricHeaderEntries": [{"name": "ga:m1"}, {"name": "ga:m2"}]}},
        "data": {"rows": [{"dimensions": ["a\"b\\\n,", None], "metrics": [{"values": ["1.5", "2"]}]},
                          {"dimensions": [None, "ü"], "metrics": [{"values": [None, None]}]}]}}]}
