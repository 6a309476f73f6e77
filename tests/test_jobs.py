"""Feed jobs from landed file to table, their lanes, and the high-water mark as a bound."""

import pytest
from pyspark.sql import functions as F

from ledgerlight import fixtures as fx
from ledgerlight import registry as reg
from ledgerlight.operators import slices as S
from ledgerlight.plans import feeds, jobs
from ledgerlight.session import scratch_path
from ledgerlight.sources import landing as L
from ledgerlight.sources import readers as R


def _count(spark, path):
    return spark.read.text(path).count()


def test_a_job_keeps_what_it_refuses(spark, small_dir):
    fx.register(spark, small_dir)
    base = scratch_path(spark, "test-job")
    path = reg._torn_records(spark, f"{base}/landed")
    social = spark.table("fx_in_social")
    for _ in range(2):                                                   # a rerun changes nothing
        jobs.run_job(spark, "social", path, f"{base}/table", f"{base}/refused", run_ts=reg.RUN_STAMP, unit="month")
        rows, named = feeds.social_load(social, fail_on_bad_name=False)
        assert S.read_table(spark, f"{base}/table").count() == rows.count() > 0
        assert _count(spark, f"{base}/refused/lines") == social.filter("impressions = 13").count() > 0
        assert _count(spark, f"{base}/refused/names") == named.count() > 0


def test_a_job_replaces_only_its_disciplines(spark, small_dir):
    fx.register(spark, small_dir)
    base = scratch_path(spark, "test-disciplines")
    sheet = L.write_sheets(spark.table("fx_in_paid_search"), f"{base}/sheet", feeds.PAID_SEARCH_HEADER)
    social = L.write_records(spark.table("fx_in_social"), f"{base}/social")
    for feed, path in (("social", social), ("paid_search", sheet), ("paid_search", sheet)):
        jobs.run_job(spark, feed, path, f"{base}/table", f"{base}/refused/{feed}", unit="month")
    counts = {r.NOM_DISCIPLINA: r["count"] for r in S.read_table(spark, f"{base}/table").groupBy("NOM_DISCIPLINA").count().collect()}
    rows = feeds.paid_search_load(spark.table("fx_in_paid_search").toDF(*feeds.PAID_SEARCH_HEADER), fail_on_bad_name=False)[0]
    want = {r.NOM_DISCIPLINA: r["count"] for r in rows.groupBy("NOM_DISCIPLINA").count().collect()}
    assert set(want) <= set(jobs.PAID_SEARCH_DISCIPLINES) and want.items() <= counts.items() and counts["FACEBOOK"] > 0


def test_the_mark_prunes_the_landed_folders(spark, small_dir):
    fx.register(spark, small_dir)
    base = scratch_path(spark, "test-mark")
    report = reg._search_ads_report(spark)
    path = L.write_csv_parts(report.withColumn("landed", F.trunc(F.col("Day").cast("date"), "month")), f"{base}/extracts", by="landed")
    first = feeds.search_ads_load(report.filter("Day < '1998-03-20'"))
    feeds.run_load(spark, first, f"{base}/table", "ADWORDS", mode="append", unit="month")
    mark = jobs.mark_of(spark, f"{base}/table", "ADWORDS")
    landed = R.multi_csv_lanes(spark, path, report.columns, "Day", only=F.col("landed") >= F.trunc(mark, "month"))
    rows = landed.rows.collect()
    assert min(r.Day for r in rows) == "1998-03-01" and len(rows) == report.filter("Day >= '1998-03-01'").count()
    tree = landed.rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landed" in tree and "landed#" in tree and "ubquery" in tree.split("PartitionFilters")[1].split("PushedFilters")[0]
    jobs.run_job(spark, "search_ads", path, f"{base}/table", f"{base}/refused", unit="month", since=("landed", "Day"))
    assert S.read_table(spark, f"{base}/table").count() == report.count()
    empty = jobs.mark_of(spark, f"{base}/none", "ADWORDS")
    assert spark.range(1).select(empty.cast("string")).first()[0] == "1900-01-01"


@pytest.mark.parametrize("size", ["700b", "128m"])
def test_sheets_of_several_splits(spark, tmp_path, size):
    """Line numbers run on over the splits of a file; blank lines at the end are no footer."""
    lines = {"a.txt": ["head"] * 4 + [f"{i},{'x' * (i % 40)}" for i in range(300)] + ["foot"] * 2, "b.txt": ["head"] * 4 + ["7,seven"] + ["foot"] * 2 + [""] * 3,
             "short.txt": ["head", "head"], "empty.txt": []}
    for name, text in lines.items():
        (tmp_path / name).write_bytes("\r\n".join(text).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        numbered = R.numbered_lines(spark, str(tmp_path))
        splits = spark.read.text(str(tmp_path)).select("_metadata.file_name", "_metadata.file_block_start").distinct().count()
        assert (splits > 6) == (size == "700b")
        got = sorted((r.n, r.t or "") for r in R.read_trimmed(spark, str(tmp_path), 4, 2, reg._T.StructType.fromDDL("n int, t string")).collect())
        assert got == sorted([(i, "x" * (i % 40)) for i in range(300)] + [(7, "seven")])
        assert {r.file_name: r.c for r in numbered.groupBy("file_name").agg(F.max("line_count").alias("c")).collect()} == {"a.txt": 306, "b.txt": 7, "short.txt": 2}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
