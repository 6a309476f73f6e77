"""Slice maintenance: metamorphic properties of the reload."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlight import fixtures as fx
from ledgerlight import registry as reg
from ledgerlight.operators import slices as S
from ledgerlight.plans import feeds
from ledgerlight.session import scratch_path


def _rows(spark, small_dir):
    fx.register(spark, small_dir)
    return feeds.search_ads_rows(reg._search_ads_report(spark))


def _sorted(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_null_discipline_inside_span_is_kept(spark):
    df = spark.createDataFrame([("ADWORDS", dt.date(2020, 1, 2), None), ("ADWORDS", dt.date(2020, 1, 2), "X")],
                               "NOM_ORIGEM_DADOS string, DAT_REFERENCIA date, NOM_DISCIPLINA string")
    kept = S.delete_slice(df, "ADWORDS", dt.date(2020, 1, 1), dt.date(2020, 1, 3), ["X"])
    assert kept.count() == 1 and kept.first().NOM_DISCIPLINA is None


def test_replace_twice_equals_once(spark, small_dir):
    rows = _rows(spark, small_dir)
    target = rows.filter(F.col("DAT_REFERENCIA") < "1998-01-01")
    batch = rows.filter(F.col("DAT_REFERENCIA") >= "1997-06-01")
    once = S.replace_slice(target, batch, "ADWORDS")
    twice = S.replace_slice(once, batch, "ADWORDS")
    assert _sorted(once) == _sorted(twice)
    assert once.count() == rows.count()


def test_rows_outside_slice_unchanged(spark, small_dir):
    rows = _rows(spark, small_dir)
    lo, hi = dt.date(1997, 1, 1), dt.date(1997, 12, 31)
    batch = rows.filter(F.col("DAT_REFERENCIA").between(lo, hi))
    out = S.replace_slice(rows, batch, "ADWORDS")
    outside = ~F.col("DAT_REFERENCIA").between(lo, hi)
    assert _sorted(out.filter(outside)) == _sorted(rows.filter(outside))


def test_empty_batch_changes_nothing(spark, small_dir):
    rows = _rows(spark, small_dir)
    out = S.replace_slice(rows, rows.limit(0), "ADWORDS")
    assert out.count() == rows.count()


@pytest.mark.parametrize("unit", [S.DAY, S.MONTH])
def test_reload_and_first_load(spark, small_dir, unit):
    rows = _rows(spark, small_dir).filter(F.col("DAT_REFERENCIA").between("1995-11-15", "1996-02-10"))
    table = scratch_path(spark, "test-table")
    assert S.read_table(spark, table) is None                     # first-load guard
    assert S.reload_slice(spark, table, rows.limit(0), "ADWORDS", unit=unit) is None
    S.reload_slice(spark, table, rows, "ADWORDS", unit=unit)
    S.reload_slice(spark, table, rows.filter(F.col("DAT_REFERENCIA") < "1996-01-01"), "ADWORDS", unit=unit)
    assert S.read_table(spark, table).count() == rows.count()   # the slice was replaced by equal rows


@pytest.mark.parametrize("unit", [S.DAY, S.MONTH])
def test_undated_rows_are_never_lost(spark, unit):
    table = scratch_path(spark, "test-undated")
    cols = "NOM_ORIGEM_DADOS string, DAT_REFERENCIA date, NOM_DISCIPLINA string"
    day = dt.date(2020, 1, 10)
    S.reload_slice(spark, table, spark.createDataFrame([("P", None, "FACEBOOK"), ("P", day, "FACEBOOK")], cols), "P", ["FACEBOOK"], unit)
    S.reload_slice(spark, table, spark.createDataFrame([("P", None, "RTBHOUSE"), ("P", day, "RTBHOUSE")], cols), "P", ["RTBHOUSE"], unit)
    S.reload_slice(spark, table, spark.createDataFrame([("P", None, "NEW")], cols), "P", ["NEW"], unit)
    got = _sorted(S.read_table(spark, table, ["NOM_ORIGEM_DADOS", "DAT_REFERENCIA", "NOM_DISCIPLINA"]))
    assert got == sorted([("P", "None", "FACEBOOK"), ("P", "None", "RTBHOUSE"), ("P", "None", "NEW"),
                          ("P", str(day), "FACEBOOK"), ("P", str(day), "RTBHOUSE")])
    batch = spark.createDataFrame([("P", None, "Z")], cols)
    assert S.replace_slice(batch, batch, "P").count() == 2


def test_update_initiative_rejects_duplicate_keys(spark):
    target = spark.createDataFrame([("HTTP://A", "OLD")], "NOM_URL string, NOM_INICIATIVA string")
    lk = spark.createDataFrame([("http://a", "x"), ("HTTP://A", "y")], "URL string, INICIATIVA string")
    with pytest.raises(Exception):
        S.update_initiative(target, lk).collect()


def test_update_initiative_sets_null_when_lookup_value_null(spark):
    target = spark.createDataFrame([("HTTP://A", "OLD"), ("HTTP://B", "KEEP")], "NOM_URL string, NOM_INICIATIVA string")
    lk = spark.createDataFrame([("http://a", None)], "URL string, INICIATIVA string")
    got = dict(S.update_initiative(target, lk).collect())
    assert got == {"HTTP://A": None, "HTTP://B": "KEEP"}


def test_high_water_mark_default(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 10))], "NOM_ORIGEM_DADOS string, DAT_REFERENCIA date")
    r = df.agg(S.high_water_mark(df, "A").alias("a"), S.high_water_mark(df, "B").alias("b")).first()
    assert r.a == dt.date(2020, 1, 3) and r.b == dt.date(1900, 1, 1)


def test_fail_on_bad_name_aborts(spark):
    df = spark.createDataFrame([("2020-01-01", "a_b", 1, 1.0, "desktop")],
                               "date string, adname string, impressions int, spend double, device_platform string")
    rows, _ = feeds.social_load(df, fail_on_bad_name=True)
    with pytest.raises(Exception):
        rows.collect()
    rows, bad = feeds.social_load(df, fail_on_bad_name=False)
    assert rows.count() == 0 and bad.count() == 1


def test_run_load_stamps_and_replaces(spark, small_dir):
    rows = _rows(spark, small_dir).filter(F.col("DAT_REFERENCIA").between("1995-11-15", "1995-12-20"))
    table = scratch_path(spark, "test-run-load")
    ts = dt.datetime(2024, 1, 31, 6, 0, 0)
    feeds.run_load(spark, rows, table, "ADWORDS", run_ts=ts)
    got = S.read_table(spark, table)
    assert got.count() == rows.count()
    assert got.select("DAT_INSERCAO").distinct().collect()[0][0] == ts
    feeds.run_load(spark, rows, table, "ADWORDS", run_ts=ts)          # rerun: same content
    assert S.read_table(spark, table).count() == rows.count()
    feeds.run_load(spark, rows.limit(5), table, "ADWORDS", run_ts=ts, mode="append")
    assert S.read_table(spark, table).count() == rows.count() + 5


@pytest.mark.parametrize("unit", [S.DAY, S.MONTH])
def test_stored_reload_matches_replace_slice(spark, small_dir, unit):
    from ledgerlight.operators.canonical import CANONICAL_COLUMNS
    rows = _rows(spark, small_dir).filter(F.col("DAT_REFERENCIA").between("1997-09-01", "1998-03-31"))
    table = scratch_path(spark, "test-partitioned")
    first = rows.filter(F.col("DAT_REFERENCIA") < "1998-01-01")
    assert S.reload_slice(spark, table, first, "ADWORDS", unit=unit) is not None
    # second batch overlaps and leaves some dates of its span without rows
    second = rows.filter((F.col("DAT_REFERENCIA") >= "1997-10-01") & (F.dayofmonth("DAT_REFERENCIA") != 15))
    S.reload_slice(spark, table, second, "ADWORDS", unit=unit)
    got = S.read_table(spark, table, list(CANONICAL_COLUMNS))
    expected = S.replace_slice(first, second, "ADWORDS")
    assert _sorted(got) == _sorted(expected)
    # rerun is idempotent
    S.reload_slice(spark, table, second, "ADWORDS", unit=unit)
    assert S.read_table(spark, table).count() == expected.count()


def test_initiative_update_of_the_stored_table(spark):
    table = scratch_path(spark, "test-initiative")
    cols = "NOM_ORIGEM_DADOS string, DAT_REFERENCIA date, NOM_URL string, NOM_INICIATIVA string"
    S.append_rows(spark.createDataFrame([("A", dt.date(2020, 1, 1), "U1", None), ("A", dt.date(2020, 1, 2), "U2", "K"), ("B", None, "U1", "K")], cols), table)
    S.reload_initiative(spark, table, spark.createDataFrame([("u1", "new")], "URL string, INICIATIVA string"))
    got = {(r.NOM_ORIGEM_DADOS, r.NOM_URL): r.NOM_INICIATIVA for r in S.read_table(spark, table).collect()}
    assert got == {("A", "U1"): "NEW", ("A", "U2"): "K", ("B", "U1"): "NEW"}


# ---------------------------------------------------------------- staged write and publication
COLS = "NOM_ORIGEM_DADOS string, DAT_REFERENCIA date, NOM_DISCIPLINA string"


def _days(spark, first, days, mark):
    return spark.createDataFrame([("A", first + dt.timedelta(d), mark) for d in range(days)], COLS)


def _content(spark, table):
    return sorted((str(r.DAT_REFERENCIA), r.NOM_DISCIPLINA) for r in S.read_table(spark, table).collect())


def test_a_reload_writes_once_and_checkpoints_nothing(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.readwriter import DataFrameWriter
    table, day = scratch_path(spark, "test-once"), dt.date(2020, 1, 1)
    S.reload_slice(spark, table, _days(spark, day, 4, "old"), "A")
    writes, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (writes.append(path), write(self, path, *a, **k))[1])
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("checkpoint"))
    S.reload_slice(spark, table, _days(spark, day + dt.timedelta(2), 4, "new"), "A")
    assert len(writes) == 1 and "/_staged/" in writes[0]
    assert [m for _, m in _content(spark, table)] == ["old"] * 2 + ["new"] * 4


@pytest.mark.parametrize("moved", [0, 1, 3])
def test_a_publication_that_stops_is_completed_by_the_next_load(spark, monkeypatch, moved):
    table, day = scratch_path(spark, "test-crash"), dt.date(2020, 1, 1)
    S.reload_slice(spark, table, _days(spark, day, 5, "old"), "A")
    whole = S._work_off

    def stops(spark, table_dir, staged, todo):
        """Publishes some partitions, then fails between the delete and the move of the next one."""
        fs, root = S._fs(spark, table_dir)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for name in todo["replace"][:moved]:
            fs.delete(path(root, name), True)
            fs.rename(path(staged, name), path(root, name))
        fs.delete(path(root, todo["replace"][moved]), True)
        raise OSError("lost")

    monkeypatch.setattr(S, "_work_off", stops)
    batch = spark.createDataFrame([("A", day + dt.timedelta(d), "new") for d in (0, 1, 2, 4)], COLS)      # the fourth day lost its rows
    with pytest.raises(OSError):
        S.reload_slice(spark, table, batch, "A")
    monkeypatch.setattr(S, "_work_off", whole)
    assert S.reload_slice(spark, table, batch.limit(0), "A") is None          # an empty load still completes it
    assert _content(spark, table) == [(str(day + dt.timedelta(d)), "new") for d in (0, 1, 2, 4)]
    assert S.recover(spark, table) == 0


def test_a_load_that_fails_before_its_list_leaves_the_table(spark, monkeypatch):
    table, day = scratch_path(spark, "test-unlisted"), dt.date(2020, 1, 1)
    S.reload_slice(spark, table, _days(spark, day, 3, "old"), "A")
    publish = S._publish
    monkeypatch.setattr(S, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        S.reload_slice(spark, table, _days(spark, day, 3, "new"), "A")
    monkeypatch.setattr(S, "_publish", publish)
    assert S.recover(spark, table) == 0 and {m for _, m in _content(spark, table)} == {"old"}
    fs, root = S._fs(spark, f"{table}/{S.STAGED}")
    assert len(fs.listStatus(root)) == 0


def test_several_spans_in_one_write(spark):
    table, day = scratch_path(spark, "test-spans"), dt.date(2020, 1, 1)
    S.reload_slice(spark, table, _days(spark, day, 9, "old"), "A")
    spans = [(day, day + dt.timedelta(1)), (day + dt.timedelta(5), day + dt.timedelta(7))]
    batch = _days(spark, day + dt.timedelta(5), 2, "new")
    S.reload_spans(spark, table, batch, "A", spans, undated=False)
    assert _content(spark, table) == [(str(day + dt.timedelta(d)), m) for d, m in ((2, "old"), (3, "old"), (4, "old"), (5, "new"), (6, "new"), (8, "old"))]


def test_rows_of_another_source_stop_the_load(spark):
    table = scratch_path(spark, "test-strange")
    with pytest.raises(ValueError, match="source"):
        S.reload_slice(spark, table, spark.createDataFrame([("B", dt.date(2020, 1, 1), "x")], COLS), "A")


def test_initiative_update_reads_and_writes_only_touched_partitions(spark, monkeypatch):
    table, day = scratch_path(spark, "test-touched"), dt.date(2020, 1, 1)
    cols = "NOM_ORIGEM_DADOS string, DAT_REFERENCIA date, NOM_URL string, NOM_INICIATIVA string, WIDE string"
    S.append_rows(spark.createDataFrame([("A", day + dt.timedelta(d), f"U{d}", "K", "w") for d in range(30)], cols), table)
    plans, staged = [], S._write_staged
    monkeypatch.setattr(S, "_write_staged", lambda spark, rows, path: (plans.append(rows.inputFiles()), staged(spark, rows, path))[1])
    lookup = spark.createDataFrame([("u3", "x"), ("u9", "k"), ("u20", "y")], "URL string, INICIATIVA string")
    before = {f for f in S.read_table(spark, table).inputFiles()}
    assert S.reload_initiative(spark, table, lookup) == 2                      # u9 has that value already
    wide = S._table(spark, table, ["WIDE", *S.PARTITION_COLS])
    assert wide.count() == 30
    kept = {f for f in S.read_table(spark, table).inputFiles()} & before
    assert len(kept) == 28                                                     # files of other partitions were not rewritten
    got = {r.NOM_URL: r.NOM_INICIATIVA for r in S.read_table(spark, table).collect()}
    assert got["U3"] == "X" and got["U20"] == "Y" and set(got.values()) == {"K", "X", "Y"}
    assert S.reload_initiative(spark, table, lookup) == 0
