"""File sources in a scratch folder: good, bad name, impossible date, empty."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.sources import readers as R
from ledgerlight.session import scratch_path


@pytest.mark.parametrize("stem,feed,ok", [
    ("20240131_bing", "bing", True),
    ("20241331_bing", "bing", False),      # impossible month
    ("20240230_bing", "bing", False),      # impossible day
    ("20240131_rtbhouse", "bing", False),  # other feed
    ("20240131_bing_old", "bing", False),  # longer name
    ("2024013_bing", "bing", False),
])
def test_valid_drop_file(spark, stem, feed, ok):
    df = spark.createDataFrame([(stem,)], "s string")
    assert df.select(R.valid_drop_file("s", feed)).first()[0] is ok


def test_file_stem(spark):
    df = spark.createDataFrame([("20240131_bing.csv",), ("a.b.xlsx",), ("noext",)], "n string")
    assert [r[0] for r in df.select(R.file_stem("n")).collect()] == ["20240131_bing", "a.b", "noext"]


def test_empty_delimited_file_returns_none(spark):
    path = scratch_path(spark, "empty-csv")
    spark.createDataFrame([], "a string").write.mode("overwrite").csv(path)
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert R.read_delimited(spark, path, schema) is None


def test_flatten_report_rejects_other_header(spark):
    from ledgerlight.sources.landing import write_analytics_reports
    df = spark.createDataFrame([("2020-01-01", "c", "1")], "date string, campaign string, sessions string")
    path = write_analytics_reports(df, scratch_path(spark, "ga-json"), ["date", "campaign"], ["sessions"])
    ok = R.flatten_report(spark, path, ["date", "campaign", "sessions"]).collect()
    assert ok[0]["campaign"] == "c"
    with pytest.raises(Exception):
        R.flatten_report(spark, path, ["date", "campaign", "pageviews"]).collect()


def test_drop_folder_leaves_bad_names_and_quarantines_bad_dates(spark, small_dir):
    import os
    from ledgerlight import registry as reg
    df = reg.QUERIES["drop_folder_stream"](spark, small_dir)
    assert df.count() == spark.table("fx_in_retargeting").count()
    assert df.filter(F.col("NOM_ORIGEM_DADOS") != "PARCEIRO").count() == 0


def _move_single_part(spark, src_dir, dst):
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(src_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(dst).getParent())
    for st in fs.listStatus(Path(src_dir)):
        if st.getPath().getName().startswith("part-"):
            fs.rename(st.getPath(), Path(dst))
            return


def _names(spark, d):
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(d).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(Path(d)):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(Path(d)) if not st.getPath().getName().startswith("."))


def test_csv_drop_folder_routing(spark, small_dir):
    from ledgerlight import fixtures as fx
    from ledgerlight import registry as reg
    from ledgerlight.operators.slices import read_table
    from ledgerlight.plans import feeds
    from ledgerlight.sources.landing import write_drop_files
    from ledgerlight.streaming.drop_folder import ingest_drop
    fx.register(spark, small_dir)
    base = scratch_path(spark, "test-drop")
    report = reg._retargeting_report(spark)
    sample = report.filter(F.col("Date") == "1996-05-05")
    write_drop_files(spark, report, "Date", f"{base}/staging", f"{base}/inbox", "rtbhouse", sep=";",
                     extra={"report_rtbhouse.csv": sample, "20241331_rtbhouse.csv": sample})
    ingest_drop(spark, f"{base}/inbox", f"{base}/archive", f"{base}/ckpt", f"{base}/table", f"{base}/errors",
                "rtbhouse", reg.RETARGETING_SCHEMA, feeds.retargeting_load, "PARCEIRO", ["RTBHOUSE"], sep=";", unit="month")
    assert read_table(spark, f"{base}/table").count() == report.count()
    assert _names(spark, f"{base}/errors") == ["20241331_rtbhouse.csv"]         # impossible date
    assert "report_rtbhouse.csv" in _names(spark, f"{base}/inbox")             # bad name stays
    # A second run over the same checkpoint finds nothing new and changes nothing.
    ingest_drop(spark, f"{base}/inbox", f"{base}/archive", f"{base}/ckpt", f"{base}/table", f"{base}/errors",
                "rtbhouse", reg.RETARGETING_SCHEMA, feeds.retargeting_load, "PARCEIRO", ["RTBHOUSE"], sep=";", unit="month")
    assert read_table(spark, f"{base}/table").count() == report.count()


def test_sheet_drop_folder(spark, small_dir):
    from ledgerlight import fixtures as fx
    from ledgerlight import registry as reg
    from ledgerlight.operators.slices import read_table
    from ledgerlight.plans import feeds
    from ledgerlight.sources.landing import write_sheets
    from ledgerlight.streaming.drop_folder import ingest_drop
    fx.register(spark, small_dir)
    base = scratch_path(spark, "test-sheet-drop")
    sheet = spark.table("fx_in_paid_search")
    files = {"19960101_bing.txt": "1996", "19970101_bing.txt": "1997", "sheet_bing.txt": "1998"}
    for name, year in files.items():
        part = sheet.filter(F.year("date") == int(year))
        write_sheets(part, f"{base}/staging/{name}", feeds.PAID_SEARCH_HEADER)
        _move_single_part(spark, f"{base}/staging/{name}/sheet=0", f"{base}/inbox/{name}")

    def load(df):
        return feeds.paid_search_load(df.toDF(*feeds.PAID_SEARCH_HEADER), fail_on_bad_name=False)[0]

    ingest_drop(spark, f"{base}/inbox", f"{base}/archive", f"{base}/ckpt", f"{base}/table", f"{base}/errors",
                "bing", reg.PAID_SEARCH_SCHEMA, load, "PARCEIRO", ["BING_LP"], fmt="sheet", unit="month")
    got = read_table(spark, f"{base}/table")
    loadable = feeds.paid_search_load(
        sheet.filter(F.year("date").isin(1996, 1997)).toDF(*feeds.PAID_SEARCH_HEADER), fail_on_bad_name=False)[0]
    assert got.count() == loadable.count() > 0
    assert "sheet_bing.txt" in _names(spark, f"{base}/inbox")


def test_a_failing_file_goes_to_the_error_folder_and_others_load(spark):
    from ledgerlight import registry as reg
    from ledgerlight.operators.slices import read_table
    from ledgerlight.plans import feeds
    from ledgerlight.streaming.drop_folder import ingest_drop
    name = "_".join(f"t{i}" for i in range(11))
    head = "Date;Size;Device;Imps;Clicks;Cost (BRL)"
    rows = {"20240101": [("2024-01-01", 1.5), ("2024-01-07", 2.0)], "20240110": [("2024-01-10", 3.0)],
            "20240115": [("2024-01-15", "12,50")], "20240116": [("16 Jan", 1.0)], "20240120": [("2024-01-20", 4.0), ("2024-01-27", 5.0)]}
    for per_batch in (1, 2, 5):
        base = scratch_path(spark, "test-errors")
        for stem, lines in rows.items():
            text = "\n".join([head] + [f"{d};{name};desktop;1;1;{c}" for d, c in lines])
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/staging/{stem}")
            _move_single_part(spark, f"{base}/staging/{stem}", f"{base}/inbox/{stem}_rtbhouse.csv")
        ingest_drop(spark, f"{base}/inbox", f"{base}/archive", f"{base}/ckpt", f"{base}/table", f"{base}/errors", "rtbhouse",
                    reg.RETARGETING_SCHEMA, feeds.retargeting_load, "PARCEIRO", ["RTBHOUSE"], sep=";", files_per_batch=per_batch,
                    valid=F.try_to_date("Date", "yyyy-MM-dd").isNotNull())
        assert _names(spark, f"{base}/inbox") == []
        assert _names(spark, f"{base}/archive") == ["20240101_rtbhouse.csv", "20240110_rtbhouse.csv", "20240120_rtbhouse.csv"]
        assert _names(spark, f"{base}/errors") == ["20240115_rtbhouse.csv", "20240116_rtbhouse.csv"]
        got = sorted((str(r.DAT_REFERENCIA), r.VAL_INVESTIMENTO) for r in read_table(spark, f"{base}/table").collect())
        assert got == [("2024-01-01", 1.5), ("2024-01-07", 2.0), ("2024-01-10", 3.0), ("2024-01-20", 4.0), ("2024-01-27", 5.0)]


def test_bad_cells_fail_instead_of_reading_as_null(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T
    from ledgerlight.sources import readers as rd
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.DoubleType())])
    (tmp_path / "r.csv").write_text("a;n\nx;12,50\n")
    with pytest.raises(Exception):
        rd.read_delimited(spark, str(tmp_path / "r.csv"), schema).collect()
    (tmp_path / "s.txt").write_text("h\nx,1.5\ny,bad\nfoot\n")
    with pytest.raises(Exception):
        rd.read_trimmed(spark, str(tmp_path / "s.txt"), 1, 1, schema).collect()
    (tmp_path / "m.csv").write_text("Day,v\n,1\n2020-01-01,2\nDay,v\n")
    assert rd.read_multi_csv(spark, str(tmp_path / "m.csv"), ["Day", "v"]).count() == 2


def test_pretty_printed_report(spark, tmp_path):
    import json
    import pytest
    from ledgerlight.sources import readers as rd
    doc = {"reports": [{"columnHeader": {"dimensions": ["ga:date"], "metricHeader": {"metricHeaderEntries": [{"name": "ga:hits"}]}},
                        "data": {"rows": [{"dimensions": ["20200101"], "metrics": [{"values": ["3"]}]}]}}]}
    (tmp_path / "r.json").write_text(json.dumps(doc, indent=2))
    assert rd.flatten_report(spark, str(tmp_path / "r.json"), ["date", "hits"], multi_line=True).collect() == [("20200101", "3")]
    with pytest.raises(Exception):
        rd.flatten_report(spark, str(tmp_path / "r.json"), ["date", "hits"]).collect()


HEAD = "Date;Size;Device;Imps;Clicks;Cost (BRL)"
AD = "_".join(f"t{i}" for i in range(11))


def _inbox(spark, base, files):
    for name, lines in files.items():
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{base}/staging/{name}")
        _move_single_part(spark, f"{base}/staging/{name}", f"{base}/inbox/{name}")


def _ingest(spark, base, **kw):
    from ledgerlight import registry as reg
    from ledgerlight.plans import feeds
    from ledgerlight.streaming.drop_folder import ingest_drop
    log = ingest_drop(spark, f"{base}/inbox", f"{base}/archive", f"{base}/ckpt", f"{base}/table", f"{base}/errors", "rtbhouse",
                      reg.RETARGETING_SCHEMA, feeds.retargeting_load, "PARCEIRO", ["RTBHOUSE"], sep=";",
                      valid=F.try_to_date("Date", "yyyy-MM-dd").isNotNull(), **kw)
    return {r.file: r for r in log.collect()}


def _table(spark, base):
    from ledgerlight.operators.slices import read_table
    return sorted((str(r.DAT_REFERENCIA), r.VAL_INVESTIMENTO) for r in read_table(spark, f"{base}/table").collect())


def test_overlapping_files_load_in_order_and_disjoint_ones_together(spark, monkeypatch):
    from ledgerlight.streaming import drop_folder as D
    line = lambda day, cost: f"{day};{AD};desktop;1;1;{cost}"
    files = {"20240101_rtbhouse.csv": [HEAD, line("2024-01-01", 1), line("2024-01-05", 2)],
             "20240103_rtbhouse.csv": [HEAD, line("2024-01-04", 3), line("2024-01-08", 4)],         # replaces the fifth of the first
             "20240107_rtbhouse.csv": [HEAD, line("2024-01-08", 5)],                                # and its eighth is replaced
             "20240201_rtbhouse.csv": [HEAD, line("2024-02-01", 6)], "20240301_rtbhouse.csv": [HEAD, line("2024-03-01", 7)]}
    tables, loads, together = [], [], {1: False, 64: True}
    reload = D.reload_spans
    monkeypatch.setattr(D, "reload_spans", lambda spark, table, rows, source, spans, *a: (loads.append(len(spans)), reload(spark, table, rows, source, spans, *a)))
    for per_batch in (1, 64):
        base = scratch_path(spark, "test-waves")
        _inbox(spark, base, files)
        log = _ingest(spark, base, files_per_batch=per_batch, together=together[per_batch])
        tables.append(_table(spark, base))
    assert tables[0] == tables[1] == [("2024-01-01", 1.0), ("2024-01-04", 3.0), ("2024-01-08", 5.0), ("2024-02-01", 6.0), ("2024-03-01", 7.0)]
    assert loads == [1] * 5 + [3, 1, 1]
    assert {f: r.wave for f, r in log.items()} == dict(zip(files, [0, 1, 2, 0, 0])) and {r.outcome for r in log.values()} == {"loaded"}


def test_waves():
    from ledgerlight.streaming.drop_folder import waves
    assert waves([(1, 3), (4, 5), (2, 4), (6, 6), (5, 9), (None, None)]) == [0, 0, 1, 0, 1, 0]
    assert waves([]) == []


@pytest.mark.parametrize("together", [True, False])
def test_refused_and_empty_files(spark, together):
    good = f"2024-01-02;{AD};desktop;1;1;1.5"
    files = {"20240101_rtbhouse.csv": [HEAD, good], "20240102_rtbhouse.csv": [HEAD.replace("Device", "Gerät"), good],
             "20240103_rtbhouse.csv": [HEAD], "20240104_rtbhouse.csv": [HEAD, good.replace("02;", "04;"), "2024-01-05;short"],
             "20240105_rtbhouse.csv": ["Cost (BRL);Clicks;Imps;Device;Size;Date", f"2.5;1;1;desktop;{AD};2024-01-06"], "20240106_rtbhouse.csv": [""],
             "20240107_rtbhouse.csv": [HEAD, good + ";1"], "20241301_rtbhouse.csv": [HEAD, good], "x_rtbhouse.csv": [HEAD, good]}
    base = scratch_path(spark, "test-refused")
    _inbox(spark, base, files)
    log = _ingest(spark, base, together=together)
    assert {f[:8]: r.outcome for f, r in log.items()} == {"20240101": "loaded", "20240102": "refused", "20240103": "empty", "20240104": "refused",
                                                          "20240105": "loaded", "20240106": "empty", "20240107": "refused", "20241301": "refused"}
    assert "unknown: Gerät; missing: Device" in log["20240102_rtbhouse.csv"].reason
    assert _table(spark, base) == [("2024-01-02", 1.5), ("2024-01-06", 2.5)]       # columns of the other order are bound by name
    assert _names(spark, f"{base}/errors") == [f"{d}_rtbhouse.csv" for d in ("20240102", "20240104", "20240107", "20241301")]
    assert _names(spark, f"{base}/archive") == ["20240101_rtbhouse.csv", "20240105_rtbhouse.csv"]
    assert _names(spark, f"{base}/inbox") == ["20240103_rtbhouse.csv", "20240106_rtbhouse.csv", "x_rtbhouse.csv"]
    assert len(_ingest(spark, base)) == 8 and len(_table(spark, base)) == 2


def test_a_batch_that_stops_between_moves_is_replayed(spark, monkeypatch):
    from ledgerlight.streaming import drop_folder as D
    files = {f"202401{d:02d}_rtbhouse.csv": [HEAD, f"2024-01-{d:02d};{AD};desktop;1;1;{d}"] for d in range(1, 6)}
    base = scratch_path(spark, "test-replay")
    _inbox(spark, base, files)
    move, moved = D._move, []

    def stops(spark, path, folder):
        if len(moved) == 2:
            raise OSError("lost")
        moved.append(path)
        move(spark, path, folder)

    monkeypatch.setattr(D, "_move", stops)
    with pytest.raises(Exception):
        _ingest(spark, base)
    monkeypatch.setattr(D, "_move", move)
    _ingest(spark, base)
    assert _names(spark, f"{base}/inbox") == [] and len(_names(spark, f"{base}/archive")) == 5
    assert _table(spark, base) == [(f"2024-01-{d:02d}", float(d)) for d in range(1, 6)]


def test_columns_are_bound_by_name(spark, tmp_path):
    schema = T.StructType([T.StructField("Device", T.StringType()), T.StructField("Size", T.StringType()), T.StructField("n", T.IntegerType())])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('Device;Size;n\nmobile;"alp\nad; name";1\n')
    (tmp_path / "in" / "b.csv").write_text('"n";Size;Device\n2;alp;desktop\n')
    (tmp_path / "in" / "empty.csv").write_text("")
    got = sorted(tuple(r) for r in R.read_delimited(spark, str(tmp_path / "in"), schema).collect())
    assert got == [("desktop", "alp", 2), ("mobile", "alp\nad; name", 1)]
    for name, head in {"unknown": "Device;Size;m", "missing": "Device;Size", "repeated": "Device;Size;n;n"}.items():
        (tmp_path / f"{name}.csv").write_text(head + "\n" + ";".join("1" for _ in head.split(";")) + "\n")
        with pytest.raises(R.BadHeader, match=name):
            R.read_delimited(spark, str(tmp_path / f"{name}.csv"), schema)
    report = schema.add("Spend", T.DoubleType())
    (tmp_path / "r.csv").write_text("Spend,Device,n,Size\n1.5,d,1,s\n0,d,2,s\n")
    assert R.read_report(spark, str(tmp_path / "r.csv"), report).collect() == [("d", "s", 1, 1.5)]


def test_lines_that_do_not_fit_are_refused_and_never_data(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.DoubleType())])
    (tmp_path / "r.csv").write_text('a;n\nx;1.5\ny;12,50\nshort\nlong;1;2\n"q\nq";3\n')
    landed = R.delimited_lanes(spark, str(tmp_path / "r.csv"), schema)
    assert sorted(tuple(r) for r in landed.rows.collect()) == [("q\nq", 3.0), ("x", 1.5)]
    assert sorted(tuple(r) for r in landed.refused.collect()) == [("r.csv", "long;1;2"), ("r.csv", "short"), ("r.csv", "y;12,50")]
    assert landed.rows.select("a").count() == 2 and landed.refused.count() == 3       # whatever columns a query needs
    (tmp_path / "m.csv").write_text("Day,v\n,1\n2020-01-01,2\nDay,v\n2020-01-03,short,x\n2020-01-04\n")
    landed = R.multi_csv_lanes(spark, str(tmp_path / "m.csv"), ["Day", "v"])
    assert sorted(map(str, landed.rows.collect())) == ["Row(Day='2020-01-01', v='2')", "Row(Day=None, v='1')"]
    assert sorted(r.line for r in landed.refused.collect()) == ["2020-01-03,short,x", "2020-01-04"]
    with pytest.raises(Exception):
        R.read_multi_csv(spark, str(tmp_path / "m.csv"), ["Day", "v"]).select("Day").collect()
    (tmp_path / "j.json").write_text('{"date":"1","adname":"x"}\n{"date":"2","adn\n{"adname":"k"}\n')
    landed = R.record_lanes(spark, str(tmp_path / "j.json"), ["date", "adname"])
    assert sorted(tuple(r) for r in landed.rows.collect()) == [("", "k"), ("1", "x")] and landed.refused.collect() == [("j.json", '{"date":"2","adn')]
    with pytest.raises(Exception):
        R.read_records(spark, str(tmp_path / "j.json"), ["date", "adname"]).collect()
