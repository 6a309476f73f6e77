"""Date sweep over 2019-2026 for D1, D2, D4-D6 against plain Python dates."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.functions.dates import day_of_week, period_bounds, report_bounds, week_number, week_start


def py_week(d: dt.date) -> int:
    jan1 = dt.date(d.year, 1, 1)
    return (d.timetuple().tm_yday - 1 + jan1.weekday()) // 7 + 1


def test_week_number_examples(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 1, 2),), (dt.date(2024, 12, 30),)], "d date")
    assert [r[0] for r in df.select(week_number("d")).collect()] == [1, 2, 53]


def test_date_sweep(spark):
    start, end = dt.date(2019, 1, 1), dt.date(2026, 12, 31)
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = days.select("d", week_number("d").alias("w"), day_of_week("d").alias("dow"),
                      week_start("d").alias("ws")).collect()
    for r in got:
        assert r.w == py_week(r.d), r.d
        assert r.dow == (r.d.isoweekday() % 7) + 1, r.d
        assert r.ws == r.d - dt.timedelta(days=r.d.weekday()), r.d


def test_period_bounds_sunday_rule(spark):
    cal = spark.createDataFrame([(dt.date(2024, 12, 15), dt.date(2023, 12, 15), dt.date(2023, 12, 17))],
                                "FULL_DATE date, PY_DATE date, PY_DAY_OF_WEEK date")
    b = report_bounds(cal, "2024-12-16")            # Monday; yesterday is a Sunday
    assert b["cy_start_of_week"] == dt.date(2024, 12, 9)
    assert b["cy_prior_saturday"] == dt.date(2024, 11, 30)
    assert b["py_yesterday"] == dt.date(2023, 12, 15)
    b2 = report_bounds(cal, "2024-12-18")           # calendar row missing: prior-year bounds null
    assert b2["py_yesterday"] is None and b2["py_start_of_week"] is None
    assert b2["cy_prior_saturday"] == dt.date(2024, 12, 14)


def test_period_bounds_frame_matches_driver_bounds(spark):
    start = dt.date(2019, 1, 1)
    cal = spark.range(3000).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("FULL_DATE")) \
        .select("FULL_DATE", F.add_months("FULL_DATE", -12).alias("PY_DATE"),
                F.date_sub("FULL_DATE", 364).alias("PY_DAY_OF_WEEK"))
    frame = {r.as_of: r.asDict() for r in period_bounds(cal).collect()}
    for as_of in (dt.date(2019, 3, 4), dt.date(2020, 1, 6), dt.date(2024, 12, 16), dt.date(2026, 1, 1)):
        b = report_bounds(cal, as_of)
        row = frame[as_of]
        for k, v in b.items():
            assert row[k] == v, (as_of, k)
