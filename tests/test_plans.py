"""Physical-plan properties that the scale design relies on."""

import pytest

import __spark_entry__ as entry


def plan(spark, small_dir, key):
    df = entry.queries()[key](spark, small_dir)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["retargeting_load", "canonical_cast", "decode_ad_layouts", "channel_class",
                                 "analytics_load"])
def test_feed_projections_are_map_only(spark, small_dir, key):
    """A feed batch is a narrow projection: no shuffle at all."""
    p = plan(spark, small_dir, key)
    assert "Exchange" not in p, p


@pytest.mark.parametrize("key", ["deposits_redeemed", "deposits_received"])
def test_deposit_joins_keep_equi_keys(spark, small_dir, key):
    """J5/J6 stay hash/sort-merge joins on (store, event); never nested loops."""
    p = plan(spark, small_dir, key)
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, p


def test_labor_cost_joins_aggregates_on_the_same_keys(spark, small_dir):
    """Both sides are aggregated on (store, date, hour) before the join."""
    p = plan(spark, small_dir, "labor_cost")
    assert p.count("HashAggregate") >= 4
    assert "NestedLoopJoin" not in p


def test_report_literals_reach_the_scan(spark, small_dir):
    """Period bounds are literals: the date predicate is evaluated below the unions."""
    df = entry.queries()["location_equipment"](spark, small_dir)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "2000-06-21" in p


def test_revenue_has_no_category_fanout(spark, small_dir):
    """The category self-join is replaced by weights: no join on CategoryId alone
    against the category master with a nested loop or cartesian product."""
    p = plan(spark, small_dir, "revenue_union")
    assert "CartesianProduct" not in p


def test_literal_edge_rows(spark):
    """Rows no driver table holds: undated bookings, hours with four decimals, integers above 2^53, text that is no date."""
    import datetime as dt
    from decimal import Decimal
    import pytest
    from pyspark.sql import functions as F
    from ledgerlight.operators.canonical import cast_by_prefix
    from ledgerlight.plans import venue_daily as vd
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    sales = spark.createDataFrame([(1, 7, None, Decimal(5)), (1, 7, d1, Decimal(3))], "StoreId int, EventRefId int, Business_Date date, LineAmountPaid decimal(18,2)")
    booked = spark.createDataFrame([(1, 7, None, 1), (1, 7, d2, 1)], "StoreId int, EventRefId int, Business_Date date, IsBirthdayEvent int")
    got = vd.deposits_received(sales, booked).collect()
    assert [(r.Business_date, r.Amount_Debit) for r in got] == [(d1, -3.0)]
    labor = spark.createDataFrame([(1, d1, 5, Decimal("7.3333"), Decimal("0.1111"))],
                                  "StoreId int, Business_Date date, EmpId int, RegularHours decimal(18,4), OvertimeHours decimal(18,4)")
    plan = spark.createDataFrame([], "StoreId int, Business_Date date, EmpId int, ScheduledHours decimal(18,2)")
    staff = spark.createDataFrame([(1, 5, "L", "F")], "StoreId int, EmployeeId int, LastName string, FirstName string")
    assert vd.hours_worked(plan, labor, staff, "2020-06-01").first().Total_Hours == 7.4444
    big = spark.createDataFrame([(9007199254740993, "9007199254740993", 2.9, "2.9", None)], "QTD_A long, QTD_B string, QTD_C double, QTD_D string, QTD_E long")
    assert tuple(cast_by_prefix(big).first()) == (9007199254740993, 9007199254740993, 2, 2, 0)
    with pytest.raises(Exception):
        cast_by_prefix(spark.createDataFrame([("31/31/2020",)], "DAT_A string")).collect()


def test_no_job_runs_while_a_report_is_planned(spark, small_dir):
    from ledgerlight.registry import QUERIES
    spark.sparkContext.setJobGroup("planning", "planning")
    QUERIES["week_number"](spark, small_dir)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning"))
    for key in ("hourly_sales", "store_lookup", "group_scaffold", "revenue_union", "search_ads_load"):
        QUERIES[key](spark, small_dir)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == before


def test_not_in_a_list_with_null_keeps_nothing(spark):
    from ledgerlight.operators.lookups import keep_in
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    lists = {(2,): [1], (2, None): [], (): [1, 2]}
    for values, want in lists.items():
        side = spark.createDataFrame([(v,) for v in values], "x int")
        assert sorted(r.k for r in keep_in(rows, "k", side, how="not in").collect()) == want


@pytest.mark.parametrize("key", ["tax_by_day", "end_of_day_balance"])
def test_tax_copies_no_line(spark, small_dir, key):
    """A4: the distinct amounts of a receipt are one set aggregate, no Expand in front of the shuffle."""
    assert "Expand" not in plan(spark, small_dir, key)


def test_products_are_aggregated_once(spark, small_dir):
    """Names and TOP 1 number come from one aggregate of the products."""
    fx_products = plan(spark, small_dir, "hourly_sales")
    assert fx_products.count("collect_set") >= 1 and "distinct" not in fx_products.lower()


def test_tax_edge_rows(spark):
    """Distinct amounts of a receipt count once, nulls not at all, a receipt without amounts as null."""
    from decimal import Decimal
    from ledgerlight.plans import venue_daily as vd
    rows = [(1, 7, "2020-01-01", 2.0, 1.0), (1, 7, "2020-01-01", 2.0, None), (1, 7, "2020-01-01", 3.0, 1.0), (1, None, "2020-01-01", 5.0, 0.0),
            (1, None, "2020-01-01", 5.0, 0.0), (2, 8, "2020-01-01", None, 4.0), (2, 9, "2020-01-02", None, None)]
    df = spark.createDataFrame([(s, r, d, *[None if x is None else Decimal(str(x)) for x in m]) for s, r, d, *m in rows],
                               "StoreId int, ReceiptNumber int, Business_Date string, TaxAmount decimal(18,2), GratuityAmount decimal(18,2)")
    got = {(r.Store_Id, r.Business_date, r.Tender_Type): r.Amount_Debit for r in vd.tax_by_day(df).collect()}
    assert got == {(1, "2020-01-01", "IL Sales Tax"): -10.0, (1, "2020-01-01", "Gratuity"): -1.0, (2, "2020-01-01", "IL Sales Tax"): None,
                   (2, "2020-01-01", "Gratuity"): -4.0, (2, "2020-01-02", "IL Sales Tax"): None, (2, "2020-01-02", "Gratuity"): None}
