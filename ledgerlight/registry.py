"""Query registry: one callable per SURVEY §2 query key, ``(spark, sf_dir) -> DataFrame``.

Each callable registers the driver tables and fixture views for ``sf_dir``
(lazy) and returns the operator's result over the whole fixture tables.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions.dates import period_bounds, report_bounds, request_window, week_number, day_of_week
from .plans import revenue as rv
from .plans import venue_daily as vd

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _t(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _report_stores(spark: SparkSession) -> DataFrame:
    return _t(spark, "fx_stores").filter("in_report").select(F.col("store_number").alias("storeId"))


def _bounds(spark: SparkSession) -> dict:
    return report_bounds(_t(spark, "fx_date_dim"), fx.AS_OF)


# ---------------------------------------------------------------- venue daily
@query("labor_cost")
def q_labor_cost(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.labor_cost(_t(spark, "fx_labor_hourly"), _t(spark, "fx_sales_summary"))


@query("hourly_payroll")
def q_hourly_payroll(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.hourly_payroll(_t(spark, "fx_labor"), _t(spark, "fx_employees"), _t(spark, "fx_schedule"))


@query("cashier_over_short")
def q_cashier_over_short(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.cashier_over_short(_t(spark, "fx_employee_history"), _t(spark, "fx_employees"), _t(spark, "fx_labor"))


@query("hours_worked")
def q_hours_worked(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.hours_worked(_t(spark, "fx_schedule"), _t(spark, "fx_labor"), _t(spark, "fx_employees"), fx.AS_OF)


@query("hourly_sales")
def q_hourly_sales(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.hourly_sales(_t(spark, "fx_sales_summary"), _t(spark, "fx_products"), _t(spark, "fx_categories"))


@query("returns_report")
def q_returns_report(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.returns_report(_t(spark, "fx_transactions"), _t(spark, "fx_employees"),
                             _t(spark, "fx_products"), _t(spark, "fx_categories"))


@query("end_of_day_balance")
def q_end_of_day_balance(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.end_of_day_balance(_t(spark, "fx_income"), _t(spark, "fx_bookings"), _t(spark, "fx_transactions"),
                                 _t(spark, "fx_sales_summary"), _t(spark, "fx_categories"))


@query("deposits_redeemed")
def q_deposits_redeemed(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.deposits_redeemed(_t(spark, "fx_bookings"), _t(spark, "fx_transactions"))


@query("deposits_received")
def q_deposits_received(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.deposits_received(_t(spark, "fx_transactions"), _t(spark, "fx_bookings"))


@query("tax_by_day")
def q_tax_by_day(spark, sf_dir):
    fx.register(spark, sf_dir)
    return vd.tax_by_day(_t(spark, "fx_transactions"))


# ---------------------------------------------------------------- revenue
def _revenue(spark) -> DataFrame:
    return rv.revenue_union(_t(spark, "fx_payments"), _t(spark, "fx_sales_summary"), _t(spark, "fx_categories"),
                            _t(spark, "fx_embed_sales"), _t(spark, "fx_stores"),
                            list(fx.PAYMENT_EXCLUDED_STORES), list(fx.FOOD_AND_BEVERAGE))


def _combined(spark, b) -> DataFrame:
    return rv.combined_activity(
        _t(spark, "fx_sales_summary"), _t(spark, "fx_categories"), _t(spark, "fx_embed_games"),
        _t(spark, "fx_stores"), _t(spark, "fx_product_sales"), _t(spark, "fx_game_activity"),
        _t(spark, "fx_group_names"), _report_stores(spark), list(fx.FOOD_AND_BEVERAGE),
        list(fx.PRODUCT_SALES_STORES), list(fx.PRODUCT_GROUPS), b["cy_yesterday"])


@query("revenue_union")
def q_revenue_union(spark, sf_dir):
    fx.register(spark, sf_dir)
    r = _revenue(spark)
    return r.select("Store_ID", "Business_Date", F.col("Amount").cast("double").alias("Amount"))


@query("store_lookup")
def q_store_lookup(spark, sf_dir):
    fx.register(spark, sf_dir)
    r = rv.store_lookup(_t(spark, "fx_embed_sales"), _t(spark, "fx_stores"))
    return r.withColumn("Amount", F.col("Amount").cast("double"))


@query("location_sales")
def q_location_sales(spark, sf_dir):
    fx.register(spark, sf_dir)
    return rv.location_sales(_revenue(spark), _report_stores(spark), _bounds(spark))


@query("combined_activity")
def q_combined_activity(spark, sf_dir):
    fx.register(spark, sf_dir)
    c = _combined(spark, _bounds(spark))
    return c.select("Store_ID", "GroupName", "GameName", F.col("Amount").cast("double").alias("Amount"),
                    "Business_Date", "Source",
                    F.col("PayOut_Percentage").cast("double").alias("PayOut_Percentage"),
                    F.col("MoneyOUT").cast("double").alias("MoneyOUT"),
                    F.col("Collection").cast("double").alias("Collection"))


@query("group_scaffold")
def q_group_scaffold(spark, sf_dir):
    fx.register(spark, sf_dir)
    return rv.group_scaffold(_report_stores(spark), _t(spark, "fx_game_activity"))


@query("national_average")
def q_national_average(spark, sf_dir):
    fx.register(spark, sf_dir)
    b = _bounds(spark)
    return rv.national_average(_combined(spark, b), _report_stores(spark), b["cy_start_of_week"], b["cy_yesterday"])


def _keep_games(spark):
    return lambda games: _sinks.stage(spark, games, scratch_path(spark, "equipment-games"))


@query("location_equipment")
def q_location_equipment(spark, sf_dir):
    fx.register(spark, sf_dir)
    b = _bounds(spark)
    return rv.location_equipment(_combined(spark, b), _report_stores(spark), b, _keep_games(spark))


@query("staged_equipment")
def q_staged_equipment(spark, sf_dir):
    """The combined activity staged once, then read by two reports: its games per store beside the equipment report."""
    fx.register(spark, sf_dir)
    b = _bounds(spark)
    staged = _sinks.stage(spark, _combined(spark, b), scratch_path(spark, "combined-activity"))
    games = staged.groupBy("Store_ID").agg(F.count_distinct("GameName").alias("games"))
    return rv.location_equipment(staged, _report_stores(spark), b, _keep_games(spark)).join(games, "Store_ID")


# ---------------------------------------------------------------- dates
@query("period_bounds")
def q_period_bounds(spark, sf_dir):
    fx.register(spark, sf_dir)
    return period_bounds(_t(spark, "fx_date_dim"))


@query("week_number")
def q_week_number(spark, sf_dir):
    fx.register(spark, sf_dir)
    d = _t(spark, "fx_date_dim").select("FULL_DATE")
    return d.select("FULL_DATE", week_number("FULL_DATE").alias("Week"), F.year("FULL_DATE").alias("Year"),
                    F.month("FULL_DATE").alias("Month"), day_of_week("FULL_DATE").alias("Week_Day"))


# ---------------------------------------------------------------- advertising feeds
from .functions import decode as _dec  # noqa: E402
from .functions.catalog import register_class_functions  # noqa: E402
from .functions import rules as _rules  # noqa: E402
from .operators import canonical as _canon  # noqa: E402
from .operators import slices as _slices  # noqa: E402
from .plans import feeds as _feeds  # noqa: E402


def _search_ads_report(spark) -> DataFrame:
    return _feeds.rename(_t(spark, "fx_in_search_ads"), _feeds.SEARCH_ADS_HEADER)


def _initiatives(spark) -> DataFrame:
    return _t(spark, "fx_initiatives").select(F.col("url").alias("URL"), F.col("initiative").alias("INICIATIVA"))


def _paid_search_sheet(spark) -> DataFrame:
    return _t(spark, "fx_in_paid_search").toDF(*_feeds.PAID_SEARCH_HEADER)


NATIVE_AS_OF, NATIVE_DAYS = "1997-03-31", 90


def _native_report(spark) -> DataFrame:
    return _feeds.rename(_t(spark, "fx_in_native"), _feeds.NATIVE_HEADER)


def _retargeting_report(spark) -> DataFrame:
    return _feeds.rename(_t(spark, "fx_in_retargeting"), _feeds.RETARGETING_HEADER)


@query("analytics_load")
def q_analytics_load(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.analytics_load(_t(spark, "fx_in_analytics"))


@query("search_ads_load")
def q_search_ads_load(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.search_ads_load(_search_ads_report(spark), _initiatives(spark))


@query("paid_search_load")
def q_paid_search_load(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.paid_search_load(_paid_search_sheet(spark), _initiatives(spark), fail_on_bad_name=False)[0]


@query("paid_search_rejects")
def q_paid_search_rejects(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.paid_search_load(_paid_search_sheet(spark), fail_on_bad_name=False)[1].drop("__ad")


@query("social_load")
def q_social_load(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.social_load(_t(spark, "fx_in_social"), fail_on_bad_name=False)[0]


@query("social_rejects")
def q_social_rejects(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.social_load(_t(spark, "fx_in_social"), fail_on_bad_name=False)[1]


@query("retargeting_load")
def q_retargeting_load(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.retargeting_load(_retargeting_report(spark))


@query("native_ads_load")
def q_native_ads_load(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.native_ads_load(_native_report(spark), fail_on_bad_name=False)[0]


@query("native_ads_rejects")
def q_native_ads_rejects(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _feeds.native_ads_load(_native_report(spark), fail_on_bad_name=False)[1]


@query("native_ads_window")
def q_native_ads_window(spark, sf_dir):
    """S5 + D8: the landed report read with its spend filter, over the rolling request window."""
    fx.register(spark, sf_dir)
    report = _native_report(spark)
    path = _land.write_csv_parts(report, scratch_path(spark, "native-csv"))
    landed = _rd.read_report(spark, path, report.schema)
    window = request_window(_dt.date.fromisoformat(NATIVE_AS_OF), days=NATIVE_DAYS)
    return _feeds.native_ads_load(landed, fail_on_bad_name=False, window=window)[0]


@query("channel_class")
def q_channel_class(spark, sf_dir):
    fx.register(spark, sf_dir)
    a = _t(spark, "fx_ads")
    return a.select("row_id", _rules.channel_class("campaign", "medium", "content").alias("NOM_DISCIPLINA"),
                    _rules.search_group("campaign", "medium").alias("search_group"))


@query("device_class")
def q_device_class(spark, sf_dir):
    fx.register(spark, sf_dir)
    a = _t(spark, "fx_ads")
    return a.select("row_id", _rules.device_class(F.upper("device"), "a").alias("device_a"),
                    _rules.device_class(F.upper("device"), "b").alias("device_b"))


@query("advertiser_class")
def q_advertiser_class(spark, sf_dir):
    fx.register(spark, sf_dir)
    a = _t(spark, "fx_ads")
    return a.select("row_id", _rules.advertiser_class(F.upper("campaign"), "a").alias("advertiser_a"),
                    _rules.advertiser_class(F.upper("campaign"), "b").alias("advertiser_b"))


@query("pillar")
def q_pillar(spark, sf_dir):
    fx.register(spark, sf_dir)
    a = _t(spark, "fx_ads").select(
        "row_id", F.upper(F.concat("campaign", F.lit("_"), "ad_group")).alias("ad"),
        _rules.advertiser_class(F.upper("campaign"), "a").alias("adv"),
        _rules.channel_class("campaign", "medium", "content").alias("veh"),
        F.upper("ad_group").alias("ini"))
    return a.select("row_id", F.upper(_rules.pillar("ad", "adv", "veh", "ini")).alias("NOM_PILAR"))


@query("decode_ad_layouts")
def q_decode_ad_layouts(spark, sf_dir):
    fx.register(spark, sf_dir)
    layouts = ("analytics_search", "search_ads_long", "search_ads_short", "retargeting")
    a = _t(spark, "fx_ads").select("row_id", F.concat("campaign", F.lit("_"), "ad_group").alias("ad"))
    a = _dec.prepare(a, "ad", layouts)
    cols = [F.col("row_id")]
    for layout in layouts:
        for f, e in _dec.decode(layout).items():
            cols.append(e.alias(f"{layout}__{f}"))
    return a.select(*cols)


def _canonical_cast_input(spark) -> DataFrame:
    a = _t(spark, "fx_ads")
    return a.select(
        F.col("campaign").alias("NOM_AD"), F.col("medium").alias("NOM_DISCIPLINA"), F.col("device").alias("TIP_DEVICE"),
        F.when(F.col("clicks") % 2 == 0, F.date_format("day", "yyyyMMdd"))
         .otherwise(F.col("day").cast("string")).alias("DAT_REFERENCIA"),
        F.col("impressions").alias("QTD_IMPRESSOES"),
        F.when(F.col("clicks") != 1, F.col("clicks")).alias("QTD_CLIQUES"),
        (F.col("spend").cast("double") * 100).alias("QTD_TEMPO_SESSAO"),
        (F.col("spend").cast("double") * -100).alias("QTD_REJEICOES"),
        F.col("spend").cast("string").alias("VAL_INVESTIMENTO"),
        F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00")).alias("HOR_REFERENCIA"),
        F.col("final_url").alias("NOM_URL"))


@query("canonical_cast")
def q_canonical_cast(spark, sf_dir):
    fx.register(spark, sf_dir)
    src = _canonical_cast_input(spark)
    return _canon.canonicalize({c: F.col(c) for c in src.columns}, src)


@query("batch_span")
def q_batch_span(spark, sf_dir):
    fx.register(spark, sf_dir)
    return _slices.batch_span(_feeds.search_ads_rows(_search_ads_report(spark)))


SPLIT_TARGET_BEFORE = _dt.date(1999, 7, 1)   # existing table holds search-ads rows before this date
SPLIT_BATCH_FROM = _dt.date(1999, 1, 1)      # the reloaded batch starts here (overlap is replaced)
UPDATE_SLICE = (_dt.date(1998, 1, 1), _dt.date(1998, 12, 31))


def _target_and_batch(spark, clustered=False):
    """``clustered``: for loads by month, with the rows of a month together."""
    def report(df, day):
        return _slices.clustered_by_period(df, day, _slices.MONTH) if clustered else df

    sa = _feeds.apply_class_functions(_feeds.search_ads_rows(report(_search_ads_report(spark), "Day")), vehicle=True)
    rt = _feeds.retargeting_load(report(_retargeting_report(spark), "Date"))
    target = sa.filter(F.col("DAT_REFERENCIA") < F.lit(SPLIT_TARGET_BEFORE)).unionByName(rt)
    batch = sa.filter(F.col("DAT_REFERENCIA") >= F.lit(SPLIT_BATCH_FROM))
    return target, batch


@query("replace_slice")
def q_replace_slice(spark, sf_dir):
    fx.register(spark, sf_dir)
    target, batch = _target_and_batch(spark)
    return _slices.replace_slice(target, batch, _feeds.SRC_SEARCH_ADS)


@query("update_slice")
def q_update_slice(spark, sf_dir):
    fx.register(spark, sf_dir)
    rows = _feeds.search_ads_rows(_search_ads_report(spark))
    return _slices.update_slice(rows, _feeds.SRC_SEARCH_ADS, *UPDATE_SLICE, device=True, advertiser=True,
                                vehicle=True, names=register_class_functions(spark))


@query("update_initiative")
def q_update_initiative(spark, sf_dir):
    fx.register(spark, sf_dir)
    rows = _feeds.search_ads_rows(_search_ads_report(spark))
    return _slices.update_initiative(rows, _initiatives(spark))


@query("high_water_mark")
def q_high_water_mark(spark, sf_dir):
    fx.register(spark, sf_dir)
    target, _ = _target_and_batch(spark)
    return target.agg(_slices.high_water_mark(target, _feeds.SRC_SEARCH_ADS).alias("hwm_search_ads"),
                      _slices.high_water_mark(target, _feeds.SRC_PARTNER).alias("hwm_partner"),
                      _slices.high_water_mark(target, "NONE").alias("hwm_missing"),
                      _slices.high_water_mark(target).alias("hwm_all"),
                      _slices.high_water_mark(target, days=0).alias("max_all"))


RUN_STAMP = _dt.datetime(2024, 1, 31, 6, 0, 0)


@query("append_load")
def q_append_load(spark, sf_dir):
    """A first load, then a plain append of an overlapping batch; nothing is deleted."""
    fx.register(spark, sf_dir)
    target, batch = _target_and_batch(spark, clustered=True)
    table = scratch_path(spark, "append-load")
    for rows in (target, batch):
        _feeds.run_load(spark, rows, table, _feeds.SRC_SEARCH_ADS, run_ts=RUN_STAMP, mode="append", unit=_slices.MONTH, clustered=True)
    return _slices.read_table(spark, table, [*_canon.CANONICAL_COLUMNS, _canon.LOAD_STAMP])


@query("load_job")
def q_load_job(spark, sf_dir):
    """A first load, an overlapping slice reload run twice, then the initiative update over the table."""
    fx.register(spark, sf_dir)
    target, batch = _target_and_batch(spark, clustered=True)
    table = scratch_path(spark, "load-job")
    _feeds.run_load(spark, target, table, _feeds.SRC_SEARCH_ADS, run_ts=RUN_STAMP, mode="append", unit=_slices.MONTH, clustered=True)
    for _ in range(2):
        _feeds.run_load(spark, batch, table, _feeds.SRC_SEARCH_ADS, run_ts=RUN_STAMP,
                        initiatives=_initiatives(spark), unit=_slices.MONTH, clustered=True)
    return _slices.read_table(spark, table, [*_canon.CANONICAL_COLUMNS, _canon.LOAD_STAMP])


# ---------------------------------------------------------------- sources, sinks, streaming
from pyspark.sql import types as _T  # noqa: E402

from .session import scratch_path  # noqa: E402
from .sources import landing as _land  # noqa: E402
from .sources import readers as _rd  # noqa: E402
from .sources import sinks as _sinks  # noqa: E402
from .streaming.drop_folder import ingest_drop  # noqa: E402

from .plans import jobs as _jobs  # noqa: E402

ANALYTICS_DIMENSIONS, ANALYTICS_METRICS = _jobs.ANALYTICS_DIMENSIONS, list(_jobs.ANALYTICS_METRICS)
PAID_SEARCH_SCHEMA, RETARGETING_SCHEMA, SOCIAL_FIELDS = _jobs.PAID_SEARCH_SCHEMA, _jobs.RETARGETING_SCHEMA, _jobs.SOCIAL_FIELDS


@query("flatten_report")
def q_flatten_report(spark, sf_dir):
    fx.register(spark, sf_dir)
    path = _land.write_analytics_reports(_t(spark, "fx_in_analytics"), scratch_path(spark, "analytics-json"),
                                         ANALYTICS_DIMENSIONS, ANALYTICS_METRICS)
    flat = _rd.flatten_report(spark, path, ANALYTICS_DIMENSIONS + ANALYTICS_METRICS)
    doubles = {"itemRevenue", "avgSessionDuration"}
    return flat.select(
        F.to_date("date").alias("date"), *ANALYTICS_DIMENSIONS[1:],
        *[F.col(m).cast("double" if m in doubles else "long").alias(m) for m in ANALYTICS_METRICS])


@query("repeated_header_csv")
def q_repeated_header_csv(spark, sf_dir):
    fx.register(spark, sf_dir)
    report = _search_ads_report(spark)
    path = _land.write_csv_parts(report, scratch_path(spark, "search-ads-csv"))
    return _rd.read_multi_csv(spark, path, report.columns, key_column="Day")


@query("trimmed_sheet")
def q_trimmed_sheet(spark, sf_dir):
    fx.register(spark, sf_dir)
    sheet = _t(spark, "fx_in_paid_search")
    path = _land.write_sheets(sheet, scratch_path(spark, "paid-search-sheets"), _feeds.PAID_SEARCH_HEADER, packed=True)
    return _rd.read_trimmed(spark, path, head=10, tail=3, schema=PAID_SEARCH_SCHEMA)


@query("delimited_csv")
def q_delimited_csv(spark, sf_dir):
    fx.register(spark, sf_dir)
    path = _land.write_csv_parts(_retargeting_report(spark), scratch_path(spark, "retargeting-csv"), sep=";")
    df = _rd.read_delimited(spark, path, RETARGETING_SCHEMA, sep=";")
    return df if df is not None else spark.createDataFrame([], RETARGETING_SCHEMA)


@query("named_columns_csv")
def q_named_columns_csv(spark, sf_dir):
    """Two landings with their columns in another order, read as one."""
    fx.register(spark, sf_dir)
    report, base = _retargeting_report(spark), scratch_path(spark, "named-csv")
    early = F.col("Date") < F.lit("1995-01-01")
    a = _land.write_csv_parts(report.filter(early), f"{base}/a", sep=";")
    b = _land.write_csv_parts(report.filter(~early).select(*reversed(report.columns)), f"{base}/b", sep=";")
    return _rd.read_delimited(spark, [a, b], RETARGETING_SCHEMA, sep=";")


@query("delimited_rejects")
def q_delimited_rejects(spark, sf_dir):
    """Lines with a cell that does not parse, out of a landing with such lines in it."""
    fx.register(spark, sf_dir)
    report = _retargeting_report(spark)
    cost = F.when(F.col("Imps") == 13, "n/a").otherwise(F.col("Cost (BRL)").cast("string"))
    path = _land.write_csv_parts(report.withColumn("Cost (BRL)", cost), scratch_path(spark, "torn-csv"), sep=";")
    return _rd.delimited_lanes(spark, path, RETARGETING_SCHEMA, sep=";").refused.select("line")


def _torn_extract(spark, path) -> None:
    """Adds extracts of lines that are too short and too long."""
    report = _search_ads_report(spark)
    short = F.concat_ws(",", "Day", "Campaign", "Device")
    _land.write_lines(report.filter("Impressions = 13"), path, short)
    _land.write_lines(report.filter("Impressions = 17"), path, F.concat(short, F.lit(",x" * len(report.columns))))


@query("repeated_header_rejects")
def q_repeated_header_rejects(spark, sf_dir):
    """Lines with too few or too many fields."""
    fx.register(spark, sf_dir)
    report = _search_ads_report(spark)
    path = _land.write_csv_parts(report, scratch_path(spark, "torn-extracts"))
    _torn_extract(spark, path)
    return _rd.multi_csv_lanes(spark, path, report.columns, key_column="Day").refused.select("line")


def _torn_records(spark, path) -> str:
    """Social records, and some that end in the middle."""
    social = _t(spark, "fx_in_social")
    _land.write_records(social, path)
    _land.write_lines(social.filter("impressions = 13"), path, F.concat(F.lit('{"date":"'), "date", F.lit('","adname":"'), "adname"))
    return path


@query("optional_keys_rejects")
def q_optional_keys_rejects(spark, sf_dir):
    """Torn records."""
    fx.register(spark, sf_dir)
    return _rd.record_lanes(spark, _torn_records(spark, scratch_path(spark, "torn-json")), SOCIAL_FIELDS).refused.select("line")


def _job_table(spark, feed: str, paths, initiatives=None) -> DataFrame:
    """The table after a feed's job ran twice on the same landing."""
    base = scratch_path(spark, f"job-{feed}")
    for _ in range(2):
        _jobs.run_job(spark, feed, paths, f"{base}/table", f"{base}/refused", initiatives, RUN_STAMP, _slices.MONTH)
    return _slices.read_table(spark, f"{base}/table", [*_canon.CANONICAL_COLUMNS, _canon.LOAD_STAMP])


@query("analytics_job")
def q_analytics_job(spark, sf_dir):
    """M1 from the landed report to the table, run twice."""
    fx.register(spark, sf_dir)
    path = _land.write_analytics_reports(_t(spark, "fx_in_analytics"), scratch_path(spark, "job-ga"), ANALYTICS_DIMENSIONS, ANALYTICS_METRICS)
    return _job_table(spark, "analytics", path)


@query("paid_search_job")
def q_paid_search_job(spark, sf_dir):
    """M3 from the sheets to the table, run twice: a slice of two disciplines, and the initiative update."""
    fx.register(spark, sf_dir)
    path = _land.write_sheets(_t(spark, "fx_in_paid_search"), scratch_path(spark, "job-sheets"), _feeds.PAID_SEARCH_HEADER, packed=True)
    return _job_table(spark, "paid_search", path, _initiatives(spark))


@query("social_job")
def q_social_job(spark, sf_dir):
    """M4 from the records, torn ones among them, to the table, run twice."""
    fx.register(spark, sf_dir)
    return _job_table(spark, "social", _torn_records(spark, scratch_path(spark, "job-social")))


@query("native_ads_job")
def q_native_ads_job(spark, sf_dir):
    """M6 from the report to the table, run twice."""
    fx.register(spark, sf_dir)
    return _job_table(spark, "native_ads", _land.write_csv_parts(_native_report(spark), scratch_path(spark, "job-native")))


@query("partner_jobs")
def q_partner_jobs(spark, sf_dir):
    """S12 with disciplines: four feeds share the partner's slices of one table, and each rerun replaces only its own disciplines."""
    fx.register(spark, sf_dir)
    base = scratch_path(spark, "partner-jobs")
    landed = {"paid_search": _land.write_sheets(_t(spark, "fx_in_paid_search"), f"{base}/sheets", _feeds.PAID_SEARCH_HEADER, packed=True),
              "social": _land.write_records(_t(spark, "fx_in_social"), f"{base}/social"),
              "retargeting": _land.write_csv_parts(_retargeting_report(spark), f"{base}/retargeting", sep=";"),
              "native_ads": _land.write_csv_parts(_native_report(spark), f"{base}/native")}
    for feed in [*landed, "paid_search"]:
        _jobs.run_job(spark, feed, landed[feed], f"{base}/table", f"{base}/refused/{feed}", run_ts=RUN_STAMP, unit=_slices.MONTH)
    table = _slices.read_table(spark, f"{base}/table")
    return table.groupBy("NOM_SITE", "NOM_DISCIPLINA", F.year("DAT_REFERENCIA").alias("ano")).agg(
        F.count("*").alias("linhas"), F.sum("QTD_IMPRESSOES").alias("impressoes"), F.round(F.sum("VAL_INVESTIMENTO"), 2).alias("investimento"))


@query("incremental_load")
def q_incremental_load(spark, sf_dir):
    """S17 as the bound of a load: of extracts landed by month, only those from the high-water mark on are read and replaced."""
    fx.register(spark, sf_dir)
    base = scratch_path(spark, "incremental")
    target, _ = _target_and_batch(spark, clustered=True)
    _feeds.run_load(spark, target, f"{base}/table", _feeds.SRC_SEARCH_ADS, run_ts=RUN_STAMP, mode="append", unit=_slices.MONTH, clustered=True)
    report = _search_ads_report(spark).withColumn("landed", F.trunc(F.col("Day").cast("date"), "month"))
    path = _land.write_csv_parts(report, f"{base}/extracts", by="landed")
    _torn_extract(spark, f"{path}/landed=1999-07-01")
    _jobs.run_job(spark, "search_ads", path, f"{base}/table", f"{base}/refused", run_ts=RUN_STAMP, unit=_slices.MONTH, since=("landed", "Day"))
    return _slices.read_table(spark, f"{base}/table", [*_canon.CANONICAL_COLUMNS, _canon.LOAD_STAMP])


@query("optional_keys_json")
def q_optional_keys_json(spark, sf_dir):
    fx.register(spark, sf_dir)
    social = _t(spark, "fx_in_social").withColumn(
        "device_platform", F.when(F.col("device_platform") != "tv", F.col("device_platform")))
    base = scratch_path(spark, "social-json")
    cut = F.col("date") < F.lit("1998-01-01")
    a = _land.write_records(social.filter(cut), f"{base}/account_a")
    b = _land.write_records(social.filter(~cut), f"{base}/account_b")
    return _rd.read_records(spark, [a, b], SOCIAL_FIELDS)


@query("valid_drop_file")
def q_valid_drop_file(spark, sf_dir):
    fx.register(spark, sf_dir)
    f = _t(spark, "fx_files")
    return f.select("file_id", "file_stem", _rd.valid_drop_file("file_stem", "bing").alias("valid_bing"),
                    _rd.valid_drop_file("file_stem", "rtbhouse").alias("valid_rtbhouse"))


@query("raw_snapshot")
def q_raw_snapshot(spark, sf_dir):
    fx.register(spark, sf_dir)
    report = _search_ads_report(spark)
    path = _sinks.write_snapshot(report, scratch_path(spark, "snapshots"), "adwords",
                                 _dt.date.fromisoformat(fx.AS_OF))
    schema = _T.StructType([_T.StructField(c, _T.StringType()) for c in report.columns])
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query("full_refresh")
def q_full_refresh(spark, sf_dir):
    fx.register(spark, sf_dir)
    report = vd.labor_cost(_t(spark, "fx_labor_hourly"), _t(spark, "fx_sales_summary"))
    path = scratch_path(spark, "labor-cost-table")
    cols = ["Store_Id", "Work_Date", "Week_Day", "Hour", "Labor_cost", "Hours_Worked", "Sales", "HourAMPM"]
    _sinks.refresh(report, path, cols)
    _sinks.refresh(report, path, cols)   # a rerun replaces, never doubles
    return spark.read.parquet(path)


@query("drop_folder_stream")
def q_drop_folder_stream(spark, sf_dir):
    fx.register(spark, sf_dir)
    base = scratch_path(spark, "drop-rtbhouse")
    report = _retargeting_report(spark)
    sample = report.filter(F.col("Date") == "1996-05-05")
    _land.write_drop_files(spark, report, "Date", f"{base}/staging", f"{base}/inbox", "rtbhouse", sep=";",
                           extra={"report_rtbhouse.csv": sample, "20241331_rtbhouse.csv": sample})
    ingest_drop(spark, f"{base}/inbox", f"{base}/archive", f"{base}/checkpoint", f"{base}/table",
                f"{base}/errors", "rtbhouse", RETARGETING_SCHEMA, _feeds.retargeting_load,
                _feeds.SRC_PARTNER, disciplines=[_feeds.SITE_RETARGETING], sep=";",
                valid=F.try_to_date("Date", "yyyy-MM-dd").isNotNull(), unit=_slices.MONTH, together=True)
    return _slices.read_table(spark, f"{base}/table", list(_canon.CANONICAL_COLUMNS))
