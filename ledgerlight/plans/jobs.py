"""Feed jobs (M1-M6) from landed file to stored table.

A job is a description: how its files are read, with the lane for lines that do
not fit; the transformation, with the lane for rows refused by name; the source
and disciplines of its slice; whether the initiative update follows.  ``run_job``
is the same for all six feeds: read, transform, keep what was refused, replace
the slice, update.  A rerun gives the same table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import slices
from ..session import scratch_path
from ..sources import readers as rd
from ..sources.sinks import stage
from . import feeds


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# The columns of each landed report and their types.
ANALYTICS_DIMENSIONS = ["date", "campaign", "sourceMedium", "keyword", "adGroup", "adContent", "deviceCategory"]
ANALYTICS_METRICS = {"itemRevenue": "double", "avgSessionDuration": "double", "pageviews": "long", "bounces": "long", "transactions": "long",
                     "sessions": "long", "newUsers": "long", "itemQuantity": "long", "metric1": "long"}
PAID_SEARCH_SCHEMA = _schema(**dict(zip(feeds.PAID_SEARCH_HEADER, [
    T.DateType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.StringType(), T.IntegerType(), T.IntegerType(), T.StringType()])))
RETARGETING_SCHEMA = _schema(**dict(zip(feeds.RETARGETING_HEADER.values(), [
    T.StringType(), T.StringType(), T.StringType(), T.IntegerType(), T.IntegerType(), T.DoubleType()])))
NATIVE_SCHEMA = _schema(**dict(zip(feeds.NATIVE_HEADER.values(), [
    T.StringType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.StringType(), *[T.IntegerType()] * 5])))
SOCIAL_FIELDS = ["date", "adname", "impressions", "spend", "device_platform"]
PAID_SEARCH_DISCIPLINES = ("BING_LP_BRAND", "BING_LP_NON-BRAND")


@dataclass(frozen=True)
class FeedJob:
    """What one feed does differently from the others."""
    source: str
    date: str                                       # date column of its files
    read: Callable[..., rd.Landed]                  # (spark, paths, only, keep, scratch) -> rows and refused lines
    load: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]]     # -> canonical rows, rows refused by name
    disciplines: tuple[str, ...] | None = None
    initiatives: bool = False


def _read_analytics(spark, paths, only=None, keep=None, scratch=None) -> rd.Landed:
    flat = rd.flatten_report(spark, paths, [*ANALYTICS_DIMENSIONS, *ANALYTICS_METRICS])
    rows = flat.select(*ANALYTICS_DIMENSIONS, *[F.col(m).cast(t).alias(m) for m, t in ANALYTICS_METRICS.items()])
    return rd.Landed(keep(rows) if keep else rows, spark.createDataFrame([], "file_name string, line string"))      # a report of another shape fails the job


def _read_social(spark, paths, only=None, keep=None, scratch=None) -> rd.Landed:
    landed = rd.record_lanes(spark, paths, SOCIAL_FIELDS, keep)
    return landed._replace(rows=landed.rows.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in ("impressions", "spend")}))


JOBS: dict[str, FeedJob] = {
    "analytics": FeedJob(feeds.SRC_ANALYTICS, "date", _read_analytics, lambda df: (feeds.analytics_load(df), None)),
    "search_ads": FeedJob(feeds.SRC_SEARCH_ADS, "Day",
                          lambda spark, paths, only=None, keep=None, scratch=None: rd.multi_csv_lanes(
                              spark, paths, list(feeds.SEARCH_ADS_HEADER.values()), "Day", only=only, keep=keep),
                          lambda df: (feeds.search_ads_load(df), None), initiatives=True),
    "paid_search": FeedJob(feeds.SRC_PARTNER, "Date", lambda spark, paths, only=None, keep=None, scratch=None: rd.sheet_lanes(
                               spark, paths, 10, 3, PAID_SEARCH_SCHEMA, keep=keep, scratch=scratch),
                           lambda df: feeds.paid_search_load(df, fail_on_bad_name=False), PAID_SEARCH_DISCIPLINES, initiatives=True),
    "social": FeedJob(feeds.SRC_PARTNER, "date", _read_social, lambda df: feeds.social_load(df, fail_on_bad_name=False), (feeds.SITE_SOCIAL,)),
    "retargeting": FeedJob(feeds.SRC_PARTNER, "Date", lambda spark, paths, only=None, keep=None, scratch=None: rd.delimited_lanes(
                               spark, paths, RETARGETING_SCHEMA, keep=keep),
                           lambda df: (feeds.retargeting_load(df), None), (feeds.SITE_RETARGETING,)),
    "native_ads": FeedJob(feeds.SRC_PARTNER, "Day", lambda spark, paths, only=None, keep=None, scratch=None: rd.report_lanes(
                              spark, paths, NATIVE_SCHEMA, keep=keep),
                          lambda df: feeds.native_ads_load(df, fail_on_bad_name=False), (feeds.SITE_NATIVE,)),
}


def mark_of(spark: SparkSession, table_dir: str, source: str, days: int = 7) -> Column:
    """S17 as a filter value: the source's last stored date less ``days``, found when the query that uses it runs."""
    stored = slices.read_table(spark, table_dir, [slices.SOURCE_COL, slices.DATE_COL])
    if stored is None:
        return F.lit("1900-01-01").cast("date")
    stored = stored.filter(F.col(slices.SOURCE_COL) == F.lit(source))
    return stored.agg(slices.high_water_mark(stored, source, days).alias("mark")).scalar()


def run_job(spark: SparkSession, feed: str, paths: str | Sequence[str], table_dir: str, refused_dir: str,
            initiatives: DataFrame | None = None, run_ts=None, unit: str = slices.DAY, since: tuple[str, str] | None = None) -> tuple | None:
    """Loads the landed files of ``feed`` and returns the span of the slice (None: nothing to load).

    ``refused_dir`` gets ``lines`` (file_name, line) that do not fit and, for feeds that refuse by name, ``names``; each run replaces them.
    ``since``: (partition column of the landed folder, date column): only folders and rows from the high-water mark on are
    read; the folder's column holds the first day of a month.  Feeds read with ``only`` (search ads) take it.
    """
    job = JOBS[feed]
    mark = mark_of(spark, table_dir, job.source) if since else None
    scratch = scratch_path(spark, f"landed-{feed}")

    def keep(parsed: DataFrame) -> DataFrame:
        """Parsed once for both lanes, span, write and names, and shuffled here, where the rows are narrow."""
        return stage(spark, slices.clustered_by_period(parsed, job.date, unit), f"{scratch}/parsed")

    try:
        landed = job.read(spark, paths, only=F.col(since[0]) >= F.trunc(mark, "month") if since else None, keep=keep, scratch=scratch)
        new = landed.rows.filter(F.col(f"`{since[1]}`").cast("date") >= mark) if since else landed.rows
        rows, named = job.load(new)
        landed.refused.write.mode("overwrite").option("compression", "gzip").json(f"{refused_dir}/lines")
        if named is not None:
            named.write.mode("overwrite").option("ignoreNullFields", False).option("compression", "gzip").json(f"{refused_dir}/names")
        return feeds.run_load(spark, rows, table_dir, job.source, job.disciplines, run_ts=run_ts, unit=unit,
                              initiatives=initiatives if job.initiatives else None, clustered=True)
    finally:
        fs, at = slices._fs(spark, scratch)
        fs.delete(at, True)
