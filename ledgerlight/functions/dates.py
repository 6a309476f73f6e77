"""Calendar arithmetic as Column expressions.

All functions are built-in Spark expressions, so they stay inside whole-stage
codegen and fold to constants when given literals.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week(c) -> Column:
    """Day of week with Sunday = 1 (US-English session default)."""
    return F.dayofweek(_c(c))


def week_number(c) -> Column:
    """Week of year, Monday first, week 1 holds 1 January (not ISO)."""
    d = _c(c)
    offset = F.dayofyear(d) - 1 + F.weekday(F.trunc(d, "YEAR"))
    return (F.floor(offset / F.lit(7)) + 1).cast("int")


def week_start(c) -> Column:
    """Monday of the week holding ``c``."""
    return F.date_trunc("week", _c(c)).cast("date")


def week_end(c) -> Column:
    """Sunday closing the Monday-first week holding ``c``."""
    return F.date_add(week_start(c), 6)


def request_window(as_of: _dt.date, days: int = 7) -> tuple[_dt.date, _dt.date]:
    """Rolling request window, ``as_of - (days + 1)`` .. ``as_of - 1``."""
    return as_of - _dt.timedelta(days=days + 1), as_of - _dt.timedelta(days=1)


def period_bounds(calendar: DataFrame, as_of: str = "FULL_DATE",
                  prior_saturday_sunday_offset: int = 9) -> DataFrame:
    """Report period bounds for every as-of date of a calendar table.

    ``calendar`` has FULL_DATE, PY_DATE, PY_DAY_OF_WEEK.  Each calendar row is
    treated as an as-of date; prior-year dates are looked up for *yesterday*
    (a missing calendar row gives null prior-year bounds).
    """
    # One row per calendar date, so the lookup cannot multiply rows.
    lookup = (calendar.groupBy("FULL_DATE")
              .agg(F.max("PY_DATE").alias("py_yesterday"),
                   F.max("PY_DAY_OF_WEEK").alias("py_day_of_week"))
              .withColumnRenamed("FULL_DATE", "cy_yesterday"))
    base = calendar.select(F.col(as_of).alias("as_of")).distinct()
    base = base.select("as_of", F.date_sub("as_of", 1).alias("cy_yesterday"))
    wk = week_start("cy_yesterday")
    out = base.join(lookup, "cy_yesterday", "left")
    return out.select(
        "as_of",
        "cy_yesterday",
        F.date_sub("as_of", 2).alias("cy_ereyesterday"),
        F.trunc("cy_yesterday", "YEAR").alias("cy_start_of_year"),
        F.trunc("cy_yesterday", "MONTH").alias("cy_start_of_month"),
        wk.alias("cy_start_of_week"),
        F.when(F.dayofweek("cy_yesterday") == 1,
               F.date_sub(wk, prior_saturday_sunday_offset))
         .otherwise(F.date_sub(wk, 2)).alias("cy_prior_saturday"),
        "py_yesterday",
        F.trunc("py_yesterday", "YEAR").alias("py_start_of_year"),
        F.trunc("py_yesterday", "MONTH").alias("py_start_of_month"),
        "py_day_of_week",
        week_start("py_day_of_week").alias("py_start_of_week"),
    )


def report_bounds(calendar: DataFrame, as_of: _dt.date | str,
                  prior_saturday_sunday_offset: int = 9) -> dict:
    """Bounds for one as-of date, as driver-side literals (one small row).

    The current-year bounds are pure arithmetic on the parameter; only the two
    prior-year dates need the calendar, fetched as a single filtered row.
    Literal bounds let Catalyst push date filters into every scan.
    """
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    y = as_of - _dt.timedelta(days=1)
    wk = y - _dt.timedelta(days=y.weekday())
    sunday = y.weekday() == 6
    row = (calendar.filter(F.col("FULL_DATE") == F.lit(y))
           .agg(F.max("PY_DATE").alias("py_yesterday"),
                F.max("PY_DAY_OF_WEEK").alias("py_day_of_week"))
           .first())
    py_y = row["py_yesterday"] if row else None
    py_dow = row["py_day_of_week"] if row else None
    return {
        "as_of": as_of,
        "cy_yesterday": y,
        "cy_ereyesterday": as_of - _dt.timedelta(days=2),
        "cy_start_of_year": y.replace(month=1, day=1),
        "cy_start_of_month": y.replace(day=1),
        "cy_start_of_week": wk,
        "cy_prior_saturday": wk - _dt.timedelta(days=prior_saturday_sunday_offset if sunday else 2),
        "py_yesterday": py_y,
        "py_start_of_year": py_y.replace(month=1, day=1) if py_y else None,
        "py_start_of_month": py_y.replace(day=1) if py_y else None,
        "py_day_of_week": py_dow,
        "py_start_of_week": (py_dow - _dt.timedelta(days=py_dow.weekday())) if py_dow else None,
    }


def current_week(as_of: _dt.date | str) -> tuple[_dt.date, _dt.date]:
    """Monday..Sunday around the as-of date (hours-worked schedule window)."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    start = as_of - _dt.timedelta(days=as_of.weekday())
    return start, start + _dt.timedelta(days=6)
