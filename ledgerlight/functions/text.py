"""Small text and value helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c) -> Column:
    """Micro-units to currency."""
    return _c(c).cast("double") / F.lit(1000000.0)


def quartile_flag(c) -> Column:
    """Percent text to flag; only the exact text ``0.00`` (after removing %) is 0."""
    return F.when(F.replace(_c(c), F.lit("%"), F.lit("")) == "0.00", F.lit(0)).otherwise(F.lit(1))


def clean_url(c) -> Column:
    """Strip ``[``, ``]`` and ``"`` from a URL list text."""
    return F.translate(_c(c), '[]"', "")


def hour_time(c) -> Column:
    """Hour number to a time of day on 1900-01-01 (``HH:00``)."""
    return F.make_timestamp_ntz(F.lit(1900), F.lit(1), F.lit(1), _c(c).cast("int"), F.lit(0), F.lit(0))


def hour_label(c) -> Column:
    """Hour number to ``HH:00:00`` text."""
    return F.format_string("%02d:00:00", _c(c).cast("int"))


def full_name(last, first) -> Column:
    """``Last, First``; null when either part is null (``+`` semantics)."""
    return F.concat(_c(last), F.lit(", "), _c(first))


def clock_text(c) -> Column:
    """``HH:mm:ss`` of a timestamp."""
    return F.date_format(_c(c), "HH:mm:ss")


def safe_ratio(num, den) -> Column:
    """0 when the denominator is 0, null when it is null."""
    n, d = _c(num), _c(den)
    return F.when(d == 0, F.lit(0.0)).otherwise(n.cast("double") / d.cast("double"))


def underscore_count(c) -> Column:
    """Number of ``_`` in a text (ad-name layout selector)."""
    return F.length(_c(c)) - F.length(F.replace(_c(c), F.lit("_"), F.lit("")))
