"""Underscore-delimited ad-name decoder (P10).

An ad name such as ``a_b_c_..._k`` is split into ten canonical fields.  The
feeds use four position maps and different split limits (SURVEY §2.10).

``prepare`` adds, once per row, the underscore count and one token array per
split limit; every field is then a ``get(tokens, i)`` on that column (null
when out of range, never raises).  Computing the array once matters: each of
the ten fields would otherwise re-split the name inside its own CASE branch,
where subexpression elimination does not reach.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import underscore_count

FIELDS = ("NOM_CAMPANHA", "NOM_ORIGEM", "NOM_MIDIA", "NOM_INICIATIVA", "TIP_CANAL",
          "TIP_COMPRA", "TIP_ESTRATEGIA", "TIP_FORMATO", "NOM_CRIATIVO", "NOM_SEGMENTACAO")

# Zero-based token positions per canonical field, in FIELDS order.
# "0_1" means tokens 0 and 1 joined by '_'.
MAP_SEARCH = ("0_1", 2, 3, 3, 7, 6, 4, 8, 9, 5)     # analytics search group
MAP_LONG = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)          # analytics other, search-ads long, native
MAP_SHORT = (1, 2, 3, 3, 7, 6, 4, 8, 5, 9)          # search-ads short, paid search
MAP_SOCIAL = ("0_1", 2, 3, 4, 5, 6, 7, 8, 9, 10)    # social, retargeting

# Layout name -> (position map, max splits as in str.split(sep, n), min underscores, exact?)
LAYOUTS = {
    "analytics_search": (MAP_SEARCH, 9, 9, True),
    "analytics_other": (MAP_LONG, 10, 10, True),
    "search_ads_short": (MAP_SHORT, 10, 9, True),
    "search_ads_long": (MAP_LONG, 11, 10, True),
    "paid_search": (MAP_SHORT, 10, 9, False),
    "social": (MAP_SOCIAL, 11, 10, False),
    "retargeting": (MAP_SOCIAL, 10, 10, False),
    "native": (MAP_LONG, 11, 10, False),
}

COUNT_COL = "__n_us"


def _needs_limit(layout: str) -> bool:
    """Only a layout that reads the last part of a limited split (which keeps the
    remainder) depends on the limit; every other layout sees the same tokens as
    an unlimited split, so those layouts share one token array."""
    pos_map, max_splits, _, exact = LAYOUTS[layout]
    return (not exact) and max_splits in pos_map


def _limit(layout: str) -> int:
    return LAYOUTS[layout][1] if _needs_limit(layout) else -1


def _tok_col(limit: int) -> str:
    return f"__tok{limit}" if limit >= 0 else "__tok_all"


def tokens(name, max_splits: int) -> Column:
    """Python ``name.split('_', max_splits)``: Spark's limit counts parts."""
    c = F.col(name) if isinstance(name, str) else name
    return F.split(c, "_", max_splits + 1 if max_splits >= 0 else -1)


def prepare(df: DataFrame, name, layouts: Iterable[str]) -> DataFrame:
    """Add the underscore count and the token arrays the layouts need."""
    c = F.col(name) if isinstance(name, str) else name
    limits = sorted({_limit(lay) for lay in layouts})
    return df.select("*", underscore_count(c).alias(COUNT_COL),
                     *[tokens(c, k).alias(_tok_col(k)) for k in limits])


def drop_prepared(df: DataFrame) -> DataFrame:
    return df.drop(COUNT_COL, *[c for c in df.columns if c.startswith("__tok")])


def applies(layout: str) -> Column:
    """Row condition under which the layout fills the fields (after ``prepare``)."""
    _, _, min_us, exact = LAYOUTS[layout]
    n = F.col(COUNT_COL)
    return (n == min_us) if exact else (n >= min_us)


def token(layout: str, index: int) -> Column:
    """Raw token ``index`` under the layout's split limit (after ``prepare``)."""
    return F.get(F.col(_tok_col(_limit(layout))), index)


def _pos(toks: Column, p) -> Column:
    if p == "0_1":
        return F.concat(F.get(toks, 0), F.lit("_"), F.get(toks, 1))
    return F.get(toks, p)


def decode(layout: str) -> dict[str, Column]:
    """Field name -> Column for ``layout`` (after ``prepare``); null when the
    layout does not apply."""
    pos_map = LAYOUTS[layout][0]
    toks = F.col(_tok_col(_limit(layout)))
    ok = applies(layout)
    return {f: F.when(ok, _pos(toks, p)) for f, p in zip(FIELDS, pos_map)}
