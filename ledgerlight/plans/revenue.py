"""Location revenue and equipment reports (R8, R9 and their stages).

Stage 1, ``revenue_union`` (A6): daily revenue per store from four sources.
Stage 2, ``location_sales`` (R8): yesterday / week / month / year to date,
current vs prior year vs the national total.
Stage 3, ``combined_activity`` (U1): game-level activity from five sources.
Stage 4, ``location_equipment`` (R9): 17 measures per game for yesterday.

Scale notes
-----------
* The category master is joined without a store key in the source, so every
  sale line fans out (stores x stores) times.  Here the fan-out is replaced by
  an exact multiplicity: per child category, the number of (child, parent)
  pairs whose parent passes the name test.  Sales are summed per
  (store, date, category) first and multiplied by that weight, so nothing
  grows with the number of stores.
* The 16 correlated subqueries of R9 become one conditional aggregate per key
  level (game, store, group/game) over a date-pruned scan.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_number
from ..functions.rules import GAME_CATEGORY_LABELS, GAME_GROUP_LABELS, relabel
from ..functions.text import safe_ratio
from ..operators.lookups import holds_null, keep_in, top1, unique_lookup, scaffold

FNB_GROUP = "Food, Beverage & Liquor"


# ---------------------------------------------------------------------------
# Stage 1: revenue union
# ---------------------------------------------------------------------------
def category_weights(categories: DataFrame, names: Sequence[str] | DataFrame,
                     category_scope: str = "global") -> DataFrame:
    """Per child category: pairs (C, P) with P.CategoryId = C.ParentCategoryId,
    split by whether P.Name is in ``names`` (w_in) or not in it (w_out).

    ``category_scope='global'`` reproduces the source's join without a store
    key; ``'store'`` also matches the store.  Null parent names count in
    neither (NOT IN drops nulls).
    """
    store = category_scope == "store"
    if isinstance(names, DataFrame):
        key = names.columns[0]
        nm = names.select(F.col(key).alias("__nm")).distinct()
        p = categories.join(nm, F.col("Name") == F.col("__nm"), "left")
        is_in = F.col("__nm").isNotNull()
        # NOT IN a list holding a null is never true.
        p = p.withColumn("__open", ~holds_null(names, key))
        is_out = F.col("__open") & F.col("__nm").isNull() & F.col("Name").isNotNull()
    else:
        p = categories
        is_in = F.col("Name").isin(list(names))
        is_out = ~F.col("Name").isin(list(names))
    pkeys = [F.col("CategoryId").alias("p_id")] + ([F.col("StoreId").alias("p_store")] if store else [])
    p_agg = p.groupBy(*pkeys).agg(
        F.sum(F.when(is_in, 1).otherwise(0)).alias("n_in"),
        F.sum(F.when(is_out, 1).otherwise(0)).alias("n_out"))
    ckeys = ["CategoryId", "ParentCategoryId"] + (["StoreId"] if store else [])
    c = categories.groupBy(*ckeys).agg(F.count(F.lit(1)).alias("n_c"))
    cond = F.col("ParentCategoryId") == F.col("p_id")
    if store:
        cond = cond & (F.col("StoreId") == F.col("p_store"))
    w = (c.join(p_agg, cond, "inner")
         .groupBy("CategoryId", *(["StoreId"] if store else []))
         .agg(F.sum(F.col("n_c") * F.col("n_in")).alias("w_in"),
              F.sum(F.col("n_c") * F.col("n_out")).alias("w_out")))
    return w


def sales_by_category_group(sales_summary: DataFrame, categories: DataFrame, names,
                            which: str, category_scope: str = "global") -> DataFrame:
    """Net sales per (StoreId, Business_Date) over the category self-join,
    restricted to parents whose name is ``in`` / ``out`` of ``names`` / ``all``."""
    w = category_weights(categories, names, category_scope)
    weight = {"in": F.col("w_in"), "out": F.col("w_out"), "all": F.col("w_in") + F.col("w_out")}[which]
    w = w.select("CategoryId", *(["StoreId"] if category_scope == "store" else []),
                 weight.alias("w")).filter(F.col("w") > 0)
    s = (sales_summary.groupBy("StoreId", "Business_Date", "CategoryId")
         .agg(F.sum(F.col("AmountSold") - F.col("AmountReturned")).alias("amt")))
    keys = ["CategoryId"] + (["StoreId"] if category_scope == "store" else [])
    return (s.join(w, keys, "inner")
            .groupBy("StoreId", "Business_Date")
            .agg(F.sum(F.col("amt") * F.col("w")).alias("Amount")))


def store_lookup(embed_sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Card-system sales per external store number, mapped to the store
    number (null when unknown; a duplicated external number raises)."""
    g = (embed_sales.groupBy("store_id", "Business_Date")
         .agg(F.sum(F.col("total_gross_sales") + F.col("coupon_used")).alias("Amount")))
    j = unique_lookup(g, "store_id", stores, "embed_number", ["store_number"],
                      "SCALAR_SUBQUERY_TOO_MANY_ROWS: external store number maps to several stores")
    return j.select(F.col("store_id").alias("Embed_Store_ID"), F.col("store_number").alias("Store_ID"),
                    "Business_Date", "Amount")


def revenue_union(payments: DataFrame, sales_summary: DataFrame, categories: DataFrame,
                  embed_sales: DataFrame, stores: DataFrame, excluded_stores, food_and_beverage,
                  category_scope: str = "global") -> DataFrame:
    """Daily revenue per store; returns Store_ID, Business_Date, Amount (DECIMAL)."""
    pay = (keep_in(payments, "Store_ID", excluded_stores, how="not in")
           .groupBy("Store_ID", "Business_Date").agg(F.sum("Total").alias("Amount")))
    # The two category branches (parent name not in / in the list) together
    # weight each category by all of its qualifying parent pairs.
    sales = (sales_by_category_group(sales_summary, categories, food_and_beverage, "all", category_scope)
             .select(F.col("StoreId").alias("Store_ID"), "Business_Date", "Amount"))
    embed = store_lookup(embed_sales, stores).select("Store_ID", "Business_Date", "Amount")
    return (pay.unionByName(sales).unionByName(embed)
            .groupBy("Store_ID", "Business_Date").agg(F.sum("Amount").alias("Amount")))


# ---------------------------------------------------------------------------
# Stage 2: location sales
# ---------------------------------------------------------------------------
def location_sales(revenue: DataFrame, report_stores, b: dict, split_week_at_year: bool = True) -> DataFrame:
    y = b["cy_yesterday"]
    periods = [
        ("Yesterday", 1, y, y, b["py_day_of_week"], b["py_day_of_week"]),
        ("WTD", 2, b["cy_start_of_week"], y, b["py_start_of_week"], b["py_day_of_week"]),
        ("MTD", 3, b["cy_start_of_month"], y, b["py_start_of_month"], b["py_yesterday"]),
        ("YTD", 4, b["cy_start_of_year"], y, b["py_start_of_year"], b["py_yesterday"]),
    ]
    d = F.col("Business_Date")
    # Literal bounds: the filter reaches every scan under the union.
    cy_lo = min(p[2] for p in periods)
    keep = d.between(F.lit(cy_lo), F.lit(y))
    py_ranges = [(p[4], p[5]) for p in periods if p[4] is not None and p[5] is not None]
    if py_ranges:
        keep = keep | d.between(F.lit(min(r[0] for r in py_ranges)), F.lit(max(r[1] for r in py_ranges)))
    rev = keep_in(revenue.filter(keep), "Store_ID", report_stores)

    tags = []
    for name, sort, lo, hi, plo, phi in periods:
        part = week_number(d) if (name == "WTD" and split_week_at_year) else F.lit(0)
        tags.append(F.when(d.between(F.lit(lo), F.lit(hi)),
                           F.struct(F.lit(name).alias("Period"), F.lit(sort).alias("Periodo_Sort"),
                                    F.lit(True).alias("cy"), part.alias("part"))))
        if plo is not None and phi is not None:
            tags.append(F.when(d.between(F.lit(plo), F.lit(phi)),
                               F.struct(F.lit(name).alias("Period"), F.lit(sort).alias("Periodo_Sort"),
                                        F.lit(False).alias("cy"), F.lit(0).alias("part"))))
    tagged = (rev.select("Store_ID", "Amount", F.explode(F.array(*tags)).alias("t"))
              .filter(F.col("t").isNotNull())
              .select("Store_ID", "Amount", "t.*"))
    # One aggregate over the revenue; prior-year and national figures are then
    # spread over the (tiny) aggregated rows with windows, so the revenue
    # union is computed once.
    agg = (tagged.groupBy("Store_ID", "Period", "Periodo_Sort", "cy", "part")
           .agg(F.sum("Amount").alias("amt")))
    from pyspark.sql import Window
    by_store = Window.partitionBy("Store_ID", "Period")
    by_period = Window.partitionBy("Period")
    out = agg.select(
        "Store_ID", "Period", "Periodo_Sort", "cy", "amt",
        F.max(F.when(~F.col("cy"), F.col("amt"))).over(by_store).alias("PY_Amount"),
        F.sum(F.when(F.col("cy"), F.col("amt"))).over(by_period).alias("National_Sales_CY"),
    ).filter("cy")
    return out.select("Store_ID", "Period", F.col("amt").cast("double").alias("CY_Amount"),
                      F.col("PY_Amount").cast("double").alias("PY_Amount"),
                      F.col("National_Sales_CY").cast("double").alias("National_Sales_CY"),
                      "Periodo_Sort")


# ---------------------------------------------------------------------------
# Stage 3: combined activity
# ---------------------------------------------------------------------------
COMBINED_COLUMNS = ("Store_ID", "GroupName", "GameName", "Amount", "Business_Date", "Source",
                    "PayOut_Percentage", "MoneyOUT", "Collection")


def group_scaffold(report_stores: DataFrame, game_activity: DataFrame) -> DataFrame:
    """Every report store x every game group (original names)."""
    groups = game_activity.select("GroupName").distinct()
    return scaffold(report_stores.select(F.col(report_stores.columns[0]).alias("Store_ID")), "Store_ID",
                    groups, "GroupName")


def game_activity_by_day(game_activity: DataFrame, group_names: DataFrame) -> DataFrame:
    """Attraction groups add passports x price to the collection."""
    kind = top1(group_names, ["GroupName"], ["grp"], "k_")
    g = (game_activity.groupBy("Store_ID", "GroupName", "GameName", "Business_Date")
         .agg(F.sum(F.col("Collection") + F.col("Passports") * F.col("AvgPrice")).alias("amt_attr"),
              F.sum("Collection").alias("amt_coll"),
              F.sum("PayOut_Percentage").alias("PayOut_Percentage"),
              F.sum("MoneyOUT").alias("MoneyOUT"),
              F.sum("Collection").alias("Collection")))
    j = g.join(kind, "GroupName", "left")
    return j.select(
        "Store_ID", relabel("GroupName", GAME_GROUP_LABELS).alias("GroupName"), "GameName",
        F.when(F.col("k_grp") == "Attraction", F.col("amt_attr")).otherwise(F.col("amt_coll")).alias("Amount"),
        "Business_Date", F.lit("Sacoa").alias("Source"), "PayOut_Percentage", "MoneyOUT", "Collection")


def combined_activity(sales_summary: DataFrame, categories: DataFrame, embed_games: DataFrame,
                      stores: DataFrame, product_sales: DataFrame, game_activity: DataFrame,
                      group_names: DataFrame, report_stores: DataFrame, food_and_beverage,
                      product_stores, product_groups, yesterday: _dt.date,
                      category_scope: str = "global") -> DataFrame:
    z = F.lit(0).cast("decimal(18,2)")
    fnb = (sales_by_category_group(sales_summary, categories, food_and_beverage, "in", category_scope)
           .select(F.col("StoreId").alias("Store_ID"), F.lit(FNB_GROUP).alias("GroupName"),
                   F.lit(FNB_GROUP).alias("GameName"), "Amount", "Business_Date",
                   F.lit("Center Edge").alias("Source"), z.alias("PayOut_Percentage"),
                   z.alias("MoneyOUT"), z.alias("Collection")))
    eg = unique_lookup(embed_games, "store_id", stores, "embed_number", ["store_number"],
                       "SCALAR_SUBQUERY_TOO_MANY_ROWS: external store number maps to several stores")
    embed = eg.select(
        F.col("store_number").alias("Store_ID"),
        relabel("game_category", GAME_CATEGORY_LABELS).alias("GroupName"),
        F.col("game_description").alias("GameName"), F.col("value_of_game_play").alias("Amount"),
        "Business_Date", F.lit("Embed").alias("Source"),
        (F.col("percent_ticket_payout") * 100).alias("PayOut_Percentage"),
        (F.col("paper_tickets_issued") + F.col("e_tickets_issued")).alias("MoneyOUT"),
        (F.col("card_value") + F.col("coin_value")).alias("Collection"))
    prod = keep_in(keep_in(product_sales, "Store_ID", product_stores), "ProductGroup", product_groups)
    prod = prod.select("Store_ID", F.col("ProductGroup").alias("GroupName"), F.col("ProductName").alias("GameName"),
                       F.col("Total").alias("Amount"), "Business_Date", F.lit("Sacoa").alias("Source"),
                       z.alias("PayOut_Percentage"), z.alias("MoneyOUT"), z.alias("Collection"))
    games = game_activity_by_day(game_activity, group_names)
    sample = group_scaffold(report_stores, game_activity).select(
        "Store_ID", "GroupName", F.lit("None").alias("GameName"), z.alias("Amount"),
        F.lit(yesterday).alias("Business_Date"), F.lit("Sample").alias("Source"),
        z.alias("PayOut_Percentage"), z.alias("MoneyOUT"), z.alias("Collection"))
    parts = [fnb, embed, prod, games, sample]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*COMBINED_COLUMNS)


# ---------------------------------------------------------------------------
# Stage 4: location equipment
# ---------------------------------------------------------------------------
def national_average(combined: DataFrame, report_stores, week_lo, week_hi) -> DataFrame:
    """A5: per game, the average over report stores of the weekly store sum."""
    d = F.col("Business_Date")
    per_store = (keep_in(combined.filter(d.between(F.lit(week_lo), F.lit(week_hi))), "Store_ID", report_stores)
                 .groupBy("GroupName", "GameName", "Store_ID").agg(F.sum("Amount").alias("amt")))
    named = F.col("GroupName").isNotNull() & F.col("GameName").isNotNull()
    g = (per_store.groupBy("GroupName", "GameName")
         .agg(F.when(F.count("amt") > 0, F.sum("amt").cast("double") / F.count("amt")).alias("avg")))
    # The correlated equality never matches a null name.
    return g.select("GroupName", "GameName", F.when(named, F.col("avg")).alias("CY_National_Average_Collection"))


def location_equipment(combined: DataFrame, report_stores, b: dict, stage_games: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """R9.  ``stage_games`` stores the figures per game, which three parts of the report read; without it each computes them again."""
    y, ere, psat = b["cy_yesterday"], b["cy_ereyesterday"], b["cy_prior_saturday"]
    wk, mon, yr, py = b["cy_start_of_week"], b["cy_start_of_month"], b["cy_start_of_year"], b["py_day_of_week"]
    d = F.col("Business_Date")
    lo = min(wk, mon, yr, psat, ere)
    keep = d.between(F.lit(lo), F.lit(y))
    if py is not None:
        keep = keep | (d == F.lit(py))
    c = keep_in(combined.filter(keep), "Store_ID", report_stores)

    def s(cond: Column, col: str = "Amount") -> Column:
        return F.sum(F.when(cond, F.col(col)))

    is_y, is_ere, is_sat = d == F.lit(y), d == F.lit(ere), d == F.lit(psat)
    in_wk, in_mon, in_yr = d.between(F.lit(wk), F.lit(y)), d.between(F.lit(mon), F.lit(y)), d.between(F.lit(yr), F.lit(y))
    is_py = (d == F.lit(py)) if py is not None else F.lit(False)

    # One aggregate per (store, group, game) over the date-pruned activity.
    # Store totals and the national average are sums / averages of these
    # game-level figures.
    non_fnb = F.col("GroupName") != F.lit(FNB_GROUP)
    games = c.groupBy("Store_ID", "GroupName", "GameName").agg(
        F.max(is_y).alias("has_y"),
        s(is_y).alias("CY_Yest_Collection"),
        s(is_ere).alias("CY_EreYest_Collection"),
        s(is_sat).alias("CY_PriorSaturday_Collection"),
        s(in_wk).alias("CY_Weekly_Collection"),
        s(is_y, "PayOut_Percentage").alias("yest_payout"),
        F.count(F.when(in_wk, 1)).alias("wk_n"),
        s(in_wk, "MoneyOUT").alias("wk_money"),
        s(in_wk, "Collection").alias("wk_coll"),
        s(is_py).alias("PY_Yest_Collection"),
        s(in_mon).alias("CY_MTD_G_Col"),
        s(in_yr).alias("CY_YTD_G_Col"),
        s(is_y & non_fnb).alias("t_y"),
        s(is_ere & non_fnb).alias("t_ere"),
        s(is_sat & non_fnb).alias("t_sat"),
        s(in_wk & non_fnb).alias("t_wk"),
    )
    games = stage_games(games) if stage_games else games
    # Correlated equality never matches a null group or game name.
    named = F.col("GroupName").isNotNull() & F.col("GameName").isNotNull()
    wk = F.col("CY_Weekly_Collection")
    # Partial aggregates per store and per game, joined back to yesterday's
    # games: no task ever holds all rows of a store or game.
    store = games.groupBy(F.col("Store_ID").alias("s_store")).agg(
        F.sum("t_y").alias("CY_Yest_Total"), F.sum("t_ere").alias("CY_PriorDay_Total"),
        F.sum("t_sat").alias("CY_PriorSaturday_Total"), F.sum("t_wk").alias("CY_Weekly_Total"),
        F.sum("CY_MTD_G_Col").alias("CY_Month_Total"), F.sum("CY_YTD_G_Col").alias("CY_Year_Total"))
    nation = games.filter(named).groupBy(F.col("GroupName").alias("n_group"), F.col("GameName").alias("n_game")).agg(
        F.when(F.count(wk) > 0, F.sum(wk).cast("double") / F.count(wk)).alias("CY_National_Average_Collection"))
    j = (games.filter("has_y").join(store, F.col("Store_ID") == F.col("s_store"))
         .join(nation, (F.col("GroupName") == F.col("n_group")) & (F.col("GameName") == F.col("n_game")), "left"))
    dbl = lambda col: F.when(named, F.col(col)).cast("double")
    payout = (F.when(F.col("wk_n") == 0, F.lit(None))
              .otherwise(safe_ratio("wk_money", "wk_coll")))
    return j.select(
        "Store_ID", "GroupName", "GameName",
        F.col("CY_Yest_Collection").cast("double").alias("CY_Yest_Collection"),
        dbl("CY_EreYest_Collection").alias("CY_EreYest_Collection"),
        dbl("CY_PriorSaturday_Collection").alias("CY_PriorSaturday_Collection"),
        dbl("CY_Weekly_Collection").alias("CY_Weekly_Collection"),
        F.col("CY_National_Average_Collection"),
        F.col("CY_Yest_Total").cast("double").alias("CY_Yest_Total"),
        F.col("CY_PriorDay_Total").cast("double").alias("CY_PriorDay_Total"),
        F.col("CY_PriorSaturday_Total").cast("double").alias("CY_PriorSaturday_Total"),
        F.col("CY_Weekly_Total").cast("double").alias("CY_Weekly_Total"),
        F.when(named, F.col("yest_payout") * F.lit(Decimal("0.01"))).cast("double").alias("CY_Yest_PayOut"),
        F.when(named, payout).alias("CY_Weekly_PayOut"),
        dbl("PY_Yest_Collection").alias("PY_Yest_Collection"),
        F.col("CY_Month_Total").cast("double").alias("CY_Month_Total"),
        F.col("CY_Year_Total").cast("double").alias("CY_Year_Total"),
        F.lit(y).alias("CY_Yesterday"),
        dbl("CY_Weekly_Collection").alias("CY_Weekly_G_Col"),
        dbl("CY_MTD_G_Col").alias("CY_MTD_G_Col"),
        dbl("CY_YTD_G_Col").alias("CY_YTD_G_Col"),
    )
