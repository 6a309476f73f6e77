"""The six advertising feed loads (M1-M6) as narrow DataFrame projections.

Every row loop of the source becomes Column expressions: the channel rules
are one CASE chain, the ad-name decode one ``split`` per row, classes and
casts one projection.  A feed batch is therefore map-only (no shuffle) until
the slice swap in :mod:`ledgerlight.operators.slices`.

"Whole run fails" (a short ad name in feeds that index tokens blindly) is
kept as ``fail_on_bad_name=True``: a ``raise_error`` inside the plan aborts
the job.  With ``False`` the batch is split into loadable rows and a
quarantine frame.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decode as dec
from ..functions.rules import (CAMPAIGN_AD_GROUP_VEHICLES, advertiser_class, brand_split, channel_class,
                               contains_any, device_class, named_function, pillar, search_group)
from ..functions.text import clean_url, hour_time, micros, quartile_flag
from ..operators.canonical import canonicalize

# Source tags and site/discipline labels written by each feed.
SRC_ANALYTICS = "GA"
SRC_SEARCH_ADS = "ADWORDS"
SRC_PARTNER = "PARCEIRO"
SITE_PAID_SEARCH = "BING_LP"
SITE_SOCIAL = "FACEBOOK"
SITE_RETARGETING = "RTBHOUSE"
SITE_NATIVE = "VERIZON"

# Header of each landed report (feed readers rename fixture columns to these).
SEARCH_ADS_HEADER = {
    "ad_group": "Ad group", "campaign": "Campaign", "cost": "Cost", "day": "Day", "device": "Device",
    "video_100": "Video played to 100%", "video_25": "Video played to 25%", "video_50": "Video played to 50%",
    "video_75": "Video played to 75%", "views": "Views", "campaign_state": "Campaign state",
    "clicks": "Clicks", "impressions": "Impressions", "final_url": "Final URL",
}
PAID_SEARCH_HEADER = ["Date", "Nome_Campanha", "Tipo_Anuncio", "Grupo_Anuncio", "Gastos", "Dispositivo",
                      "Visualizações", "Cliques", "URL Final"]
RETARGETING_HEADER = {"date": "Date", "size": "Size", "device": "Device", "imps": "Imps", "clicks": "Clicks",
                      "cost_brl": "Cost (BRL)"}
NATIVE_HEADER = {"day": "Day", "hour": "Hour", "device_type": "Device Type", "spend": "Spend",
                 "ad_group_name": "Ad Group Name", "video_views": "Video Views",
                 "video_25": "Video 25% Complete", "video_50": "Video 50% Complete",
                 "video_75": "Video 75% Complete", "video_100": "Video 100% Complete"}


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _guard_names(df: DataFrame, ok: Column, fail_on_bad_name: bool, feed: str):
    """Returns (loadable, quarantine).  With ``fail_on_bad_name`` a bad row
    raises inside the plan, like the source aborting the whole run."""
    if fail_on_bad_name:
        checked = df.withColumn("__ok", F.when(ok, F.lit(True)).otherwise(
            F.raise_error(F.lit(f"{feed}: ad name has too few '_' tokens"))))
        return checked.filter("__ok").drop("__ok"), None
    flagged = df.withColumn("__ok", F.coalesce(ok, F.lit(False)))
    return flagged.filter("__ok").drop("__ok"), flagged.filter(~F.col("__ok")).drop("__ok")


def _decoded(layout: str) -> dict[str, Column]:
    return dec.decode(layout)


# ---------------------------------------------------------------------------
# M1 analytics
# ---------------------------------------------------------------------------
def analytics_load(rows: DataFrame, advertiser_variant: str = "a") -> DataFrame:
    """``rows``: flattened analytics report (dims + metrics as columns)."""
    df = rows.filter(F.col("campaign").contains("alp"))
    # Stage 1: the two rule chains, evaluated once per row.
    df = df.select("*",
                   channel_class("campaign", "sourceMedium", "adContent").alias("__vehicle"),
                   search_group("campaign", "sourceMedium").alias("__group"))
    use_pair = contains_any("__vehicle", CAMPAIGN_AD_GROUP_VEHICLES) & (F.col("adGroup") != "(not set)")
    df = df.select("*", F.when(use_pair, F.concat("campaign", F.lit("_"), "adGroup"))
                   .otherwise(F.col("adContent")).alias("__ad"))
    df = dec.prepare(df, "__ad", ["analytics_search", "analytics_other"])
    ad, grp, veh = F.col("__ad"), F.col("__group"), F.col("__vehicle")
    n = F.col(dec.COUNT_COL)
    is_s = (grp == "GA_SEARCH") & (n == 9)
    is_o = (grp == "GA_NOM_SEARCH") & (n == 10)
    ts = lambda i: dec.token("analytics_search", i)
    to = lambda i: dec.token("analytics_other", i)
    s_fields, o_fields = _decoded("analytics_search"), _decoded("analytics_other")
    fields = {f: F.when(is_s, s_fields[f]).when(is_o, o_fields[f]) for f in dec.FIELDS}
    adv_s = advertiser_class(F.upper(F.concat(ts(0), F.lit("_"), ts(1))), advertiser_variant)
    adv_o = advertiser_class(F.upper(to(1)), advertiser_variant)
    df = df.select("*", F.when(is_s, adv_s).when(is_o, adv_o).otherwise(F.lit("OUTROS")).alias("__adv"),
                   *[v.alias(k) for k, v in fields.items()])
    adv = F.col("__adv")
    nonblank = lambda c: c.isNotNull() & (c != "")
    pil_s = F.when(is_s & nonblank(ad) & nonblank(ts(0)) & nonblank(ts(3)),
                   pillar(F.upper(ad), adv, veh, F.upper(ts(3))))
    pil_o = F.when(is_o & nonblank(ad) & nonblank(to(0)) & nonblank(to(4)),
                   pillar(F.upper(ad), adv, veh, F.upper(to(4))))
    exprs = {
        "DAT_REFERENCIA": F.col("date"), "QTD_VISITAS": F.col("sessions"),
        "QTD_NOVOS_USUARIOS": F.col("newUsers"), "QTD_REJEICOES": F.col("bounces"),
        "QTD_TEMPO_SESSAO": F.col("avgSessionDuration").cast("double"), "QTD_PAGEVIEWS": F.col("pageviews"),
        "QTD_TRANSACOES": F.col("transactions"), "QTD_BUSCAS": F.col("metric1"),
        "NOM_ORIGEM_DADOS": F.lit(SRC_ANALYTICS), "NOM_ANUNCIANTE": adv,
        "TIP_DEVICE": device_class(F.upper("deviceCategory"), "a"), "NOM_PALAVRA_CHAVE": F.col("keyword"),
        "NOM_AD": ad, "NOM_DISCIPLINA": veh, "NOM_PILAR": F.coalesce(pil_s, pil_o),
        **{f: F.col(f) for f in dec.FIELDS},
    }
    return canonicalize(exprs, df)


# ---------------------------------------------------------------------------
# M2 search ads
# ---------------------------------------------------------------------------
def search_ads_rows(report: DataFrame) -> DataFrame:
    """Canonical rows of a search-ads report (before the post-load UPDATEs)."""
    name = F.concat(_c("Campaign"), F.lit("_"), _c("Ad group"))
    df = dec.prepare(report.select("*", name.alias("__ad")), "__ad", ["search_ads_short", "search_ads_long"])
    ad = F.col("__ad")
    n = F.col(dec.COUNT_COL)
    short, long_ = _decoded("search_ads_short"), _decoded("search_ads_long")
    exprs = {
        "DAT_REFERENCIA": _c("Day"), "NOM_AD": ad, "VAL_INVESTIMENTO": micros(_c("Cost")),
        "QTD_VIEWS_PLAY": _c("Views"),
        "QTD_VIEWS_25": quartile_flag(_c("Video played to 25%")),
        "QTD_VIEWS_50": quartile_flag(_c("Video played to 50%")),
        "QTD_VIEWS_75": quartile_flag(_c("Video played to 75%")),
        "QTD_VIEWS_100": quartile_flag(_c("Video played to 100%")),
        "NOM_ORIGEM_DADOS": F.lit(SRC_SEARCH_ADS), "QTD_IMPRESSOES": _c("Impressions"),
        "QTD_CLIQUES": _c("Clicks"), "NOM_URL": clean_url(_c("Final URL")),
        "TIP_DEVICE": F.upper(_c("Device")), "NOM_ANUNCIANTE": F.upper(_c("Campaign")),
        "NOM_DISCIPLINA": F.upper(_c("Campaign")),
        **{f: F.when(n == 9, short[f]).when(n == 10, long_[f]) for f in dec.FIELDS},
    }
    return canonicalize(exprs, df)


def apply_class_functions(df: DataFrame, device: bool = True, advertiser: bool = True,
                          vehicle: bool = False, where: Column | None = None, names: Mapping[str, str] | None = None) -> DataFrame:
    """The post-load UPDATE through the class functions.

    ``names``: SQL functions of the session's catalog to call, by kind (``functions.catalog``)."""
    def function(kind: str, value: Column) -> Column:
        return F.call_function(names[kind], value) if names and kind in names else named_function(kind)(value)

    sets = {}
    if device:
        sets["TIP_DEVICE"] = function("device", F.col("TIP_DEVICE"))
    if advertiser:
        sets["NOM_ANUNCIANTE"] = function("advertiser", F.col("NOM_ANUNCIANTE"))
    if vehicle:
        sets["NOM_DISCIPLINA"] = function("vehicle", F.upper(F.col("NOM_DISCIPLINA")))
    cols = []
    for c in df.columns:
        if c in sets:
            e = sets[c] if where is None else F.when(where, sets[c]).otherwise(F.col(c))
            cols.append(e.alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def search_ads_load(report: DataFrame, initiatives: DataFrame | None = None) -> DataFrame:
    from ..operators.slices import update_initiative
    df = apply_class_functions(search_ads_rows(report), device=True, advertiser=True, vehicle=True)
    return update_initiative(df, initiatives) if initiatives is not None else df


# ---------------------------------------------------------------------------
# M3 paid search
# ---------------------------------------------------------------------------
def paid_search_load(sheet: DataFrame, initiatives: DataFrame | None = None,
                     fail_on_bad_name: bool = True, strict_update_filter: bool = True):
    """Returns (rows, quarantine)."""
    from ..operators.slices import update_initiative
    name = F.concat(_c("Nome_Campanha"), F.lit("_"), _c("Grupo_Anuncio"))
    df = dec.prepare(sheet.select("*", name.alias("__ad")), "__ad", ["paid_search"])
    ad = F.col("__ad")
    ok, bad = _guard_names(df, dec.applies("paid_search"), fail_on_bad_name, "paid search")
    f = _decoded("paid_search")
    exprs = {
        "DAT_REFERENCIA": _c("Date"), "VAL_INVESTIMENTO": _c("Gastos"), "NOM_ORIGEM_DADOS": F.lit(SRC_PARTNER),
        "NOM_SITE": F.lit(SITE_PAID_SEARCH), "NOM_AD": ad, "NOM_DISCIPLINA": brand_split(_c("Nome_Campanha")),
        "QTD_CLIQUES": _c("Cliques"), "QTD_IMPRESSOES": _c("Visualizações"), "NOM_URL": _c("URL Final"),
        "TIP_DEVICE": F.upper(_c("Dispositivo")),
        "NOM_ANUNCIANTE": F.upper(dec.token("paid_search", 1)),
        **f,
    }
    rows = canonicalize(exprs, ok)
    bad = dec.drop_prepared(bad) if bad is not None else None
    # The source filters the UPDATE on a discipline that P16 has already
    # replaced, so with the strict filter no row changes.
    target = F.col("NOM_DISCIPLINA") == F.lit(SITE_PAID_SEARCH) if strict_update_filter else F.lit(True)
    rows = apply_class_functions(rows, where=target)
    if initiatives is not None:
        rows = update_initiative(rows, initiatives)
    return rows, bad


# ---------------------------------------------------------------------------
# M4 social (P5d, P10, T1)
# ---------------------------------------------------------------------------
def social_load(records: DataFrame, fail_on_bad_name: bool = True):
    ad = F.col("adname")
    records = dec.prepare(records, "adname", ["social"])
    ok, bad = _guard_names(records, dec.applies("social"), fail_on_bad_name, "social")
    bad = dec.drop_prepared(bad) if bad is not None else None
    f = _decoded("social")
    exprs = {
        "DAT_REFERENCIA": F.col("date"), "VAL_INVESTIMENTO": F.col("spend").cast("double"),
        "NOM_SITE": F.lit(SITE_SOCIAL), "NOM_AD": ad, "QTD_IMPRESSOES": F.col("impressions").cast("long"),
        "NOM_ORIGEM_DADOS": F.lit(SRC_PARTNER), "NOM_DISCIPLINA": F.lit(SITE_SOCIAL),
        "TIP_DEVICE": F.upper("device_platform"), "NOM_ANUNCIANTE": F.upper(f["NOM_CAMPANHA"]),
        **f,
    }
    return apply_class_functions(canonicalize(exprs, ok)), bad


# ---------------------------------------------------------------------------
# M5 retargeting (P5e, P10, T1)
# ---------------------------------------------------------------------------
def retargeting_load(report: DataFrame) -> DataFrame:
    ad = _c("Size")
    report = dec.prepare(report, ad, ["retargeting"])
    ok = dec.applies("retargeting")
    f = _decoded("retargeting")
    exprs = {
        "DAT_REFERENCIA": _c("Date"), "VAL_INVESTIMENTO": _c("Cost (BRL)"),
        "NOM_DISCIPLINA": F.lit(SITE_RETARGETING), "NOM_SITE": F.lit(SITE_RETARGETING), "NOM_AD": ad,
        "NOM_ORIGEM_DADOS": F.lit(SRC_PARTNER),
        "TIP_DEVICE": F.when(ok, F.upper(_c("Device"))),
        "NOM_ANUNCIANTE": F.when(ok, F.upper(dec.token("retargeting", 1))),
        **f,
    }
    return apply_class_functions(canonicalize(exprs, report))


# ---------------------------------------------------------------------------
# M6 native ads (S5, F2, F3, P5f, P10-P12, P15, P17)
# ---------------------------------------------------------------------------
def native_ads_load(report: DataFrame, fail_on_bad_name: bool = True, advertiser_variant: str = "a",
                    window: tuple | None = None):
    """``window``: first and last requested day (D8), both included; None takes every day."""
    if window is not None:
        report = report.filter(_c("Day").cast("date").between(F.lit(window[0]), F.lit(window[1])))
    df = report.filter(_c("Spend") > 0).filter(_c("Ad Group Name").startswith("alp"))
    ad = _c("Ad Group Name")
    df = dec.prepare(df, ad, ["native"])
    ok, bad = _guard_names(df, dec.applies("native"), fail_on_bad_name, "native ads")
    bad = dec.drop_prepared(bad) if bad is not None else None
    f = _decoded("native")
    adv = advertiser_class(F.upper(dec.token("native", 1)), advertiser_variant)
    ok = ok.select("*", adv.alias("__adv"))
    exprs = {
        "DAT_REFERENCIA": _c("Day"), "NOM_ORIGEM_DADOS": F.lit(SRC_PARTNER), "NOM_SITE": F.lit(SITE_NATIVE),
        "QTD_VIEWS_PLAY": _c("Video Views"), "QTD_VIEWS_25": _c("Video 25% Complete"),
        "QTD_VIEWS_50": _c("Video 50% Complete"), "QTD_VIEWS_75": _c("Video 75% Complete"),
        "QTD_VIEWS_100": _c("Video 100% Complete"), "VAL_INVESTIMENTO": _c("Spend"), "NOM_AD": ad,
        "NOM_DISCIPLINA": F.lit(SITE_NATIVE), "HOR_REFERENCIA": hour_time(_c("Hour")),
        "TIP_DEVICE": device_class(F.upper(_c("Device Type")), "b"), "NOM_ANUNCIANTE": F.col("__adv"),
        "NOM_PILAR": pillar(F.upper(ad), F.upper(F.col("__adv")), F.lit(SITE_NATIVE),
                            F.upper(dec.token("native", 4))),
        **f,
    }
    return canonicalize(exprs, ok), bad


# ---------------------------------------------------------------------------
# End-to-end feed job: classified batch -> stamp -> slice reload
# ---------------------------------------------------------------------------
def run_load(spark, rows: DataFrame, table_dir: str, source: str, disciplines=None,
             run_ts=None, mode: str = "replace_slice", initiatives: DataFrame | None = None,
             unit: str = "day", clustered: bool = False):
    """Load one classified feed batch into the stored canonical table.

    ``mode='replace_slice'`` (default) replaces the batch's date slice;
    ``mode='append'`` is the plain append (S13).  ``run_ts`` fixes the load
    stamp (P4); by default it is the session's local timestamp at run time.
    ``unit`` is the table's partition period, ``day`` or ``month``.
    With ``initiatives`` the initiative update then runs over the whole table.
    ``clustered``: ``rows`` come from ``clustered_by_period``.
    Returns the span of the batch (None for an empty batch or an append)."""
    from ..operators.canonical import stamp
    from ..operators.slices import append_rows, reload_initiative, reload_slice, store_initiatives, update_initiative
    from ..session import scratch_path
    if initiatives is not None:
        initiatives = store_initiatives(spark, initiatives, scratch_path(spark, "initiatives"))
        clustered = clustered and initiatives.small
    stamped = stamp(rows, F.lit(run_ts).cast("timestamp_ntz") if run_ts is not None else None)
    span = None
    if mode == "append":
        append_rows(stamped, table_dir, unit, clustered)
    else:
        # The partitions that are written anyway get the update in the same write; the update below finds them done.
        finish = (lambda rows: update_initiative(rows, initiatives)) if initiatives is not None else None
        span = reload_slice(spark, table_dir, stamped, source, disciplines, unit, finish, clustered)
    if initiatives is not None:
        reload_initiative(spark, table_dir, initiatives)
    return span
