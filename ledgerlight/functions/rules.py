"""Ordered classification rules (P11-P16, P24) compiled into ``when`` chains.

Rule tables are data: an ordered list of ``(label, condition)``.  A condition
is a tiny predicate tree over named text inputs (substring tests, equality,
and/or/not).  ``compile_rules`` turns a table into one Spark ``CASE WHEN``
(codegen-friendly, no UDF).

Matching is case-sensitive substring search, first match wins, as in the
source system.  A null input makes a test unknown, which falls through.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


# --------------------------------------------------------------------------
# Predicate tree
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Cond:
    op: str
    field: str | None = None
    values: tuple = ()
    parts: tuple = ()

    def __and__(self, other: "Cond") -> "Cond":
        return Cond("and", parts=(self, other))

    def __or__(self, other: "Cond") -> "Cond":
        return Cond("or", parts=(self, other))

    def __invert__(self) -> "Cond":
        return Cond("not", parts=(self,))

    def column(self, cols: Mapping[str, Column]) -> Column:
        if self.op == "has":
            c = cols[self.field]
            out = None
            for v in self.values:
                t = c.contains(v)
                out = t if out is None else (out | t)
            return out
        if self.op == "eq":
            c = cols[self.field]
            out = None
            for v in self.values:
                t = c == F.lit(v)
                out = t if out is None else (out | t)
            return out
        if self.op == "and":
            return self.parts[0].column(cols) & self.parts[1].column(cols)
        if self.op == "or":
            return self.parts[0].column(cols) | self.parts[1].column(cols)
        if self.op == "not":
            return ~self.parts[0].column(cols)
        raise ValueError(self.op)


def has(field: str, *needles: str) -> Cond:
    """True when ``field`` contains any of the needles."""
    return Cond("has", field, tuple(needles))


def lacks(field: str, *needles: str) -> Cond:
    """True when ``field`` contains none of the needles."""
    return ~has(field, *needles)


def eq(field: str, *values: str) -> Cond:
    return Cond("eq", field, tuple(values))


Rules = list[tuple[str, Cond]]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_condition(cond: Cond, names: Mapping[str, str]) -> str:
    """A condition as SQL over the named expressions."""
    if cond.op in ("has", "eq"):
        test = "contains({}, {})" if cond.op == "has" else "{} = {}"
        return "(" + " OR ".join(test.format(names[cond.field], _text(v)) for v in cond.values) + ")"
    if cond.op == "not":
        return f"(NOT {sql_condition(cond.parts[0], names)})"
    return "(" + f" {cond.op.upper()} ".join(sql_condition(p, names) for p in cond.parts) + ")"


def sql_rules(rules: "Rules", names: Mapping[str, str], default: str) -> str:
    """An ordered rule table as one SQL CASE."""
    arms = " ".join(f"WHEN {sql_condition(cond, names)} THEN {_text(label)}" for label, cond in rules)
    return f"CASE {arms} ELSE {_text(default)} END"


def compile_rules(rules: Rules, cols: Mapping[str, Column], default) -> Column:
    """One ``CASE WHEN`` chain; ``default`` may be a literal or a Column."""
    expr = None
    for label, cond in rules:
        pred = cond.column(cols)
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


# --------------------------------------------------------------------------
# Rule tables that must equal the source system's, in its order.
# --------------------------------------------------------------------------

# P13 channel (vehicle) rules over campaign, medium (source / medium), content.
CHANNEL_RULES: Rules = [
    ("GOOGLE_LP_BRANDING", has("campaign", "branding") & has("medium", "google / cpc")
     & lacks("campaign", "Non-Branding", "smartads", "gdn", "vídeo", "display", "youtube", "inter")),
    ("GOOGLE_LP", has("medium", "google / cpc")
     & lacks("campaign", "branding", "smartads", "gdn", "vídeo", "display", "youtube")),
    ("GOOGLE_LP", has("medium", "google / cpc")
     & lacks("campaign", "smartads", "gdn", "vídeo", "display", "youtube")),
    ("GOOGLE_ADS_GALLERY", has("medium", "google / cpc") & has("campaign", "gallery")),
    ("SMARTADS_GOOGLE", (has("campaign", "smart-ads") | has("content", "smart-ads"))
     & has("medium", "google / cpc", "google-adwords / display", "google-ads-smart-ads / display")),
    ("GOOGLE_GDN", (has("campaign", "gdn") | has("content", "gdn"))
     & has("medium", "google / cpc", "google-adwords / display", "google-ads-gdn / display", "google-gdn / display")),
    ("GOOGLE_DISCOVERY_ADS", (has("campaign", "discovery-ads") | has("content", "discovery-ads"))
     & has("medium", "google / cpc", "google-ads-discovery-ads / display", "google-adwords / display")),
    ("BING_LP", has("medium", "bing / cpc")),
    ("CRITEO", has("medium", "criteo / display")),
    ("FACEBOOK", has("medium", "facebook / social")),
    ("KAYAK_META_SEARCH", has("medium", "kayak / comparador", "kayak / display", "kayak / core")
     & has("content", "metasearch", "meta-search", "cpa", "core")),
    ("KAYAK_DISPLAY", has("medium", "kayak / comparador", "kayak / display")
     & lacks("content", "metasearch", "meta-search", "cpa")),
    ("OATH_BRIGTHROLL", has("medium", "oath / display", "oath-brightroll / programatico")),
    ("VERIZON_GEMINI", has("medium", "oath", "oath-gemini / native", "verizon-gemini / native")),
    ("VERIZON_DSP", has("medium", "verizon-dsp / programatico", "verizon / display", "verizon-dsp / display")),
    ("SKYSCANNER_META_SEARCH", has("medium", "skyscanner / comparador")
     & has("content", "meta-search", "metasearch", "core")),
    ("SKYSCANNER_DISPLAY", has("medium", "skyscanner / comparador", "skyscanner / display")
     & lacks("content", "meta-search", "metasearch", "core")),
    ("TABOOLA", has("medium", "taboola / native", "taboola / display")),
    ("VIAJALA_DISPLAY", has("medium", "viajala / comparador", "viajala / display") & lacks("content", "core")),
    ("VIAJALA_META_SEARCH", has("medium", "viajala / comparador", "viajala / core") & has("content", "core")),
    ("VOOPTER_META_SEARCH", has("medium", "voopter / comparador", "voopter / core")
     & has("content", "meta", "cpa", "core")),
    ("VOOPTER_DISPLAY", has("medium", "voopter / comparador", "voopter / publi-editorial", "voopter / display")
     & lacks("content", "meta", "cpa", "core")),
    ("UOL", has("medium", "uol / display")),
    ("ABRIL", has("medium", "abril / display")),
    ("WEBEDIA", has("medium", "webedia / display")),
    ("TERRA", has("medium", "terra / display")),
    ("RTBHOUSE", has("medium", "rtbhouse / native", "rtbhouse / display", "rtbhouse / programatico")),
    ("TURSIMO_CITY_META_SEARCH", has("medium", "turismocity")),
    ("SEEDTAG", has("medium", "seedtag / display")),
    ("OUTBRAIN", has("medium", "outbrain / native", "outbrain / social")),
    ("XTMEDIA", has("medium", "xtmedia / display", "xtmedia / video")),
    ("GOOGLE_DV360", has("medium", "google / programatico", "google-dv360 / programatico",
                         "google-dv360 / native", "google-dv360 / display")),
    ("GOOGLE_GSP", (has("campaign", "gsp") | has("content", "gsp"))
     & has("medium", "google / cpc", "google-adwords / display", "google-ads-gsp / display")),
    ("OUTLOOK_VERIZON", has("medium", "outlook / display", "oath / outlook", "oath-outlook / programatico")),
    ("LANCENET", has("medium", "lancenet / display")),
    ("FOLHA", has("medium", "folha / display")),
    ("SPOTIFY", has("medium", "spotify / audio", "spotify / programatico", "spotify / display")),
    ("YOUTUBE_DV360", has("medium", "google-dv360 / video", "google-dv360-youtube / programatico")),
    ("JOVEM_NERD", has("medium", "jovem-nerd / content")),
    ("BRAZIL_JOURNAL", has("medium", "brazil-journal / display")),
    ("KIAORA", has("medium", "kiaora-digital / display")),
]
CHANNEL_DEFAULT = "OUTROS"

# P14 search group: exact medium, 'search' in campaign, none of the excluded words.
SEARCH_GROUP_RULES: Rules = [
    ("GA_SEARCH", eq("medium", "google / cpc", "bing / cpc") & has("campaign", "search")
     & lacks("campaign", "smart", "gdn", "discovery-ads")),
]
SEARCH_GROUP_DEFAULT = "GA_NOM_SEARCH"

# P9 vehicles whose ad name is campaign + '_' + ad group (substring test on the label).
CAMPAIGN_AD_GROUP_VEHICLES = ("GOOGLE_LP", "GOOGLE_LP_BRANDING", "GOOGLE_ADS_GALLERY", "SMARTADS_GOOGLE",
                              "GOOGLE_GDN", "GOOGLE_DISCOVERY_ADS", "BING_LP", "GOOGLE_GSP")

# P11 device classes over an upper-cased device text.
DEVICE_RULES_A: Rules = [
    ("DESKTOP", eq("device", "DESKTOP", "TABLET")),
    ("MOBILE", eq("device", "MOBILE")),
]
DEVICE_RULES_B: Rules = [
    ("DESKTOP", eq("device", "DESKTOP", "TABLET")),
    ("MOBILE", eq("device", "SMARTPHONE", "UNKNOWN")),
]
DEVICE_DEFAULT = "CROSS_DEVICE"

# P12 advertiser classes over an upper-cased campaign text.
ADVERTISER_RULES_A: Rules = [
    ("GOL", has("campaign", "VAREJO-NAC", "ALP_MADRUGOL-NACIONAL", "ALP_ACAO-FIM-DE-SEMANA")),
    ("GOL_INTERNACIONAL", has("campaign", "VAREJO-INTER", "ALP_MADRUGOL-INTERNACIONAL")),
    ("GOL_MARCA", has("campaign", "MARCA")),
    ("GOL_RA", has("campaign", "RECEITAS-AUXILIARES")),
    ("GOL_KLM-AF", has("campaign", "KLM-AF")),
    ("GOL_VOEBIZ", has("campaign", "VOEBIZ")),
    ("GOL_LOG", has("campaign", "GOLLOG")),
]
ADVERTISER_DEFAULT_A = "OUTROS"
ADVERTISER_RULES_B: Rules = [
    ("GOL", has("campaign", "VAREJO-NAC")),
    ("GOL_INTERNACIONAL", has("campaign", "VAREJO-INTER")),
    ("GOL_MARCA", has("campaign", "MARCA")),
    ("GOL_RA", has("campaign", "RECEITAS-AUXILIARES")),
]
ADVERTISER_DEFAULT_B = ""

# P15 pillar over upper-cased ad, advertiser, vehicle, initiative.  The source's
# extra guards (a literal 'A|B|C' substring, repeats of earlier arms) are implied
# by first-match order and left out.  The lowercase 'l' is the source's label;
# the canonical upper-casing (P3) turns it into TEST_AND_LEARN.
PILLAR_RULES: Rules = [
    ("COMPARADOR", has("ad", "META-SEARCH", "METASAERCH", "CORE", "CPA")),
    ("VAREJO_INTERNACIONAL", has("advertiser", "GOL_INTERNACIONAL")),
    ("TERMOS_DE_MARCA", eq("vehicle", "GOOGLE_LP_BRANDING")),
    ("RECEITAS_AUXILIARES", has("initiative", "RECEITAS-AUXILIARES")),
    ("TEST_AND_lEARN", has("initiative", "TEST-AND-LEARN")),
    ("AQUISICAO", has("ad", "AQUISICAO_")),
]
PILLAR_DEFAULT = "VAREJO_NACIONAL"

# P24 relabel maps (value -> label, else unchanged).
GAME_CATEGORY_LABELS = {
    "0 Attraction": "Attraction",
    "1 Video": "Video",
    "2 Redemption": "Redemption",
    "3 Coin/Token Rolldown": "Coin/Token Rolldown",
    "4 Merchandise": "Merchandise",
}
GAME_GROUP_LABELS = {"Photo Booth-Instant Win": "Instant Win"}


# --------------------------------------------------------------------------
# Column functions
# --------------------------------------------------------------------------
def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def channel_class(campaign, medium, content) -> Column:
    """Vehicle label from campaign, source/medium and ad content."""
    cols = {"campaign": _c(campaign), "medium": _c(medium), "content": _c(content)}
    return compile_rules(CHANNEL_RULES, cols, CHANNEL_DEFAULT)


def search_group(campaign, medium) -> Column:
    """GA_SEARCH / GA_NOM_SEARCH."""
    cols = {"campaign": _c(campaign), "medium": _c(medium)}
    return compile_rules(SEARCH_GROUP_RULES, cols, SEARCH_GROUP_DEFAULT)


def device_class(device, variant: str = "a") -> Column:
    """Device class of an upper-cased device text."""
    rules = DEVICE_RULES_A if variant == "a" else DEVICE_RULES_B
    return compile_rules(rules, {"device": _c(device)}, DEVICE_DEFAULT)


def advertiser_class(campaign, variant: str = "a") -> Column:
    """Advertiser from an upper-cased campaign text (two rule sets)."""
    if variant == "a":
        return compile_rules(ADVERTISER_RULES_A, {"campaign": _c(campaign)}, ADVERTISER_DEFAULT_A)
    return compile_rules(ADVERTISER_RULES_B, {"campaign": _c(campaign)}, ADVERTISER_DEFAULT_B)


def pillar(ad, advertiser, vehicle, initiative) -> Column:
    """Business pillar (callers apply the blank-token guard)."""
    cols = {"ad": _c(ad), "advertiser": _c(advertiser), "vehicle": _c(vehicle), "initiative": _c(initiative)}
    return compile_rules(PILLAR_RULES, cols, PILLAR_DEFAULT)


def brand_split(campaign) -> Column:
    """P16: 'branding' anywhere in the campaign (also 'non-branding') means BRAND."""
    return F.when(_c(campaign).contains("branding"), F.lit("BING_LP_BRAND")).otherwise(F.lit("BING_LP_NON-BRAND"))


def relabel(c, mapping: Mapping[str, str]) -> Column:
    """CASE value WHEN ... THEN label ... ELSE value END."""
    col = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return col if expr is None else expr.otherwise(col)


def contains_any(c, needles) -> Column:
    col = _c(c)
    out = None
    for n in needles:
        t = col.contains(n)
        out = t if out is None else (out | t)
    return out


# Named scalar functions (the warehouse functions whose bodies are not in
# the source).  Defaults are the rule sets above; a caller may put others in the registry.
def _identity(c: Column) -> Column:
    return c


FUNCTION_REGISTRY = {
    "device": lambda c: device_class(c, "a"),
    "advertiser": lambda c: advertiser_class(c, "a"),
    "vehicle": _identity,
}


def named_function(name: str):
    return FUNCTION_REGISTRY[name]
