"""Edge rows of FIXTURES.md §4 and every arm of the rule tables (literal rows)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import decode as dec
from ledgerlight.functions import rules as R
from ledgerlight.functions.text import full_name, hour_label, quartile_flag, safe_ratio
from ledgerlight.operators.canonical import cast_by_prefix


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_quartile_flag(spark):
    assert one(spark, [("0.00%",), ("0%",), ("12.5%",)], "v string", quartile_flag("v")) == [0, 1, 1]


def test_cast_by_prefix_truncates_and_fills(spark):
    df = spark.createDataFrame([(12.7, None, "20191101", "a"), (None, 3.5, "2019-11-02", None)],
                               "QTD_X double, VAL_Y double, DAT_REFERENCIA string, NOM_Z string")
    out = cast_by_prefix(df).collect()
    assert [r.QTD_X for r in out] == [12, 0]
    assert [r.VAL_Y for r in out] == [0.0, 3.5]
    assert [r.DAT_REFERENCIA for r in out] == [dt.date(2019, 11, 1), dt.date(2019, 11, 2)]
    assert [r.NOM_Z for r in out] == ["A", None]


def test_negative_quantity_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-28.9,)], "QTD_X double")
    assert cast_by_prefix(df).first().QTD_X == -28


@pytest.mark.parametrize("campaign,medium,content,expected", [
    ("alp_x", "oath / outlook", "", "VERIZON_GEMINI"),
    ("alp_smart-ads", "google / cpc", "", "GOOGLE_LP"),
    ("alp_x", "kayak / core", "banner", "OUTROS"),
    ("alp_x", "kayak / core", "core-cpa", "KAYAK_META_SEARCH"),
    ("alp_branding", "google / cpc", "", "GOOGLE_LP_BRANDING"),
    ("alp_branding_inter", "google / cpc", "", "GOOGLE_LP"),
    ("alp_Non-Branding", "google / cpc", "", "GOOGLE_LP"),
    ("alp_gdn", "google / cpc", "", "GOOGLE_GDN"),
    ("alp_youtube-gallery", "google / cpc", "", "GOOGLE_ADS_GALLERY"),
    ("alp_x", "bing / cpc", "", "BING_LP"),
    ("alp_x", "viajala / display", "banner", "VIAJALA_DISPLAY"),
    ("alp_x", "viajala / display", "core", "OUTROS"),
    ("alp_x", "turismocity / cpa", "", "TURSIMO_CITY_META_SEARCH"),
    ("alp_gsp", "google-adwords / display", "", "GOOGLE_GSP"),
    ("alp_x", "rtbhouse / native", "", "RTBHOUSE"),
    ("alp_x", "(direct) / (none)", "", "OUTROS"),
    ("alp_x", "Google / CPC", "", "OUTROS"),          # case-sensitive
])
def test_channel_rules(spark, campaign, medium, content, expected):
    got = one(spark, [(campaign, medium, content)], "c string, m string, t string",
              R.channel_class("c", "m", "t"))
    assert got == [expected]


def test_channel_rule_table_shape():
    labels = [label for label, _ in R.CHANNEL_RULES]
    assert len(labels) == 41 and len(set(labels)) == 40


@pytest.mark.parametrize("campaign,medium,expected", [
    ("alp_search", "google / cpc", "GA_SEARCH"),
    ("alp_search", "bing / cpc", "GA_SEARCH"),
    ("alp_search-smart", "google / cpc", "GA_NOM_SEARCH"),
    ("alp_search", "google / cpc / x", "GA_NOM_SEARCH"),   # exact medium
])
def test_search_group(spark, campaign, medium, expected):
    assert one(spark, [(campaign, medium)], "c string, m string", R.search_group("c", "m")) == [expected]


def test_device_variants(spark):
    rows = [("DESKTOP",), ("TABLET",), ("MOBILE",), ("SMARTPHONE",), ("UNKNOWN",), ("TV",)]
    assert one(spark, rows, "d string", R.device_class("d", "a")) == \
        ["DESKTOP", "DESKTOP", "MOBILE", "CROSS_DEVICE", "CROSS_DEVICE", "CROSS_DEVICE"]
    assert one(spark, rows, "d string", R.device_class("d", "b")) == \
        ["DESKTOP", "DESKTOP", "CROSS_DEVICE", "MOBILE", "MOBILE", "CROSS_DEVICE"]


def test_advertiser_variants(spark):
    rows = [("ALP_MADRUGOL-NACIONAL",), ("XYZ",), ("ALP_VOEBIZ",)]
    assert one(spark, rows, "c string", R.advertiser_class("c", "a")) == ["GOL", "OUTROS", "GOL_VOEBIZ"]
    assert one(spark, rows, "c string", R.advertiser_class("c", "b")) == ["", "", ""]


def test_pillar_metasearch_without_hyphen(spark):
    got = one(spark, [("ALP_METASEARCH_X", "GOL", "OUTROS", "X")], "a string, b string, v string, i string",
              R.pillar("a", "b", "v", "i"))
    assert got == ["VAREJO_NACIONAL"]


@pytest.mark.parametrize("ad,adv,veh,ini,expected", [
    ("ALP_META-SEARCH", "GOL", "X", "", "COMPARADOR"),
    ("ALP_X", "GOL_INTERNACIONAL", "X", "", "VAREJO_INTERNACIONAL"),
    ("ALP_X", "GOL", "GOOGLE_LP_BRANDING", "", "TERMOS_DE_MARCA"),
    ("ALP_X", "GOL", "X", "RECEITAS-AUXILIARES", "RECEITAS_AUXILIARES"),
    ("ALP_X", "GOL", "X", "TEST-AND-LEARN", "TEST_AND_lEARN"),
    ("ALP_AQUISICAO_X", "GOL", "X", "", "AQUISICAO"),
])
def test_pillar_arms(spark, ad, adv, veh, ini, expected):
    got = one(spark, [(ad, adv, veh, ini)], "a string, b string, v string, i string", R.pillar("a", "b", "v", "i"))
    assert got == [expected]


def test_brand_split(spark):
    assert one(spark, [("x_non-branding_y",), ("x_y",)], "c string", R.brand_split("c")) == \
        ["BING_LP_BRAND", "BING_LP_NON-BRAND"]


def _decode(spark, name, layout):
    df = dec.prepare(spark.createDataFrame([(name,)], "ad string"), "ad", [layout])
    return df.select(*[e.alias(f) for f, e in dec.decode(layout).items()]).first().asDict()


def test_decode_wrong_count_gives_nulls(spark):
    name = "_".join(f"t{i}" for i in range(10))       # 9 underscores
    assert all(v is None for v in _decode(spark, name, "analytics_other").values())
    assert _decode(spark, name, "analytics_search")["NOM_CAMPANHA"] == "t0_t1"


def test_decode_retargeting_keeps_remainder(spark):
    name = "_".join(f"t{i}" for i in range(13))       # 12 underscores
    got = _decode(spark, name, "retargeting")
    assert got["NOM_SEGMENTACAO"] == "t10_t11_t12"
    assert got["NOM_CAMPANHA"] == "t0_t1"


def test_decode_social_ignores_remainder(spark):
    name = "_".join(f"t{i}" for i in range(13))
    assert _decode(spark, name, "social")["NOM_SEGMENTACAO"] == "t10"


def test_full_name_null_first(spark):
    assert one(spark, [("Doe", None), ("Doe", "Jo")], "l string, f string", full_name("l", "f")) == [None, "Doe, Jo"]


def test_hour_label(spark):
    assert one(spark, [(9,), (23,)], "h int", hour_label("h")) == ["09:00:00", "23:00:00"]


def test_safe_ratio(spark):
    assert one(spark, [(5.0, 0.0), (1.0, 4.0), (1.0, None)], "n double, d double", safe_ratio("n", "d")) == \
        [0.0, 0.25, None]


def test_relabel(spark):
    got = one(spark, [("0 Attraction",), ("Other",)], "g string", R.relabel("g", R.GAME_CATEGORY_LABELS))
    assert got == ["Attraction", "Other"]


def test_not_in_semantics(spark):
    from ledgerlight.operators.lookups import keep_in
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    lst = spark.createDataFrame([(2,)], "v int")
    lst_null = spark.createDataFrame([(2,), (None,)], "v int")
    assert sorted(r.k for r in keep_in(df, "k", lst, "not in").collect()) == [1]
    assert keep_in(df, "k", lst_null, "not in").count() == 0
    assert sorted(r.k for r in keep_in(df, "k", [2], "not in").collect()) == [1]
    assert sorted(r.k for r in keep_in(df, "k", lst, "in").collect()) == [2]


def test_category_weights_count_pairs(spark):
    from ledgerlight.plans.revenue import category_weights
    cats = spark.createDataFrame(
        [(0, 1, 100, "c1"), (1, 1, 100, "c1"), (0, 100, None, "Food"), (1, 100, None, "Food"),
         (0, 2, 101, "c2"), (0, 101, None, "Toys"), (1, 101, None, None)],
        "StoreId int, CategoryId int, ParentCategoryId int, Name string")
    w = {r.CategoryId: (r.w_in, r.w_out) for r in category_weights(cats, ["Food"]).collect()}
    assert w[1] == (4, 0)          # 2 child rows x 2 parent rows named Food (no store key)
    assert w[2] == (0, 1)          # parent 101: one 'Toys' row; the null name counts in neither
    names = spark.createDataFrame([("Food",), (None,)], "n string")
    w2 = {r.CategoryId: (r.w_in, r.w_out) for r in category_weights(cats, names).collect()}
    assert w2[1] == (4, 0) and w2[2] == (0, 0)


def test_scaffold_right_join_semantics(spark):
    from ledgerlight.operators.lookups import scaffold
    stores = spark.createDataFrame([(1,), (2,)], "s int")
    groups = spark.createDataFrame([("a",), ("b",), ("a",)], "g string")
    assert sorted(tuple(r) for r in scaffold(stores, "s", groups, "g").collect()) == \
        [(1, "a"), (1, "b"), (2, "a"), (2, "b")]
    empty = groups.limit(0)
    assert sorted(tuple(r) for r in scaffold(stores, "s", empty, "g").collect()) == [(1, None), (2, None)]


def test_class_functions_by_name(spark):
    """The SQL functions say what the rule tables say, and a caller replaces one by its name."""
    from ledgerlight.functions import catalog
    from ledgerlight.plans.feeds import apply_class_functions
    texts = ["DESKTOP", "TABLET", "MOBILE", "x", None, "it's \\ a", "GOL_INTERNACIONAL", "ALP_LATAM_MARCA", *[v for _, c in R.ADVERTISER_RULES_A for v in _values(c)]]
    df = spark.createDataFrame([(t, t, t) for t in texts], "TIP_DEVICE string, NOM_ANUNCIANTE string, NOM_DISCIPLINA string")
    names = catalog.register_class_functions(spark)
    assert apply_class_functions(df, vehicle=True, names=names).collect() == apply_class_functions(df, vehicle=True).collect()
    by_sql = spark.sql("SELECT class_device('TABLET') d, class_vehicle('v') v").first()
    assert tuple(by_sql) == ("DESKTOP", "v")
    names = catalog.register_class_functions(spark, {"vehicle": "concat('V_', value)"}, {"vehicle": "my_vehicle"})
    assert apply_class_functions(df.limit(1), vehicle=True, names=names).first().NOM_DISCIPLINA == "V_DESKTOP"


def _values(cond):
    return list(cond.values) + [v for p in cond.parts for v in _values(p)]


def test_every_channel_arm_by_a_literal_row(spark):
    """Rows written out by hand for each arm and each of its alternatives, with what an earlier arm takes away."""
    rows = [
        ("alp_x", "google / cpc", "", "GOOGLE_LP"), ("alp_branding_gdn", "google / cpc", "", "GOOGLE_GDN"),
        ("alp_display-gallery", "google / cpc", "", "GOOGLE_ADS_GALLERY"), ("alp_display", "google / cpc", "smart-ads", "SMARTADS_GOOGLE"),
        ("alp_smart-ads", "google-adwords / display", "", "SMARTADS_GOOGLE"), ("alp_x", "google-ads-smart-ads / display", "smart-ads", "SMARTADS_GOOGLE"),
        ("alp_x", "google-ads-gdn / display", "gdn", "GOOGLE_GDN"), ("alp_gdn", "google-gdn / display", "", "GOOGLE_GDN"),
        ("alp_x", "google-gdn / display", "", "OUTROS"), ("alp_discovery-ads_display", "google / cpc", "", "GOOGLE_DISCOVERY_ADS"),
        ("alp_x", "google-ads-discovery-ads / display", "discovery-ads", "GOOGLE_DISCOVERY_ADS"), ("alp_x", "criteo / display", "", "CRITEO"),
        ("alp_x", "facebook / social", "", "FACEBOOK"), ("alp_x", "kayak / display", "cpa", "KAYAK_META_SEARCH"),
        ("alp_x", "kayak / comparador", "metasearch", "KAYAK_META_SEARCH"), ("alp_x", "kayak / comparador", "banner", "KAYAK_DISPLAY"),
        ("alp_x", "oath / display", "", "OATH_BRIGTHROLL"), ("alp_x", "oath-brightroll / programatico", "", "OATH_BRIGTHROLL"),
        ("alp_x", "oath-gemini / native", "", "VERIZON_GEMINI"), ("alp_x", "verizon-gemini / native", "", "VERIZON_GEMINI"),
        ("alp_x", "verizon-dsp / programatico", "", "VERIZON_DSP"), ("alp_x", "verizon / display", "", "VERIZON_DSP"), ("alp_x", "verizon-dsp / display", "", "VERIZON_DSP"),
        ("alp_x", "skyscanner / comparador", "core", "SKYSCANNER_META_SEARCH"), ("alp_x", "skyscanner / comparador", "x", "SKYSCANNER_DISPLAY"),
        ("alp_x", "skyscanner / display", "x", "SKYSCANNER_DISPLAY"), ("alp_x", "skyscanner / display", "metasearch", "OUTROS"),
        ("alp_x", "taboola / native", "", "TABOOLA"), ("alp_x", "taboola / display", "", "TABOOLA"),
        ("alp_x", "viajala / comparador", "x", "VIAJALA_DISPLAY"), ("alp_x", "viajala / comparador", "core", "VIAJALA_META_SEARCH"), ("alp_x", "viajala / core", "core", "VIAJALA_META_SEARCH"),
        ("alp_x", "voopter / comparador", "meta", "VOOPTER_META_SEARCH"), ("alp_x", "voopter / core", "cpa", "VOOPTER_META_SEARCH"), ("alp_x", "voopter / core", "x", "OUTROS"),
        ("alp_x", "voopter / comparador", "x", "VOOPTER_DISPLAY"), ("alp_x", "voopter / publi-editorial", "x", "VOOPTER_DISPLAY"), ("alp_x", "voopter / display", "x", "VOOPTER_DISPLAY"),
        ("alp_x", "uol / display", "", "UOL"), ("alp_x", "abril / display", "", "ABRIL"), ("alp_x", "webedia / display", "", "WEBEDIA"), ("alp_x", "terra / display", "", "TERRA"),
        ("alp_x", "rtbhouse / display", "", "RTBHOUSE"), ("alp_x", "rtbhouse / programatico", "", "RTBHOUSE"), ("alp_x", "seedtag / display", "", "SEEDTAG"),
        ("alp_x", "outbrain / native", "", "OUTBRAIN"), ("alp_x", "outbrain / social", "", "OUTBRAIN"), ("alp_x", "xtmedia / display", "", "XTMEDIA"), ("alp_x", "xtmedia / video", "", "XTMEDIA"),
        ("alp_x", "google / programatico", "", "GOOGLE_DV360"), ("alp_x", "google-dv360 / programatico", "", "GOOGLE_DV360"),
        ("alp_x", "google-dv360 / native", "", "GOOGLE_DV360"), ("alp_x", "google-dv360 / display", "", "GOOGLE_DV360"),
        ("alp_x", "google-ads-gsp / display", "gsp", "GOOGLE_GSP"), ("alp_gsp_display", "google / cpc", "", "GOOGLE_GSP"),
        ("alp_x", "outlook / display", "", "OUTLOOK_VERIZON"), ("alp_x", "oath-outlook / programatico", "", "VERIZON_GEMINI"),
        ("alp_x", "lancenet / display", "", "LANCENET"), ("alp_x", "folha / display", "", "FOLHA"),
        ("alp_x", "spotify / audio", "", "SPOTIFY"), ("alp_x", "spotify / programatico", "", "SPOTIFY"), ("alp_x", "spotify / display", "", "SPOTIFY"),
        ("alp_x", "google-dv360 / video", "", "YOUTUBE_DV360"), ("alp_x", "google-dv360-youtube / programatico", "", "YOUTUBE_DV360"),
        ("alp_x", "jovem-nerd / content", "", "JOVEM_NERD"), ("alp_x", "brazil-journal / display", "", "BRAZIL_JOURNAL"), ("alp_x", "kiaora-digital / display", "", "KIAORA"),
    ]
    got = one(spark, rows, "c string, m string, t string, want string", R.channel_class("c", "m", "t"))
    assert [(r, g) for r, g in zip(rows, got) if g != r[3]] == []
    assert {r[3] for r in rows} | {"GOOGLE_LP_BRANDING", "BING_LP", "TURSIMO_CITY_META_SEARCH"} == {label for label, _ in R.CHANNEL_RULES} | {"OUTROS"}
