"""Fixture views over the driver tables (see FIXTURES.md §3).

Each view body is plain SQL that runs unchanged in Spark SQL and DuckDB.  Spark
registers them as lazy temp views over the parquet scans, so every query plan
reads the driver tables and grows with them.  The DuckDB oracles inline the
same bodies as CTEs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Report parameters fixed by FIXTURES.md (as-of date and literal lists).
AS_OF = "2000-06-22"
PAYMENT_EXCLUDED_STORES = (3, 7)
PRODUCT_SALES_STORES = (4, 9)
FOOD_AND_BEVERAGE = ("Food", "Beer", "Pizza")
PRODUCT_GROUPS = ("Food", "NA Beverage", "NA Beverages", "Dessert")

# Parts of invented ads that together reach every channel, advertiser and pillar rule.
AD_CAMPAIGNS = ["alp_varejo-nac", "alp_varejo-inter", "alp_marca", "xyz_voebiz", "alp_madrugol-nacional", "alp_madrugol-internacional",
                "alp_acao-fim-de-semana", "alp_receitas-auxiliares", "alp_klm-af", "alp_gollog", "alp_outra"]
AD_SUFFIXES = ["", "-search", "-branding", "-gdn", "-smart-ads", "-youtube-gallery", "-gallery", "-discovery-ads", "-display", "-gsp",
               "-smartads", "-vídeo", "-Non-Branding"]
AD_INITIATIVES = ["test-and-learn_aquisicao", "receitas-auxiliares_retencao", "varejo_aquisicao", "varejo_retencao", "varejo_core"]
AD_CONTENTS = ["core-cpa", "meta-search", "banner", "metasearch", "core", "cpa", "meta", "gdn", "gsp", "smart-ads", "discovery-ads"]
AD_MEDIA = [
    "google / cpc", "bing / cpc", "google-adwords / display", "google-gdn / display", "google-ads-gdn / display", "google-ads-gsp / display",
    "google-ads-smart-ads / display", "google-ads-discovery-ads / display", "google / programatico", "google-dv360 / display",
    "google-dv360 / native", "google-dv360 / programatico", "google-dv360 / video", "google-dv360-youtube / programatico", "criteo / display",
    "facebook / social", "kayak / comparador", "kayak / core", "kayak / display", "skyscanner / comparador", "skyscanner / display",
    "viajala / comparador", "viajala / core", "viajala / display", "voopter / comparador", "voopter / core", "voopter / display",
    "voopter / publi-editorial", "turismocity", "oath / display", "oath / outlook", "oath-brightroll / programatico", "oath-gemini / native",
    "oath-outlook / programatico", "outlook / display", "verizon / display", "verizon-dsp / display", "verizon-dsp / programatico",
    "verizon-gemini / native", "taboola / display", "taboola / native", "outbrain / native", "outbrain / social", "rtbhouse / display",
    "rtbhouse / native", "rtbhouse / programatico", "seedtag / display", "spotify / audio", "spotify / display", "spotify / programatico",
    "uol / display", "abril / display", "brazil-journal / display", "folha / display", "jovem-nerd / content", "kiaora-digital / display",
    "lancenet / display", "terra / display", "webedia / display", "xtmedia / display", "xtmedia / video", "(direct) / (none)"]


def _pick(key: str, values: list[str]) -> str:
    """SQL that picks a value by ``key`` modulo their number."""
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


VIEWS: dict[str, str] = {
    "fx_stores": """
SELECT n_nationkey AS store_number, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 900 + n_nationkey END AS embed_number,
       n_nationkey NOT IN (3, 7) AS in_report FROM nation""",
    "fx_categories": """
SELECT n_nationkey AS StoreId, p_size AS CategoryId, 100 + p_size % 5 AS ParentCategoryId,
       CAST(p_size AS INT) AS CategoryNumber, 'Category ' || CAST(p_size AS VARCHAR(10)) AS Name
FROM nation CROSS JOIN (SELECT DISTINCT p_size FROM part) p
UNION ALL
SELECT n_nationkey, v.id, NULL, v.id, v.nm FROM nation CROSS JOIN
 (VALUES (100,'Food'),(101,'Beer'),(102,'Pizza'),(103,'Attractions'),(104,'Merchandise')) AS v(id, nm)""",
    "fx_products": """
SELECT n_nationkey AS StoreId, p_partkey AS ProductId, p_name AS Name, p_size AS CategoryId,
       'I' || CAST(p_partkey AS VARCHAR(20)) AS ItemNumber FROM nation CROSS JOIN part
UNION ALL
SELECT n_nationkey, p_partkey, p_name, p_size, 'J' || CAST(p_partkey AS VARCHAR(20))
FROM nation CROSS JOIN part WHERE p_partkey % 50 = 0""",
    "fx_employees": """
SELECT c_nationkey AS StoreId, c_custkey AS EmployeeId, 'E' || CAST(c_custkey AS VARCHAR(20)) AS EmployeeNumber,
       c_name AS LastName, CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_mktsegment END AS FirstName FROM customer""",
    "fx_sales_summary": """
SELECT s_nationkey AS StoreId, CAST(l_shipdate AS DATE) AS Business_Date, 8 + l_linenumber AS HourNo,
       l_partkey AS ProductId, p_size AS CategoryId, l_linestatus AS Division, l_returnflag AS RevenueCenter,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS AmountSold, CAST(l_quantity AS INT) AS QuantitySold,
       CASE WHEN l_returnflag = 'R' THEN CAST(l_discount AS DECIMAL(18,2)) * 100 ELSE CAST(0 AS DECIMAL(18,2)) END AS AmountReturned,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS QuantityReturned,
       l_linenumber AS RedemptionTicketsRedeemed, CAST(l_tax AS DECIMAL(18,2)) AS DiscountAmountApplied
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "fx_labor_hourly": """
SELECT s_nationkey AS StoreId, CAST(l_shipdate AS DATE) AS WorkDate, 8 + l_linenumber + CAST(l_orderkey % 2 AS INT) AS Hour,
       CAST(l_quantity AS DECIMAL(18,4)) * CAST(1.3333 AS DECIMAL(9,4)) AS EffectiveHourlyLaborCost,
       CAST(l_tax AS DECIMAL(18,4)) + 1 AS LaborHours
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "fx_labor": """
SELECT c_nationkey AS StoreId, o_custkey AS EmpId, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderpriority END AS Department,
       o_orderstatus AS Position, 'RC' || o_orderstatus AS RevenueCenter, CAST(o_orderdate AS DATE) AS Business_Date,
       CAST(o_orderkey % 9 AS DECIMAL(18,4)) + CAST(0.3333 AS DECIMAL(18,4)) AS RegularHours,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 0 END AS DECIMAL(18,2)) AS OvertimeHours,
       CAST(o_totalprice AS DECIMAL(18,2)) AS RegularPay, CAST(o_orderkey % 11 AS DECIMAL(18,2)) AS OvertimePay
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fx_schedule": """
SELECT c_nationkey AS StoreId, o_custkey AS EmpId, o_orderpriority AS Department,
       CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate + INTERVAL '1' DAY AS DATE) ELSE CAST(o_orderdate AS DATE) END AS Business_Date,
       CAST(o_orderkey % 8 AS DECIMAL(18,2)) AS ScheduledHours,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(17.25 AS DECIMAL(18,2)) END AS PayRate,
       CAST(15 AS DECIMAL(18,2)) AS DefaultPayRate
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 <> 0""",
    "fx_employee_history": """
SELECT c_nationkey AS StoreId, o_custkey AS EmpId,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate + INTERVAL '2' DAY AS DATE) ELSE CAST(o_orderdate AS DATE) END AS Business_Date,
       CAST(o_orderkey % 13 - 6 AS DECIMAL(18,2)) AS TillOverShortAmount, o_orderkey % 3 AS ManualRedemptionTickets,
       'M' || CAST(o_orderkey % 10 AS VARCHAR(5)) AS MgrEmpNo,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Miscount' END AS OverShortReason
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fx_transactions": """
SELECT c_nationkey AS StoreId, CAST(l_shipdate AS DATE) AS Business_Date, l_orderkey AS ReceiptNumber, l_linenumber AS LineNumber,
       l_shipdate + l_linenumber * INTERVAL '1' HOUR AS TransactionDateTime, o_custkey AS EmpId,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE o_custkey END AS AuthByEmpNo, l_linestatus AS Division, l_partkey AS LineProductId,
       CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS LineQuantitySold,
       CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS LineAmountPaid,
       CASE WHEN l_returnflag = 'R' THEN -CAST(l_tax AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS RefundAmount,
       l_orderkey % 17 AS RefNo, CASE WHEN l_returnflag = 'R' THEN 'Damaged' ELSE NULL END AS RefundReason,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'Cash' ELSE 'Visa' END AS TenderType,
       CAST(o_orderkey % 20 AS DECIMAL(18,2)) AS TaxAmount, CAST(o_orderkey % 4 AS DECIMAL(18,2)) AS GratuityAmount,
       o_custkey AS EventRefId
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "fx_bookings": """
SELECT c_nationkey AS StoreId, o_custkey AS EventRefId, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS Business_Date,
       CASE WHEN o_orderstatus = 'F' THEN 'Canceled' ELSE 'Booked' END AS Status, CAST(o_orderkey % 2 AS INT) AS IsBirthdayEvent
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fx_income": """
SELECT c_nationkey AS StoreId, CAST(o_orderdate AS DATE) AS Business_Date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Player Card' WHEN '2-HIGH' THEN 'Visa' WHEN '3-MEDIUM' THEN 'Coupon'
            WHEN '5-LOW' THEN 'Cash' ELSE NULL END AS TenderType, CAST(o_totalprice AS DECIMAL(18,2)) AS Amount
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fx_payments": """
SELECT c_nationkey AS Store_ID, CAST(o_orderdate AS DATE) AS Business_Date, CAST(o_totalprice AS DECIMAL(18,2)) AS Total
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fx_product_sales": """
SELECT s_nationkey AS Store_ID, CASE WHEN p_size % 3 = 0 THEN 'Food' WHEN p_size % 3 = 1 THEN 'Dessert' ELSE 'Toys' END AS ProductGroup,
       p_name AS ProductName, CAST(l_extendedprice AS DECIMAL(18,2)) AS Total, CAST(l_shipdate AS DATE) AS Business_Date
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "fx_embed_sales": """
SELECT CASE WHEN s_nationkey = 0 THEN 999 ELSE 900 + s_nationkey END AS store_id, CAST(l_shipdate AS DATE) AS Business_Date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS total_gross_sales, CAST(l_tax AS DECIMAL(18,2)) AS coupon_used
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber = 1""",
    "fx_embed_games": """
SELECT CASE WHEN s_nationkey = 0 THEN 999 ELSE 900 + s_nationkey END AS store_id, CAST(l_shipdate AS DATE) AS Business_Date,
       CASE p_size % 6 WHEN 0 THEN '0 Attraction' WHEN 1 THEN '1 Video' WHEN 2 THEN '2 Redemption' WHEN 3 THEN '3 Coin/Token Rolldown'
            WHEN 4 THEN '4 Merchandise' ELSE 'Other' END AS game_category, p_name AS game_description,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS value_of_game_play, CAST(l_tax AS DECIMAL(18,2)) AS percent_ticket_payout,
       l_linenumber AS paper_tickets_issued, l_linenumber * 2 AS e_tickets_issued,
       CAST(l_quantity AS DECIMAL(18,2)) AS card_value, CAST(l_discount AS DECIMAL(18,2)) AS coin_value
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE l_linenumber = 2""",
    "fx_game_activity": """
SELECT s_nationkey AS Store_ID, CASE WHEN p_size % 10 = 0 THEN 'Photo Booth-Instant Win' WHEN p_size % 10 = 1 THEN 'Instant Win' ELSE p_type END AS GroupName,
       p_name AS GameName, CAST(l_shipdate AS DATE) AS Business_Date, CAST(l_quantity AS DECIMAL(18,2)) AS Collection, l_linenumber AS Passports,
       CAST(l_tax AS DECIMAL(18,2)) + 1 AS AvgPrice, CAST(l_discount AS DECIMAL(18,2)) * 100 AS PayOut_Percentage, CAST(l_discount AS DECIMAL(18,2)) AS MoneyOUT
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
    "fx_group_names": """
SELECT DISTINCT p_type AS GroupName, CASE WHEN p_type = 'ECONOMY' THEN 'Attraction' ELSE 'Arcade' END AS grp FROM part""",
    "fx_date_dim": """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS FULL_DATE, CAST(l_shipdate - INTERVAL '1' YEAR AS DATE) AS PY_DATE,
       CAST(l_shipdate - INTERVAL '364' DAY AS DATE) AS PY_DAY_OF_WEEK FROM lineitem""",
    "fx_ads": """
SELECT l_orderkey * 10 + l_linenumber AS row_id, CAST(l_shipdate AS DATE) AS day,
       """ + _pick("l_suppkey", AD_CAMPAIGNS) + """ || """ + _pick("l_orderkey", AD_SUFFIXES) + """ || '_google_media' AS campaign,
       """ + _pick("l_partkey", AD_INITIATIVES) + """ || '_seg_' || l_linestatus || '_buy' ||
         CASE (l_orderkey * 10 + l_linenumber) % 3 WHEN 0 THEN '_fmt' WHEN 1 THEN '_fmt_creative' ELSE '' END AS ad_group,
       """ + _pick("(l_orderkey + l_partkey)", AD_MEDIA) + """ AS medium,
       """ + _pick("l_partkey", AD_CONTENTS) + """ AS content,
       CASE l_linenumber WHEN 1 THEN 'desktop' WHEN 2 THEN 'mobile' WHEN 3 THEN 'tablet' WHEN 4 THEN 'smartphone' WHEN 5 THEN 'unknown' ELSE 'tv' END AS device,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 10000 AS BIGINT) AS cost_micros, CAST(l_tax AS DECIMAL(18,2)) AS spend, CAST(l_quantity AS INT) AS impressions,
       l_linenumber AS clicks, l_linenumber % 24 AS hour, CASE WHEN l_linenumber = 1 THEN '0.00%' ELSE '12.50%' END AS video_25,
       '["http://x.example/' || CAST(l_partkey % 50 AS VARCHAR(5)) || '"]' AS final_url
FROM lineitem""",
    "fx_initiatives": """
SELECT DISTINCT 'http://x.example/' || CAST(p_partkey % 50 AS VARCHAR(5)) AS url, 'init-' || CAST(p_partkey % 50 AS VARCHAR(5)) AS initiative
FROM part WHERE p_partkey % 2 = 0""",
    "fx_files": """
SELECT o_orderkey AS file_id, CASE o_orderkey % 5 WHEN 0 THEN '20240131_bing' WHEN 1 THEN '20241331_bing' WHEN 2 THEN '20240131_rtbhouse'
       WHEN 3 THEN '20240131_bing_old' ELSE '2024013_bing' END AS file_stem FROM orders""",
}

# Landed-feed stand-ins over fx_ads, one per feed, with snake-case names (the
# feed readers rename them to each report's own header).
FEED_VIEWS: dict[str, str] = {
    "fx_in_analytics": """
SELECT CAST(day AS STRING) AS date, campaign, medium AS sourceMedium, content AS keyword, ad_group AS adGroup,
       content AS adContent, device AS deviceCategory, CAST(spend AS DOUBLE) AS itemRevenue,
       CAST(spend AS DOUBLE) * 100 AS avgSessionDuration, impressions AS pageviews, hour AS bounces,
       clicks AS transactions, impressions AS sessions, clicks AS newUsers, clicks AS itemQuantity, hour AS metric1
FROM fx_ads""",
    "fx_in_search_ads": """
SELECT ad_group, campaign, cost_micros AS cost, CAST(day AS STRING) AS day, device, video_25 AS video_100,
       video_25, video_25 AS video_50, video_25 AS video_75, clicks AS views, 'enabled' AS campaign_state,
       clicks, impressions, final_url
FROM fx_ads""",
    "fx_in_paid_search": """
SELECT day AS date, campaign AS nome_campanha, 'Texto' AS tipo_anuncio, ad_group AS grupo_anuncio,
       CAST(spend AS DOUBLE) AS gastos, device AS dispositivo, impressions AS visualizacoes, clicks AS cliques,
       replace(replace(replace(final_url, '[', ''), ']', ''), '"', '') AS url_final
FROM fx_ads""",
    "fx_in_social": """
SELECT CAST(day AS STRING) AS date, campaign || '_' || ad_group AS adname, impressions,
       CAST(spend AS DOUBLE) AS spend, device AS device_platform
FROM fx_ads""",
    "fx_in_retargeting": """
SELECT CAST(day AS STRING) AS date, campaign || '_' || ad_group AS size, device, impressions AS imps, clicks,
       CAST(spend AS DOUBLE) AS cost_brl
FROM fx_ads""",
    "fx_in_native": """
SELECT CAST(day AS STRING) AS day, hour, device AS device_type, CAST(spend AS DOUBLE) AS spend,
       campaign || '_' || ad_group AS ad_group_name, clicks AS video_views, impressions AS video_25,
       impressions AS video_50, impressions AS video_75, impressions AS video_100
FROM fx_ads""",
}
VIEWS.update(FEED_VIEWS)


_registered: dict[int, tuple] = {}      # session -> (its SparkContext, folder of its views)


# Views that join every sale with its part by name: beyond this size of its files, part is shuffled like the sales. Spark
# would broadcast it up to 10 MB of files, which are 150 MB on the driver for each of the views.
PART_VIEWS = ("fx_product_sales", "fx_embed_games", "fx_game_activity")
PART_BROADCAST = 2 * 1024 * 1024


def _spark_body(name: str, body: str, large_part: bool) -> str:
    """A view's body with Spark's join hint, where it needs one."""
    return body.replace("SELECT ", "SELECT /*+ MERGE(part) */ ", 1) if large_part and name in PART_VIEWS else body


def _size(spark: SparkSession, path: str) -> int:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def register(spark: SparkSession, sf_dir: str) -> None:
    """Register the driver tables and every fixture view for ``sf_dir``, once
    per session and folder (a session may switch folders)."""
    sf_dir = sf_dir.rstrip("/")
    state = (spark.sparkContext.applicationId, sf_dir)
    if _registered.get(id(spark)) == state and spark.catalog.tableExists("fx_files"):
        return
    _registered[id(spark)] = state
    for name in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    large_part = _size(spark, f"{sf_dir}/part.parquet") > PART_BROADCAST
    for name, body in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS {_spark_body(name, body, large_part)}")


def cte(*names: str) -> str:
    """``WITH`` clause holding the named fixture views, for DuckDB oracles."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in names) + "\n"
