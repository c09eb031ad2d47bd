"""The stored tables of a price monitor, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.operators import changes

# Every relation is plain SQL over whole tables. Texts in BOTH run unchanged in
# either engine; `{ev}`, `{obs}` name their input.
BOTH = {
    "obs": """
SELECT event_id AS id,
  CAST(day_no AS BIGINT) * 10 + CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2
    WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS run_id,
  event_type AS merchant,
  CAST(user_id % 40 AS STRING) AS product_ext_id,
  CAST(user_id AS STRING) AS variant_ext_id,
  concat('product-', CAST(user_id % 40 AS STRING)) AS handle,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'x'
    ELSE concat('Product ', CAST(user_id % 40 AS STRING)) END AS title,
  CASE WHEN user_id % 4 = 0 THEN 'Default Title'
    ELSE concat('V', CAST(user_id % 4 AS STRING)) END AS variant_title,
  CASE WHEN user_id % 5 = 0 THEN '' ELSE event_type END AS vendor,
  CASE WHEN user_id % 3 = 0 THEN NULL ELSE concat('type-', CAST(user_id % 3 AS STRING)) END AS product_type,
  CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
    ELSE concat('SKU-', CAST(user_id AS STRING)) END AS sku,
  CASE event_id % 53 WHEN 0 THEN NULL WHEN 1 THEN '0.00' WHEN 2 THEN '$1,299.00' WHEN 3 THEN 'abc'
    WHEN 4 THEN '-5' WHEN 5 THEN '' WHEN 6 THEN '1-2'
    ELSE CAST(CAST(FLOOR(value / 20) AS BIGINT) * 20 + 10 AS STRING) END AS price_raw,
  CASE event_id % 7 WHEN 0 THEN '0' WHEN 1 THEN NULL WHEN 2 THEN 'abc' WHEN 3 THEN '-1'
    ELSE CAST(user_id + 100 AS STRING) END AS compare_at_raw,
  'USD' AS currency,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 3 <> 0 END AS available,
  CASE WHEN user_id % 6 = 0 THEN NULL ELSE concat('https://cdn.example/', CAST(user_id % 40 AS STRING),
    CASE WHEN user_id % 2 = 0 THEN '' ELSE '-alt' END, '.png') END AS image_url,
  ts AS observed_at
FROM {ev}""",
    "evruns": """
SELECT run_id AS id, merchant, 'shopify_products_json' AS method,
  MIN(observed_at) AS started_at, MAX(observed_at) AS finished_at,
  CASE WHEN run_id % 9 = 0 THEN 0 ELSE 1 END AS ok,
  COUNT(DISTINCT product_ext_id) AS products_seen, COUNT(*) AS variants_seen
FROM {obs} GROUP BY run_id, merchant
UNION ALL
SELECT run_id + 100000, merchant, 'shopify_products_json', MAX(observed_at), MAX(observed_at), 1, 0, 0
FROM {obs} WHERE run_id % 20 = 1 GROUP BY run_id, merchant""",
    "oldout": """
SELECT run_id, merchant, 'compare_at_price' AS field,
  CASE WHEN compare_at_raw = '0' THEN 'invalid' ELSE 'ok' END AS status, COUNT(*) AS count
FROM {obs} GROUP BY run_id, merchant, CASE WHEN compare_at_raw = '0' THEN 'invalid' ELSE 'ok' END
UNION ALL
SELECT DISTINCT run_id + 100000, merchant, 'sku', 'missing', CAST(7 AS BIGINT)
FROM {obs} WHERE run_id % 20 = 1""",
    "registry": """
SELECT concat('shop-', CAST(s_suppkey AS STRING)) AS slug, s_name AS name,
  CASE WHEN s_suppkey % 9 = 1 THEN 'permission_required' ELSE 'shopify_products_json' END AS method,
  concat('https://shop-', CAST(s_suppkey AS STRING), '.example') AS base_url,
  CASE WHEN s_nationkey % 2 = 0 THEN 'USD' ELSE 'GBP' END AS currency,
  s_suppkey % 8 <> 2 AS enabled,
  concat('nation ', n_name) AS method_rationale
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey""",
}

EV = """
SELECT *, datediff(CAST(ts AS DATE), DATE'2024-01-01') AS day_no FROM {events}"""

RUNS = """
SELECT o_orderkey AS id, concat('m', CAST(o_custkey % 20 AS STRING)) AS merchant,
  o_orderpriority AS method,
  o_orderdate + make_dt_interval(0, 0, 0, o_orderkey / 1000000) AS started_at,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS ok,
  CASE WHEN o_orderstatus = 'F' THEN CAST(FLOOR(o_totalprice / 100) AS BIGINT) ELSE 0 END AS variants_seen,
  CASE WHEN o_orderstatus = 'F' THEN CAST(FLOOR(o_totalprice) AS BIGINT) ELSE 0 END AS bytes,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey % 900 END AS duration_ms,
  CASE WHEN o_custkey % 20 < 3 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS cost_usd
FROM {orders}"""

# Page rules of the derived feed.
SHOP_PRODUCTS = 150
PAGE_PRODUCTS = 15

# One product per order with a variant for each of its lines, 15 products per page
# and 10 full pages per shop; some shops have an eleventh, short one. Failures are
# planted by status and body, so every order and line is on some page.
FEED = """
WITH line AS (
  SELECT l_orderkey AS k, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_returnflag) - 1 AS vn,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_returnflag AS flag
  FROM {lineitem}
),
variant AS (
  SELECT k, concat(
    '{{"id":', k * 1000 + vn, ',"title":"', CASE WHEN vn = 0 THEN 'Default Title' ELSE concat('V', vn) END,
    '","price":', CASE WHEN k % 5 = 0 THEN CAST(price AS STRING) ELSE concat('"', price, '"') END,
    CASE vn % 4 WHEN 0 THEN ',"compare_at_price":null' WHEN 1 THEN ',"compare_at_price":"0"'
      WHEN 2 THEN '' ELSE concat(',"compare_at_price":"', price + 100, '"') END,
    ',"available":', CASE flag WHEN 'A' THEN 'true' WHEN 'N' THEN 'false' ELSE '"yes"' END,
    CASE k % 11 WHEN 0 THEN concat(',"sku":', k) WHEN 1 THEN ',"sku":""' WHEN 2 THEN ''
      ELSE concat(',"sku":"SKU-', k, '-', vn, '"') END,
    CASE vn WHEN 3 THEN concat(',"featured_image":{{"src":"https://cdn.example/', k, '-3.png?v=2"}}')
      WHEN 5 THEN ',"featured_image":null' ELSE '' END,
    '}}') AS body
  FROM line
),
product AS (
  SELECT k AS pk, concat_ws(',', sort_array(collect_list(body))) AS variants FROM variant GROUP BY k
),
listed AS (
  SELECT o_orderkey DIV 150 AS shop, CAST((o_orderkey % 150) DIV 15 + 1 AS INT) AS page, concat(
    '{{"id":', o_orderkey, ',"handle":"order-', o_orderkey, '"',
    CASE WHEN o_orderkey % 97 = 0 THEN ',"title":null' ELSE concat(',"title":"Order ', o_orderkey, '"') END,
    ',"vendor":"', CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'maker' END, '","product_type":"', o_orderpriority, '"',
    CASE WHEN o_orderkey % 6 = 0 THEN ',"images":[]'
      ELSE concat(',"images":[{{"src":"https://cdn.example/', o_orderkey, '.png?v=1"}}]') END,
    CASE WHEN variants IS NULL THEN '' ELSE concat(',"variants":[', variants, ']') END, '}}') AS body
  FROM {orders} LEFT JOIN product ON pk = o_orderkey
),
bodies AS (
  SELECT shop, page, concat('{{"products":[', concat_ws(',', sort_array(collect_list(body))), ']}}') AS body
  FROM listed GROUP BY shop, page
  UNION ALL
  SELECT DISTINCT o_orderkey DIV 150, 11, '{{"products":[{{"id":1,"variants":[{{"id":1}}]}}]}}'
  FROM {orders} WHERE (o_orderkey DIV 150) % 23 = 6
)
SELECT shop + 1 AS run_id, concat('shop-', shop) AS merchant, page,
  CASE WHEN shop % 13 = 7 AND page = 2 THEN 503 WHEN shop % 5 = 3 AND page = 9 THEN 500 ELSE 200 END AS http_status,
  CASE WHEN shop % 17 = 9 AND page = 3 THEN '<html>blocked</html>'
    WHEN shop % 19 = 4 AND page = 1 THEN '{{"products":[]}}' ELSE body END AS body,
  TIMESTAMP_NTZ'2024-02-01 00:00:00' + make_dt_interval(0, 0, CAST(shop AS INT), page) AS fetched_at
FROM bodies"""


# Every merchant's run begins a second before its first page; some begin another run that
# never gets a page.
STARTS = """
SELECT s_suppkey + 1 AS run_id, concat('shop-', s_suppkey) AS merchant,
  TIMESTAMP_NTZ'2024-02-01 00:00:00' + make_dt_interval(0, 0, CAST(s_suppkey AS INT), 0) AS started_at
FROM {supplier}
UNION ALL
SELECT 1000000 + s_suppkey, concat('shop-', s_suppkey),
  TIMESTAMP_NTZ'2024-02-02 00:00:00' + make_dt_interval(0, 0, CAST(s_suppkey AS INT), 0)
FROM {supplier} WHERE s_suppkey % 7 = 0"""


class Tables:
    """The derived relations of one data folder, built when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _sql(self, text: str, **inputs: DataFrame) -> DataFrame:
        return self.spark.sql(text, **inputs)

    def ev(self) -> DataFrame:
        return self._sql(EV, events=self.given("events"))

    def obs(self) -> DataFrame:
        return self._sql(BOTH["obs"], ev=self.ev())

    def obs_day(self) -> DataFrame:
        """One moment per run, with the same variant several times in a run."""
        day = F.date_trunc("day", "observed_at").cast("timestamp_ntz")
        return self.obs().withColumn("observed_at", day)

    def evruns(self) -> DataFrame:
        return self._sql(BOTH["evruns"], obs=self.obs())

    def oldout(self) -> DataFrame:
        return self._sql(BOTH["oldout"], obs=self.obs())

    def runs(self) -> DataFrame:
        return self._sql(RUNS, orders=self.given("orders"))

    def registry(self) -> DataFrame:
        return self._sql(BOTH["registry"], supplier=self.given("supplier"), nation=self.given("nation"))

    def pages(self, part: int = 0, parts: int = 1) -> DataFrame:
        """The landed pages, or one of several parts of them by shop: a shop's pages hold its own orders and lines only.

        Orders without a key, which make pages of no run, are in no part."""
        def of_part(name: str, key: str) -> DataFrame:
            rows = self.given(name)
            return rows if parts == 1 else rows.where(F.expr(f"pmod({key} DIV {SHOP_PRODUCTS}, {parts})") == part)

        return self._sql(FEED, lineitem=of_part("lineitem", "l_orderkey"), orders=of_part("orders", "o_orderkey"))

    def starts(self) -> DataFrame:
        return self._sql(STARTS, supplier=self.given("supplier"))

    def published_changes(self) -> DataFrame:
        """An older publication: early changes with other values, and one forgotten change each."""
        early = (
            changes.history(self.obs()).drop("id")
            .where(F.col("at") < F.lit("2024-01-16").cast("timestamp_ntz"))
            .withColumn("to_value", F.col("to_value") + 1)
        )
        gone = self.given("events").select(F.col("event_type").alias("merchant")).distinct()
        text, number = F.lit(None).cast("string"), F.lit(1.0)
        forgotten = gone.select(
            F.lit("2023-12-31").cast("timestamp_ntz").alias("at"), "merchant",
            F.lit("gone").alias("variant_ext_id"), F.lit("Gone").alias("title"),
            text.alias("variant_title"), F.lit("price").alias("kind"),
            number.alias("from_value"), (number + 1).alias("to_value"),
            text.alias("from_text"), text.alias("to_text"),
        )
        return early.unionByName(forgotten)
