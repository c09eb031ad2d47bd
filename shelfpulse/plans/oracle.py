"""The SQL each registered query must equal, for DuckDB on the same tables."""

from __future__ import annotations

from shelfpulse.plans.fixtures import BOTH

EV = """
SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day_no FROM events"""

OBS_DAY = "SELECT * REPLACE (date_trunc('day', observed_at) AS observed_at) FROM obs"

RUNS = """
SELECT o_orderkey AS id, concat('m', CAST(o_custkey % 20 AS STRING)) AS merchant,
  o_orderpriority AS method, o_orderdate + to_microseconds(o_orderkey) AS started_at,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS ok,
  CASE WHEN o_orderstatus = 'F' THEN CAST(FLOOR(o_totalprice / 100) AS BIGINT) ELSE 0 END AS variants_seen,
  CASE WHEN o_orderstatus = 'F' THEN CAST(FLOOR(o_totalprice) AS BIGINT) ELSE 0 END AS bytes,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey % 900 END AS duration_ms,
  CASE WHEN o_custkey % 20 < 3 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS cost_usd
FROM orders"""

# Prices: a number is a number; other text stays text and still compares.
NUMERIC = r"'[ \t\n\v\f\r]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\v\f\r]*'"


def typed(raw: str) -> str:
    return f"CASE WHEN regexp_full_match({raw}, {NUMERIC}) THEN try_cast(trim({raw}) AS DOUBLE) END"


def texts(raw: str) -> str:
    return f"CASE WHEN NOT regexp_full_match({raw}, {NUMERIC}) THEN {raw} END"


def price_key(raw: str) -> str:
    return (
        f"CASE WHEN {typed(raw)} IS NOT NULL THEN concat('n', CAST({typed(raw)} AS STRING)) "
        f"WHEN {raw} IS NOT NULL THEN concat('t', {raw}) END"
    )


READ = """
SELECT id, merchant, variant_ext_id, title, variant_title, observed_at, available,
  {number} AS price, {text} AS price_text, {key} AS price_key
FROM {{source}}""".format(number=typed("price_raw"), text=texts("price_raw"), key=price_key("price_raw"))

EVENTS = """
linked AS (
  SELECT *, LAG(price) OVER w AS prev_price, LAG(price_text) OVER w AS prev_price_text,
    LAG(price_key) OVER w AS prev_key, LAG(available) OVER w AS prev_available
  FROM readings WINDOW w AS (PARTITION BY merchant, variant_ext_id ORDER BY observed_at, id)
),
changed AS (
  SELECT * FROM linked WHERE prev_key IS NOT NULL
    AND (price_key IS DISTINCT FROM prev_key OR available IS DISTINCT FROM prev_available)
),
events_found AS (
  SELECT observed_at AS "at", merchant, variant_ext_id, title, variant_title, 'price' AS kind,
    prev_price AS from_value, price AS to_value, prev_price_text AS from_text, price_text AS to_text, id
  FROM changed WHERE price_key IS DISTINCT FROM prev_key
  UNION ALL
  SELECT observed_at, merchant, variant_ext_id, title, variant_title, 'stock',
    CAST(CAST(prev_available AS INT) AS DOUBLE), CAST(CAST(available AS INT) AS DOUBLE),
    CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), id
  FROM changed WHERE available IS DISTINCT FROM prev_available
)"""

CHANGE = "\"at\", merchant, variant_ext_id, title, variant_title, kind, from_value, to_value, from_text, to_text"

MERGED = f"""
published AS (
  SELECT * EXCLUDE (id) REPLACE (to_value + 1 AS to_value) FROM events_found
  WHERE "at" < TIMESTAMP '2024-01-16 00:00:00'
  UNION ALL
  SELECT DISTINCT TIMESTAMP '2023-12-31 00:00:00', event_type, 'gone', 'Gone', CAST(NULL AS VARCHAR), 'price',
    CAST(1 AS DOUBLE), CAST(2 AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM events
),
merged AS (
  SELECT {CHANGE} FROM events_found
  UNION ALL
  SELECT {CHANGE} FROM published p WHERE NOT EXISTS (
    SELECT 1 FROM events_found f WHERE f."at" = p."at" AND f.merchant = p.merchant
      AND f.variant_ext_id = p.variant_ext_id AND f.kind = p.kind)
)"""

AMOUNT = "coalesce({price}, try_cast(nullif(regexp_extract({text}, '^\\s*([+-]?[0-9]+(\\.[0-9]*)?)', 1), '') AS DOUBLE), 0)"

# Each reading beside the next older one of its variant; the youngest one's pair is the difference.
DIFF = f"""
beside AS (
  SELECT merchant, variant_ext_id, title, variant_title, price AS curr_price, price_text AS curr_price_text,
    available AS curr_available, price_key AS curr_key, lead(price) OVER aged AS prev_price,
    lead(price_text) OVER aged AS prev_price_text, lead(available) OVER aged AS prev_available,
    lead(price_key) OVER aged AS prev_key
  FROM readings WINDOW aged AS (PARTITION BY merchant, variant_ext_id ORDER BY observed_at DESC, id DESC)
  QUALIFY row_number() OVER aged = 1
),
diff AS (
  SELECT * EXCLUDE (curr_key, prev_key),
    abs({AMOUNT.format(price="curr_price", text="curr_price_text")}
      - {AMOUNT.format(price="prev_price", text="prev_price_text")}) AS price_delta,
    curr_key IS DISTINCT FROM prev_key AS moved, curr_available IS DISTINCT FROM prev_available AS flipped
  FROM beside WHERE curr_key <> prev_key OR curr_available <> prev_available
)"""

LATEST = """
latest AS (
  SELECT * FROM {source} QUALIFY rank() OVER (PARTITION BY merchant, variant_ext_id ORDER BY observed_at DESC) = 1
)"""

PRODUCTS = """
placed AS (
  SELECT *, ROW_NUMBER() OVER p AS place,
    ROW_NUMBER() OVER (PARTITION BY merchant, product_ext_id, image_url IS NULL OR image_url = ''
      ORDER BY title NULLS FIRST, variant_title NULLS FIRST, variant_ext_id, id) AS image_place
  FROM latest WINDOW p AS (PARTITION BY merchant, product_ext_id
    ORDER BY title NULLS FIRST, variant_title NULLS FIRST, variant_ext_id, id)
),
product AS (
  SELECT merchant, product_ext_id,
    MAX(CASE WHEN place = 1 THEN handle END) AS handle,
    MAX(CASE WHEN place = 1 THEN title END) AS title,
    MAX(CASE WHEN place = 1 THEN nullif(vendor, '') END) AS vendor,
    MAX(CASE WHEN place = 1 THEN nullif(product_type, '') END) AS product_type,
    MAX(CASE WHEN image_place = 1 AND image_url <> '' THEN image_url END) AS img,
    MAX(CASE WHEN place = 1 THEN currency END) AS currency,
    COUNT(*) AS n_variants
  FROM placed GROUP BY merchant, product_ext_id
)"""

MONEY = """
CASE WHEN {raw} IS NULL OR trim({raw}) = '' THEN '{blank}'
  WHEN regexp_replace({raw}, '[^0-9.\\-]', '', 'g') = '' THEN '{zero}'
  WHEN NOT regexp_full_match(regexp_replace({raw}, '[^0-9.\\-]', '', 'g'), '-?([0-9]+\\.?[0-9]*|\\.[0-9]+)') THEN 'invalid'
  WHEN CAST(regexp_replace({raw}, '[^0-9.\\-]', '', 'g') AS DOUBLE) < 0 THEN 'invalid'
  WHEN CAST(regexp_replace({raw}, '[^0-9.\\-]', '', 'g') AS DOUBLE) = 0 THEN '{zero}'
  ELSE 'ok' END"""


def text_grade(column: str, least: int = 1) -> str:
    return (
        f"CASE WHEN {column} IS NULL OR trim({column}) = '' THEN 'missing' "
        f"WHEN length(trim({column})) >= {least} THEN 'ok' ELSE 'invalid' END"
    )


GRADES = f"""
grades AS (
  SELECT id, run_id, merchant,
    {MONEY.format(raw='price_raw', blank='missing', zero='invalid')} AS price_status,
    {MONEY.format(raw='compare_at_raw', blank='ok', zero='ok')} AS compare_at_price_status,
    CASE WHEN available IS NULL THEN 'missing' ELSE 'ok' END AS available_status,
    {text_grade('sku')} AS sku_status,
    {text_grade('title', 2)} AS title_status,
    {text_grade('variant_title')} AS variant_title_status
  FROM obs
)"""

FIELDS = ("price", "compare_at_price", "available", "sku", "title", "variant_title")


def unfolded(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT run_id, merchant, '{f}' AS field, {f}_status AS status FROM {source}" for f in FIELDS
    )


TALLY = f"""{GRADES},
outcomes AS (
  SELECT run_id, merchant, field, status, COUNT(*) AS count FROM ({unfolded('grades')}) u
  GROUP BY run_id, merchant, field, status
)"""

SUMS = """coalesce(SUM(count) FILTER (status = 'ok'), 0)::BIGINT AS ok,
  coalesce(SUM(count) FILTER (status = 'missing'), 0)::BIGINT AS missing,
  coalesce(SUM(count) FILTER (status = 'invalid'), 0)::BIGINT AS invalid,
  SUM(count)::BIGINT AS total,
  coalesce(SUM(count) FILTER (status = 'ok'), 0)::DOUBLE / SUM(count)::DOUBLE AS rate"""

RELIABLE = """
SELECT * EXCLUDE (n_good), n_good AS ok_runs, n_good::DOUBLE / runs AS ok_rate
FROM (
  SELECT merchant, count(*) AS runs, count(*) FILTER (ok = 1) AS n_good, max(started_at) AS last_run,
    max_by(method, started_at) AS method, sum(variants_seen)::BIGINT AS variants, sum(bytes)::BIGINT AS bytes,
    sum(cost_usd) AS cost, round(avg(duration_ms) FILTER (duration_ms <> 0)) AS avg_ms
  FROM runs {where} GROUP BY ALL)"""

WITH_TOTAL = f"""
reliable AS ({RELIABLE.format(where='')}),
with_total AS (
  SELECT merchant, method, runs, ok_runs, variants, cost, FALSE AS is_total,
    CAST(ok_runs AS DOUBLE) / runs AS ok_rate FROM reliable
  UNION ALL
  SELECT 'ALL', CAST(NULL AS VARCHAR), COUNT(*), CAST(SUM(ok) AS BIGINT), CAST(SUM(variants_seen) AS BIGINT),
    SUM(cost_usd), TRUE, CAST(SUM(ok) AS DOUBLE) / COUNT(*) FROM runs
)"""

REGRADED = f"""{TALLY},
replaced AS (SELECT id AS run_id, merchant FROM evruns WHERE ok = 1 AND id IN (SELECT run_id FROM obs)),
regraded AS (
  SELECT run_id, merchant, field, status, count FROM oldout WHERE run_id NOT IN (SELECT run_id FROM replaced)
  UNION ALL
  SELECT o.run_id, r.merchant, o.field, o.status, o.count FROM outcomes o JOIN replaced r ON r.run_id = o.run_id
)"""

# The feed: what each shop lists, straight from the tables, and its page rules.
SHOP = """
line AS (
  SELECT l_orderkey AS k, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_returnflag) - 1 AS vn,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_returnflag AS flag
  FROM lineitem
),
variant AS (
  SELECT *, CASE WHEN k % 5 = 0 THEN CAST(price AS STRING) ELSE concat('"', price, '"') END AS price_json,
    CASE vn % 4 WHEN 0 THEN ',"compare_at_price":null' WHEN 1 THEN ',"compare_at_price":"0"'
      WHEN 2 THEN '' ELSE concat(',"compare_at_price":"', price + 100, '"') END AS was_json,
    CASE flag WHEN 'A' THEN 'true' WHEN 'N' THEN 'false' ELSE '"yes"' END AS flag_json,
    CASE k % 11 WHEN 0 THEN concat(',"sku":', k) WHEN 1 THEN ',"sku":""' WHEN 2 THEN ''
      ELSE concat(',"sku":"SKU-', k, '-', vn, '"') END AS sku_json,
    CASE vn WHEN 3 THEN concat(',"featured_image":{"src":"https://cdn.example/', k, '-3.png?v=2"}')
      WHEN 5 THEN ',"featured_image":null' ELSE '' END AS image_json
  FROM line
),
variant_size AS (
  SELECT k AS pk, COUNT(*) AS n, CAST(SUM(octet_length(encode(concat('{"id":', k * 1000 + vn, ',"title":"',
    CASE WHEN vn = 0 THEN 'Default Title' ELSE concat('V', vn) END, '","price":', price_json, was_json,
    ',"available":', flag_json, sku_json, image_json, '}')))) + COUNT(*) - 1 AS BIGINT) AS bytes
  FROM variant GROUP BY k
),
listed AS (
  SELECT o_orderkey AS k, o_orderkey // 150 AS shop, CAST((o_orderkey % 150) // 15 + 1 AS INT) AS page,
    o_orderpriority, coalesce(n, 0) AS n,
    octet_length(encode(concat('{"id":', o_orderkey, ',"handle":"order-', o_orderkey, '"',
      CASE WHEN o_orderkey % 97 = 0 THEN ',"title":null' ELSE concat(',"title":"Order ', o_orderkey, '"') END,
      ',"vendor":"', CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'maker' END,
      '","product_type":"', o_orderpriority, '"',
      CASE WHEN o_orderkey % 6 = 0 THEN ',"images":[]'
        ELSE concat(',"images":[{"src":"https://cdn.example/', o_orderkey, '.png?v=1"}]') END, '}')))
      + CASE WHEN n IS NULL THEN 0 ELSE bytes + length(',"variants":[]') END AS bytes
  FROM orders LEFT JOIN variant_size ON pk = o_orderkey
),
page AS (
  SELECT shop, page, COUNT(*) AS n_products, CAST(SUM(n) AS BIGINT) AS n_variants,
    CAST(SUM(bytes) + COUNT(*) - 1 + length('{"products":[]}') AS BIGINT) AS n_bytes
  FROM listed GROUP BY shop, page
  UNION ALL
  SELECT DISTINCT o_orderkey // 150, 11, 1, 1, length('{"products":[{"id":1,"variants":[{"id":1}]}]}')
  FROM orders WHERE (o_orderkey // 150) % 23 = 6
),
fact AS (
  SELECT shop, shop + 1 AS run_id, page,
    CASE WHEN shop % 13 = 7 AND page = 2 THEN 503 WHEN shop % 5 = 3 AND page = 9 THEN 500 ELSE 200 END AS http_status,
    CASE WHEN (shop % 17 = 9 AND page = 3) OR (shop % 19 = 4 AND page = 1) THEN 0 ELSE n_products END AS n_products,
    CASE WHEN (shop % 17 = 9 AND page = 3) OR (shop % 19 = 4 AND page = 1) THEN 0 ELSE n_variants END AS n_variants,
    CASE WHEN shop % 17 = 9 AND page = 3 THEN 20 WHEN shop % 19 = 4 AND page = 1 THEN 15 ELSE n_bytes END AS n_bytes,
    CASE WHEN shop % 13 = 7 AND page = 2 THEN 'HTTP 503 on page 2'
      WHEN shop % 5 = 3 AND page = 9 THEN 'HTTP 500 on page 9'
      WHEN shop % 17 = 9 AND page = 3 THEN 'unparseable JSON on page 3 (<html>blocked</html>…)' END AS error,
    TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CAST(shop AS BIGINT)) + to_seconds(CAST(page AS BIGINT)) AS fetched_at
  FROM page
),
reached AS (
  SELECT * FROM (
    SELECT *, MIN(CASE WHEN error IS NULL AND n_products < 15 THEN page END) OVER (PARTITION BY run_id) AS end_page
    FROM fact) f
  WHERE end_page IS NULL OR page <= end_page
),
starts AS (
  SELECT s_suppkey + 1 AS run_id, s_suppkey AS shop, TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CAST(s_suppkey AS BIGINT)) AS begun_at
  FROM supplier
  UNION ALL SELECT 1000000 + s_suppkey, s_suppkey, TIMESTAMP '2024-02-02 00:00:00' + to_minutes(CAST(s_suppkey AS BIGINT))
  FROM supplier WHERE s_suppkey % 7 = 0
),
with_pages AS (
  SELECT shop, run_id, MIN(fetched_at) AS first_fetch, MAX(fetched_at) AS last_fetch, MAX(page) AS last_page,
    arg_max(http_status, page) AS last_status, MIN(end_page) AS end_page,
    MIN(CASE WHEN error IS NOT NULL THEN page END) AS failed_page,
    arg_min(CASE WHEN error IS NOT NULL THEN error END, CASE WHEN error IS NOT NULL THEN page END) AS failure,
    arg_min(CASE WHEN error IS NOT NULL THEN http_status END, CASE WHEN error IS NOT NULL THEN page END) AS failed_status,
    arg_min(CASE WHEN error IS NOT NULL THEN fetched_at END, CASE WHEN error IS NOT NULL THEN page END) AS failed_at,
    SUM(n_products) AS products, SUM(n_variants) AS variants, SUM(n_bytes) AS volume
  FROM reached GROUP BY shop, run_id
),
folded AS (
  SELECT w.* EXCLUDE (shop, run_id, first_fetch), coalesce(w.shop, s.shop) AS shop, coalesce(w.run_id, s.run_id) AS run_id,
    coalesce(begun_at, first_fetch) AS started_at
  FROM with_pages w FULL JOIN starts s ON s.run_id = w.run_id AND s.shop = w.shop
),
accounted AS (
  SELECT f.*, slug, method, currency, method <> 'shopify_products_json' AS no_adapter,
    coalesce(method = 'shopify_products_json' AND failed_page IS NULL AND (end_page IS NOT NULL OR last_page >= 10), FALSE) AS good
  FROM folded f JOIN registry ON slug = concat('shop-', shop) WHERE enabled
),
run_rows AS (
  SELECT run_id AS id, slug AS merchant, method, CAST(NULL AS VARCHAR) AS provider, started_at,
    CASE WHEN no_adapter THEN started_at WHEN failed_page IS NOT NULL THEN failed_at WHEN good THEN last_fetch END AS finished_at,
    CAST(good AS INT) AS ok,
    CASE WHEN good THEN last_status WHEN failed_page IS NOT NULL AND NOT no_adapter THEN failed_status END AS http_status,
    CASE WHEN no_adapter THEN concat('method "', method, '" has no adapter yet') ELSE failure END AS error,
    CAST(CASE WHEN good THEN products ELSE 0 END AS BIGINT) AS products_seen,
    CAST(CASE WHEN good THEN variants ELSE 0 END AS BIGINT) AS variants_seen,
    CAST(CASE WHEN good THEN volume ELSE 0 END AS BIGINT) AS bytes,
    CAST(0 AS DOUBLE) AS cost_usd, last_page, good AND end_page IS NULL AS truncated
  FROM accounted
),
decoded AS (
  SELECT a.run_id, a.slug AS merchant, CAST(l.k AS STRING) AS product_ext_id,
    CAST(l.k * 1000 + v.vn AS STRING) AS variant_ext_id, concat('order-', l.k) AS handle,
    CASE WHEN l.k % 97 = 0 THEN NULL ELSE concat('Order ', l.k) END AS title,
    CASE WHEN v.vn = 0 THEN 'Default Title' ELSE concat('V', v.vn) END AS variant_title,
    CASE WHEN l.k % 5 = 0 THEN '' ELSE 'maker' END AS vendor, l.o_orderpriority AS product_type,
    CASE l.k % 11 WHEN 0 THEN CAST(l.k AS STRING) WHEN 1 THEN '' WHEN 2 THEN NULL
      ELSE concat('SKU-', l.k, '-', v.vn) END AS sku,
    CASE WHEN l.k % 5 = 0 THEN regexp_replace(CAST(v.price AS STRING), '\\.?0+$', '')
      ELSE CAST(v.price AS STRING) END AS price_raw,
    CASE v.vn % 4 WHEN 1 THEN '0' WHEN 3 THEN CAST(v.price + 100 AS STRING) END AS compare_at_raw,
    a.currency, CASE v.flag WHEN 'A' THEN TRUE WHEN 'N' THEN FALSE END AS available,
    CASE WHEN v.vn = 3 THEN concat('https://cdn.example/', l.k, '-3.png')
      WHEN l.k % 6 <> 0 THEN concat('https://cdn.example/', l.k, '.png') END AS image_url,
    CASE l.k % 11 WHEN 0 THEN FALSE WHEN 2 THEN NULL ELSE TRUE END AS sku_is_text,
    CASE WHEN l.k % 97 <> 0 THEN TRUE END AS title_is_text, TRUE AS variant_title_is_text,
    a.last_fetch AS observed_at
  FROM accounted a JOIN listed l ON l.shop = a.shop AND l.page <= a.last_page JOIN variant v ON v.k = l.k
  WHERE a.good AND NOT (a.shop % 19 = 4)
  UNION ALL
  SELECT run_id, slug, '1', '1', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, currency, NULL, NULL, NULL, NULL, NULL, last_fetch
  FROM accounted WHERE good AND last_page = 11
)"""

BASE = {
    "ev": EV,
    "obs": BOTH["obs"].format(ev="ev"),
    "obs_day": OBS_DAY,
    "evruns": BOTH["evruns"].format(obs="obs"),
    "oldout": BOTH["oldout"].format(obs="obs"),
    "registry": BOTH["registry"].format(supplier="supplier", nation="nation"),
    "runs": RUNS,
    "readings": READ.format(source="obs"),
    "readings_day": READ.format(source="obs_day"),
}


def sql(select: str, *parts: str, base: str = "") -> str:
    ctes = [f"{name} AS ({BASE[name]}\n)" for name in base.split()]
    return "WITH " + ",\n".join([*ctes, *[p.strip() for p in parts]]) + "\n" + select.strip()


READINGS = "ev obs readings"
TIES = f"readings AS ({BASE['readings_day']}\n)"
TYPED = f"{typed('price_raw')} AS price, compare_at_raw, {typed('compare_at_raw')} AS compare_at_price"
STORED_TAIL = f"title, price_raw, {TYPED}, available, {{image}} AS image_url, observed_at"
STORED = f"id, run_id, merchant, product_ext_id, variant_ext_id, {STORED_TAIL}"
KEPT = "observed_at >= TIMESTAMP '2024-01-17 00:00:00'"
SHOWN = "coalesce({s}_price_text, CASE WHEN {s}_price IS NOT NULL THEN CAST({s}_price AS STRING) END)"
LABEL = "CASE WHEN {s}_available IS NULL THEN 'unknown' WHEN {s}_available THEN 'in' ELSE 'out' END"
FIELD_WINDOW = (
    f"SELECT o.merchant, field, {SUMS} FROM outcomes o JOIN evruns r ON r.id = o.run_id "
    f"WHERE r.started_at >= TIMESTAMP '2024-01-17 00:00:00' GROUP BY o.merchant, field"
)
RUN_WINDOW = "WHERE started_at >= TIMESTAMP '2000-01-02 00:00:00'"

_DOCUMENT = f"""
SELECT p.merchant AS m, p.product_ext_id AS p, CAST(0 AS BIGINT) AS part, p.handle AS h, p.title AS t, p.vendor,
  p.product_type AS type, p.img AS product_img, p.currency AS cur, CAST(d.place - 1 AS INT) AS place,
  d.variant_ext_id AS v, d.variant_title AS vt, nullif(d.sku, '') AS sku,
  {typed('d.price_raw')} AS price, {texts('d.price_raw')} AS price_text,
  nullif({typed('d.compare_at_raw')}, 0) AS was, nullif({texts('d.compare_at_raw')}, '') AS was_text,
  CAST(d.available AS INT) AS avail, CASE WHEN nullif(d.image_url, '') <> p.img THEN d.image_url END AS img
FROM product p JOIN placed d ON d.merchant = p.merchant AND d.product_ext_id = p.product_ext_id"""

ORACLE: dict[str, str] = {
    "change_history": sql(f"SELECT {CHANGE} FROM events_found", EVENTS, base=READINGS),
    "change_history_ties": sql(f"SELECT {CHANGE}, id FROM events_found", TIES, EVENTS, base="ev obs obs_day"),
    "latest_diff": sql("SELECT * EXCLUDE (moved, flipped) FROM diff", DIFF, base=READINGS),
    "latest_diff_counts": sql(
        "SELECT COUNT(*) FILTER (moved) AS price_changes, COUNT(*) FILTER (flipped) AS stock_flips FROM diff",
        DIFF, base=READINGS,
    ),
    "latest_diff_top12": sql(
        f"""SELECT merchant, variant_ext_id,
  left(concat(coalesce(title, 'null'), CASE WHEN variant_title IS NULL OR variant_title IN ('', 'Default Title') THEN ''
    ELSE concat(' (', variant_title, ')') END), 44) AS name,
  CASE WHEN moved THEN {SHOWN.format(s='prev')} END AS price_from,
  CASE WHEN moved THEN {SHOWN.format(s='curr')} END AS price_to,
  CASE WHEN flipped THEN {LABEL.format(s='prev')} END AS stock_from,
  CASE WHEN flipped THEN {LABEL.format(s='curr')} END AS stock_to
FROM diff ORDER BY merchant, price_delta DESC, variant_ext_id LIMIT 12""",
        DIFF, base=READINGS,
    ),
    "latest_diff_remainder": sql(
        "SELECT CAST(greatest(COUNT(*) - 12, 0) AS BIGINT) AS more FROM diff", DIFF, base=READINGS
    ),
    "changes_merged": sql(f"SELECT {CHANGE} FROM merged", EVENTS, MERGED, base=READINGS),
    "changes_newest": sql(
        f"SELECT {CHANGE} FROM merged ORDER BY \"at\" DESC, merchant, variant_ext_id, kind LIMIT 500",
        EVENTS, MERGED, base=READINGS,
    ),
    "changes_merged_ties": sql(
        f"""SELECT {CHANGE} FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY \"at\", merchant, variant_ext_id, kind ORDER BY id DESC) AS rn FROM events_found) e WHERE rn = 1""",
        TIES, EVENTS, base="ev obs obs_day",
    ),
    "change_merge_counts": sql(
        """SELECT (SELECT COUNT(*) FROM events_found) AS fresh, COUNT(*) AS merged, COUNT(*) AS retained FROM merged""",
        EVENTS, MERGED, base=READINGS,
    ),
    "latest_per_variant": sql(
        "SELECT id, merchant, variant_ext_id, price_raw, available, observed_at FROM latest",
        LATEST.format(source="obs_day"), base="ev obs obs_day",
    ),
    "catalogue_products": sql("SELECT * FROM product", LATEST.format(source="obs"), PRODUCTS, base="ev obs"),
    "catalogue_variants": sql(
        f"""SELECT l.merchant, l.product_ext_id, l.variant_ext_id, l.title, l.variant_title,
  nullif(l.sku, '') AS sku, {typed('l.price_raw')} AS price, {texts('l.price_raw')} AS price_text,
  nullif({typed('l.compare_at_raw')}, 0) AS was, nullif({texts('l.compare_at_raw')}, '') AS was_text,
  CAST(l.available AS INT) AS avail, CASE WHEN nullif(l.image_url, '') <> p.img THEN l.image_url END AS img
FROM latest l JOIN product p ON p.merchant = l.merchant AND p.product_ext_id = l.product_ext_id""",
        LATEST.format(source="obs"), PRODUCTS, base="ev obs",
    ),
    "catalogue_documents": sql(_DOCUMENT, LATEST.format(source="obs"), PRODUCTS, base="ev obs"),
    "catalogue_totals": sql(
        """SELECT COUNT(DISTINCT (merchant, product_ext_id)) AS products, COUNT(*) AS variants,
  COUNT(*) FILTER (available) AS in_stock, COUNT(*) FILTER (available IS NULL) AS unknown_stock,
  COUNT(DISTINCT (merchant, product_ext_id)) FILTER (image_url <> '') AS with_image FROM latest""",
        LATEST.format(source="obs"), base="ev obs",
    ),
    "freshness": sql("SELECT MAX(started_at) AS collected_at FROM runs WHERE ok = 1", base="runs"),
    "grade_rows": sql("SELECT * EXCLUDE (run_id, merchant) FROM grades", GRADES, base="ev obs"),
    "field_tally": sql("SELECT * FROM outcomes", TALLY, base="ev obs"),
    "run_tally_summary": sql(
        f"SELECT run_id, merchant, field, {SUMS} FROM outcomes GROUP BY run_id, merchant, field",
        TALLY, base="ev obs",
    ),
    "field_quality_all": sql(
        f"SELECT merchant, field, {SUMS} FROM outcomes GROUP BY merchant, field", TALLY, base="ev obs"
    ),
    "field_quality_window": sql(FIELD_WINDOW, TALLY, base="ev obs evruns"),
    "worst_field": sql(
        f"""SELECT merchant, CASE WHEN rate < 1 THEN field END AS least_reliable, rate, rate >= 1 AS all_complete
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY merchant ORDER BY rate, field) AS rn
  FROM (SELECT merchant, field, {SUMS} FROM outcomes GROUP BY merchant, field) q) r WHERE rn = 1""",
        TALLY, base="ev obs",
    ),
    "worst_field_per_run": sql(
        f"""SELECT run_id, merchant, CASE WHEN rate < 1 THEN field END AS least_reliable, rate, rate >= 1 AS all_complete
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id, merchant ORDER BY rate, field) AS rn
  FROM (SELECT run_id, merchant, field, {SUMS} FROM outcomes GROUP BY run_id, merchant, field) q) r WHERE rn = 1""",
        TALLY, base="ev obs",
    ),
    "not_ok_by_field": sql(
        """SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, field) AS INT) AS place
FROM (SELECT field, CAST(SUM(count) AS BIGINT) AS n FROM outcomes WHERE status <> 'ok' GROUP BY field) f""",
        TALLY, base="ev obs",
    ),
    "regrade_outcomes": sql("SELECT * FROM regraded", REGRADED, base="ev obs evruns oldout"),
    "regrade_stored": sql("SELECT * FROM regraded", REGRADED, base="ev obs evruns oldout"),
    "regrade_delta": sql(
        """SELECT field, CAST(SUM(b) AS BIGINT) AS not_ok_before, CAST(SUM(a) AS BIGINT) AS not_ok_after,
  CAST(SUM(a) - SUM(b) AS BIGINT) AS delta, CAST(ROW_NUMBER() OVER (ORDER BY field) AS INT) AS place FROM (
  SELECT field, count AS b, 0 AS a FROM oldout WHERE status <> 'ok'
  UNION ALL SELECT field, 0, count FROM regraded WHERE status <> 'ok') u GROUP BY field""",
        REGRADED, base="ev obs evruns oldout",
    ),
    "regraded_runs": sql(
        "SELECT COUNT(*) AS regraded FROM evruns WHERE ok = 1 AND id IN (SELECT run_id FROM obs)",
        base="ev obs evruns",
    ),
    "constraint_violations": sql(
        """SELECT 'runs' AS table_name, 'unique' AS rule, CAST(id AS STRING) AS key, COUNT(*) AS n_rows
  FROM evruns GROUP BY id HAVING COUNT(*) > 1
UNION ALL SELECT 'field_outcomes', 'unique', concat_ws('|', run_id, field, status), COUNT(*)
  FROM oldout GROUP BY run_id, field, status HAVING COUNT(*) > 1
UNION ALL SELECT 'field_outcomes', 'status', status, COUNT(*) FROM oldout
  WHERE status NOT IN ('ok', 'missing', 'invalid') GROUP BY status
UNION ALL SELECT 'field_outcomes', 'run', CAST(run_id AS STRING), COUNT(*) FROM oldout
  WHERE run_id NOT IN (SELECT id FROM evruns WHERE ok = 1) GROUP BY run_id
UNION ALL SELECT 'observations', 'run', CAST(run_id AS STRING), COUNT(*) FROM read_twice
  WHERE run_id NOT IN (SELECT id FROM evruns WHERE ok = 1) GROUP BY run_id
UNION ALL SELECT 'observations', 'unique', concat_ws('|', run_id, id), COUNT(*) FROM read_twice GROUP BY run_id, id HAVING COUNT(*) > 1
UNION ALL SELECT 'observations', 'required', 'variant_ext_id', COUNT(*) FROM read_twice WHERE id % 500 = 0 HAVING COUNT(*) > 0""",
        "read_twice AS (SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE id % 700 = 0)",
        base="ev obs evruns oldout",
    ),
    "run_reliability": sql(RELIABLE.format(where=""), base="runs"),
    "run_reliability_window": sql(RELIABLE.format(where=RUN_WINDOW), base="runs"),
    "run_reliability_all": sql(
        "SELECT *, printf('%.1f%%', ok_rate * 100) AS ok_text FROM with_total", WITH_TOTAL, base="runs"
    ),
    "cost_per_parse": sql(
        """SELECT merchant, is_total, cost, variants, cost / nullif(variants, 0) AS cost_per_parse
FROM with_total WHERE cost > 0 OR is_total""",
        WITH_TOTAL, base="runs",
    ),
    "snapshot_counts": sql(
        """SELECT merchant, COUNT(DISTINCT observed_at) AS snaps, COUNT(DISTINCT observed_at) > 1 AS comparable
FROM obs_day GROUP BY merchant""",
        base="ev obs obs_day",
    ),
    "cycle_summary": sql(
        """SELECT make_timestamp(epoch_us(started_at) // 43200000000 * 43200000000) AS cycle,
  COUNT(DISTINCT merchant) FILTER (ok = 1) AS succeeded, COUNT(DISTINCT merchant) AS attempted,
  MAX(ok) = 0 AS all_failed FROM runs GROUP BY 1""",
        base="runs",
    ),
    "redacted_reliability": sql(
        """SELECT CASE WHEN is_total THEN t.merchant ELSE coalesce(label, 'merchant-?') END AS merchant, method, runs, ok_runs, variants, cost, is_total, ok_rate
FROM with_total t LEFT JOIN (SELECT merchant, concat('merchant-', chr(CAST(64 + ROW_NUMBER() OVER (ORDER BY merchant) AS INT))) AS label
  FROM reliable) n ON n.merchant = t.merchant""",
        WITH_TOTAL, base="runs",
    ),
    "published_runs": sql(
        """SELECT id, merchant, method, CAST(NULL AS VARCHAR) AS provider, started_at, finished_at, ok,
  CAST(NULL AS INT) AS http_status, CAST(NULL AS VARCHAR) AS error, products_seen, variants_seen,
  CAST(NULL AS BIGINT) AS bytes, CAST(NULL AS BIGINT) AS duration_ms, CAST(NULL AS DOUBLE) AS cost_usd FROM evruns""",
        base="ev obs evruns",
    ),
    "published_merchants": sql(
        "SELECT slug, name, base_url, currency, method, enabled, method_rationale FROM registry", base="registry"
    ),
    "report_json": sql(
        f"""SELECT 'reliability' AS section, merchant, to_json(struct_pack(merchant := merchant, method := method, runs := runs,
  ok_runs := ok_runs, ok_rate := ok_rate, variants := variants, avg_ms := avg_ms, bytes := bytes, cost := cost,
  last_run := strftime(last_run, '%Y-%m-%dT%H:%M:%S.%f'))) AS line FROM recent
UNION ALL SELECT 'fields', merchant, to_json(struct_pack(merchant := merchant, field := field, ok := ok,
  missing := missing, invalid := invalid, total := total, rate := rate)) FROM quality
UNION ALL SELECT 'changes', merchant, to_json(struct_pack(merchant := merchant, variant_ext_id := variant_ext_id,
  title := title, variant_title := variant_title, prev_price := prev_price, prev_price_text := prev_price_text,
  prev_available := prev_available, curr_price := curr_price, curr_price_text := curr_price_text,
  curr_available := curr_available, price_delta := price_delta)) FROM diff
UNION ALL SELECT 'snapshots', merchant, to_json(struct_pack(merchant := merchant,
  snaps := COUNT(DISTINCT observed_at), comparable := COUNT(DISTINCT observed_at) > 1)) FROM obs GROUP BY merchant""",
        DIFF, TALLY, f"recent AS ({RELIABLE.format(where=RUN_WINDOW)})", f"quality AS ({FIELD_WINDOW})",
        base="ev obs evruns runs readings",
    ),
    "prune_plan": sql(
        f"SELECT COUNT(*) AS total, COUNT(*) FILTER (NOT {KEPT}) AS doomed, COUNT(*) FILTER ({KEPT}) AS kept FROM obs",
        base="ev obs",
    ),
    "prune_keep": sql(f"SELECT * FROM obs WHERE {KEPT}", base="ev obs"),
    "prune_stored": sql(
        f"SELECT {STORED.format(image='image_url')} FROM obs WHERE {KEPT}", base="ev obs"
    ),
    "evolve_schema": sql(f"SELECT {STORED.format(image='CAST(NULL AS VARCHAR)')} FROM obs", base="ev obs"),
    "snapshot_changes": sql(f"SELECT {CHANGE} FROM events_found", EVENTS, base=READINGS),
    "merchant_registry": sql(
        "SELECT slug, name, base_url, currency, method, enabled, method_rationale FROM registry WHERE enabled",
        base="registry",
    ),
    "one_merchant": sql(
        "SELECT slug, currency, method FROM registry WHERE enabled AND slug = 'shop-3'", base="registry"
    ),
    "page_facts": sql("SELECT run_id, page, n_products, n_variants, error FROM fact", SHOP, base="registry"),
    "run_accounting": sql(
        """SELECT id, merchant, method, provider, started_at, finished_at, ok, http_status, error, products_seen,
  variants_seen, bytes, CAST(date_diff('millisecond', started_at, finished_at) AS BIGINT) AS duration_ms, cost_usd,
  last_page, truncated FROM run_rows""",
        SHOP, base="registry",
    ),
    "run_failures": sql(
        "SELECT id, merchant, http_status, left(error, 300) AS error FROM run_rows WHERE ok = 0", SHOP, base="registry"
    ),
    "feed_decode": sql("SELECT * FROM decoded", SHOP, base="registry"),
    "feed_grades": sql(
        f"""SELECT run_id, merchant, field, status, COUNT(*) AS count FROM ({unfolded('feed_grades')}) u
GROUP BY run_id, merchant, field, status""",
        SHOP,
        f"""feed_grades AS (SELECT run_id, merchant,
  CASE WHEN price_raw IS NULL THEN 'missing' WHEN CAST(price_raw AS DOUBLE) > 0 THEN 'ok' ELSE 'invalid' END AS price_status, 'ok' AS compare_at_price_status,
  CASE WHEN available IS NULL THEN 'missing' ELSE 'ok' END AS available_status,
  CASE WHEN NOT sku_is_text THEN 'invalid' ELSE {text_grade('sku')} END AS sku_status,
  {text_grade('title', 2)} AS title_status, {text_grade('variant_title')} AS variant_title_status FROM decoded)""",
        base="registry",
    ),
    "stream_ingest": sql(
        f"SELECT run_id, merchant, product_ext_id, variant_ext_id, {STORED_TAIL.format(image='image_url')} FROM decoded",
        SHOP, base="registry",
    ),
    "stream_changes": sql(f"SELECT {CHANGE} FROM events_found", EVENTS, base=READINGS),
}

ORACLE["published_fields"] = ORACLE["field_quality_all"]
ORACLE["published_totals"] = ORACLE["catalogue_totals"]
ORACLE["published_catalogue"] = ORACLE["catalogue_documents"]
ORACLE["registry_json"] = ORACLE["merchant_registry"]
ORACLE["report_written"] = f"""
SELECT concat('merchant-', chr(CAST(64 + ROW_NUMBER() OVER (ORDER BY merchant) AS INT))) AS merchant, snaps, comparable
FROM ({ORACLE['snapshot_counts']}) s"""
ORACLE["stream_ingest_split"] = ORACLE["stream_ingest"]
ORACLE["stream_runs_split"] = f"SELECT * EXCLUDE (last_page, truncated) FROM ({ORACLE['run_accounting']}) r"
ORACLE["stream_regrade"] = ORACLE["feed_grades"]
ORACLE["stream_changes_late"] = ORACLE["stream_changes_late_pruned"] = ORACLE["stream_changes"]
ORACLE["change_history_sliced"] = ORACLE["change_history"]
ORACLE["change_history_ties_sliced"] = ORACLE["change_history_ties"]
ORACLE["latest_per_variant_spread"] = ORACLE["latest_per_variant"]
ORACLE["catalogue_document_parts"] = (
    f"SELECT m, p, h, t, v, vt, sku, price, price_text, was, was_text, avail, img FROM ({ORACLE['catalogue_documents']}) d"
)
ORACLE["redacted_changes"] = sql(
    """SELECT d.* EXCLUDE (moved, flipped) REPLACE (label AS merchant) FROM diff d JOIN (
  SELECT merchant AS name, concat('merchant-', chr(CAST(64 + ROW_NUMBER() OVER (ORDER BY merchant) AS INT))) AS label
  FROM (SELECT DISTINCT merchant FROM obs) m) n ON n.name = d.merchant""",
    DIFF, base=READINGS,
)

ORACLE["stream_state_changes"] = ORACLE["stream_changes_compacted"] = ORACLE["stream_changes"]
# A pause of more than half a day since the reading before starts a variant afresh.
ORACLE["stream_state_changes_kept"] = sql(
    f"""SELECT {", ".join("e." + c.strip() for c in CHANGE.split(","))} FROM events_found e JOIN (
  SELECT id, lag(observed_at) OVER (PARTITION BY merchant, variant_ext_id ORDER BY observed_at, id) AS before
  FROM readings) b ON b.id = e.id WHERE e."at" - b.before <= INTERVAL 12 HOUR""",
    EVENTS, base=READINGS,
)
# The third step's readings, where the first two brought a later one of the variant.
ORACLE["stream_state_late"] = sql(
    """SELECT id, merchant, variant_ext_id, observed_at FROM steps s WHERE withheld AND EXISTS (
  SELECT 1 FROM steps o WHERE NOT o.withheld AND o.merchant = s.merchant AND o.variant_ext_id = s.variant_ext_id
    AND (o.observed_at, o.id) > (s.observed_at, s.id))""",
    "steps AS (SELECT *, day(observed_at) BETWEEN 20 AND 24 AND id % 3 = 0 AS withheld FROM obs)", base="ev obs",
)
ORACLE["compact_stored"] = sql(
    f"SELECT {STORED.format(image='image_url')}, CAST(1 AS BIGINT) AS batches FROM obs", base="ev obs")
# The second wave brings every fifth page for the first time; the watermark trails the first wave's newest.
_WAVES = """
landed AS (
  SELECT run_id, concat('shop-', shop) AS merchant, CAST(page AS INT) AS page, http_status, fetched_at, CAST(n_bytes AS INT) AS n_bytes,
    page % 5 = 0 AND fetched_at <= (SELECT max(fetched_at) FROM fact WHERE page % 5 <> 0) - INTERVAL 3 MINUTE AS late
  FROM fact
)"""
ORACLE["stream_deduplicated"] = sql("SELECT * EXCLUDE (late) FROM landed WHERE NOT late", SHOP, _WAVES, base="registry")
ORACLE["stream_late_pages"] = sql("SELECT run_id, merchant, page FROM landed WHERE late", SHOP, _WAVES, base="registry")

ORACLE["published_runs_in_order"] = sql(
    "SELECT id, merchant, started_at, ROW_NUMBER() OVER (ORDER BY started_at, id) AS place FROM evruns", base="ev obs evruns")
ORACLE["published_fields_in_order"] = f"""
SELECT merchant, field, rate, ROW_NUMBER() OVER (ORDER BY merchant, rate, field) AS place FROM ({ORACLE['field_quality_all']}) q"""
ORACLE["published_changes_in_order"] = f"""
SELECT "at", merchant AS m, variant_ext_id AS v, kind,
  ROW_NUMBER() OVER (ORDER BY "at" DESC, merchant, variant_ext_id, kind) AS place FROM ({ORACLE['snapshot_changes']}) c"""
ORACLE["run_fields_in_order"] = f"""
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY run_id, merchant ORDER BY rate, field) AS INT) AS place
FROM ({ORACLE['run_tally_summary']}) s"""

# The merchants of readings and runs together, in alphabetical order; beyond 26 they are numbered.
_NAMES = """
named AS (
  SELECT merchant AS name, ROW_NUMBER() OVER (ORDER BY merchant) AS n
  FROM (SELECT merchant FROM obs UNION SELECT merchant FROM runs) m
),
shown AS (
  SELECT name, CASE WHEN n <= 26 THEN concat('merchant-', chr(CAST(64 + n AS INT))) ELSE concat('merchant-', n) END AS label FROM named
)"""


def _written(section: str, order: str, *parts: str) -> str:
    return sql(
        f"""SELECT * EXCLUDE (name, label) REPLACE (label AS merchant), ROW_NUMBER() OVER (ORDER BY {order}) AS place
FROM ({section}) s JOIN shown ON name = s.merchant""", *parts, _NAMES, base="ev obs evruns runs readings")


ORACLE["report_reliability_written"] = _written(RELIABLE.format(where=RUN_WINDOW), "label")
ORACLE["report_fields_written"] = _written(FIELD_WINDOW, "label, rate, field", TALLY)
ORACLE["report_changes_written"] = _written(
    "SELECT * EXCLUDE (moved, flipped) FROM diff", "label, price_delta DESC, variant_ext_id", DIFF)
ORACLE["report_snapshots_written"] = _written(
    "SELECT merchant, COUNT(DISTINCT observed_at) AS snaps, COUNT(DISTINCT observed_at) > 1 AS comparable FROM obs GROUP BY merchant",
    "label")
ORACLE["snapshot_counts_by_window"] = sql(
    " UNION ALL ".join(
        f"""SELECT merchant, COUNT(DISTINCT observed_at) AS snaps, COUNT(DISTINCT observed_at) > 1 AS comparable, CAST({days} AS INT) AS days
FROM obs_day WHERE {since} GROUP BY merchant"""
        for days, since in ((7, "observed_at >= TIMESTAMP '2024-01-24 00:00:00'"), (14, KEPT), ("NULL", "TRUE"))),
    base="ev obs obs_day")
ORACLE["field_quality_maintained"] = ORACLE["field_quality_all"]
ORACLE["bucketed_history"] = ORACLE["change_history"]
ORACLE["bucketed_latest_diff"] = ORACLE["latest_diff"]
ORACLE["bucketed_latest"] = sql(f"SELECT {STORED.format(image='image_url')} FROM latest", LATEST.format(source="obs"), base="ev obs")
ORACLE["evolve_stored"] = sql(
    f"SELECT {STORED.format(image='CASE WHEN id % 2 = 1 THEN image_url END')} FROM obs", base="ev obs")
ORACLE["regrade_few_stored"] = sql(
    """SELECT * FROM oldout WHERE run_id NOT IN (SELECT run_id FROM replaced WHERE run_id % 7 = 0)
UNION ALL SELECT o.run_id, r.merchant, o.field, o.status, o.count FROM outcomes o JOIN replaced r ON r.run_id = o.run_id
WHERE o.run_id % 7 = 0""", REGRADED, base="ev obs evruns oldout")
