"""Column types of every stored table, in one place."""

from __future__ import annotations

from pyspark.sql import types as T

# The graded fields and the three outcomes a field can have.
FIELDS = ("price", "compare_at_price", "available", "sku", "title", "variant_title")
STATUSES = ("ok", "missing", "invalid")

# The one supported collection method and the feed's page rules.
SUPPORTED_METHOD = "shopify_products_json"
PAGE_LIMIT = 250
CRAWLED_PAGES = 10

# Fixed formats: error texts of failed runs, and how much of a text is shown.
HTTP_ERROR = "HTTP %d on page %d"
UNPARSEABLE_ERROR = "unparseable JSON on page %d (%s…)"
NO_ADAPTER_ERROR = 'method "%s" has no adapter yet'
BODY_START = 60
ERROR_LENGTH = 300

# Kinds of change, changes shown in the report, width of a shown name.
PRICE_KIND = "price"
STOCK_KIND = "stock"
TOP_CHANGES = 12
NAME_WIDTH = 44

# Published document version, newest changes shown, retention window,
# hours between two collections, the name shown of a merchant without a label.
SCHEMA_VERSION = 1
NEWEST_CHANGES = 500
RETENTION_DAYS = 14
CYCLE_HOURS = 12
UNLABELLED = "merchant-?"


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def struct_of(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


REGISTRY = struct_of(
    "slug string, name string, method string, base_url string, currency string,"
    " enabled boolean, method_rationale string"
)

PAGES = struct_of(
    "run_id bigint, merchant string, page int, http_status int, body string, fetched_at timestamp"
)

RUNS = struct_of(
    "id bigint, merchant string, method string, provider string, started_at timestamp,"
    " finished_at timestamp, ok int, http_status int, error string, products_seen bigint,"
    " variants_seen bigint, bytes bigint, duration_ms bigint, cost_usd double"
)

FIELD_OUTCOMES = struct_of(
    "run_id bigint, merchant string, field string, status string, count bigint"
)

OBSERVATIONS = struct_of(
    "id bigint, run_id bigint, merchant string, product_ext_id string, variant_ext_id string,"
    " handle string, title string, variant_title string, vendor string, product_type string,"
    " sku string, price_raw string, price double, compare_at_raw string,"
    " compare_at_price double, currency string, available boolean, image_url string,"
    " sku_is_text boolean, title_is_text boolean, variant_title_is_text boolean,"
    " observed_at timestamp"
)

CHANGES = struct_of(
    "at timestamp, merchant string, variant_ext_id string, title string, variant_title string,"
    " kind string, from_value double, to_value double, from_text string, to_text string"
)

# The partition column of stored readings: their UTC day.
OBSERVED_DAY = "obs_date"
CHANGE_KEY = ("at", "merchant", "variant_ext_id", "kind")
SERIES_KEY = ("merchant", "variant_ext_id")
