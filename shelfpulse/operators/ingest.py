"""From landed feed pages to run records and variant readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.functions.text import image_of
from shelfpulse.schemas import (
    BODY_START, CRAWLED_PAGES, HTTP_ERROR, NO_ADAPTER_ERROR, PAGE_LIMIT,
    SUPPORTED_METHOD, UNPARSEABLE_ERROR,
)
from shelfpulse.session import micros

RUN_KEY = ("run_id", "merchant")
_NO_ITEMS = "array<variant>"
# What is read of a feed, each list in one cast. An item of a list as VARIANT is built anew with all it holds, so only
# values that are told apart by their kind stay one. Items that are no object, and lists that are none, come out as null.
_SHAPE = "array<struct<variants:array<struct<id:boolean>>>>"
_VARIANT = (
    "struct<id:variant,title:variant,sku:variant,price:variant,compare_at_price:variant,available:variant,"
    "featured_image:struct<src:string>>"
)
_PRODUCTS = (
    "array<struct<id:variant,handle:string,title:variant,vendor:string,product_type:string,"
    f"images:array<struct<src:string>>,variants:array<{_VARIANT}>>>"
)


def _type(value: Column) -> Column:
    return F.schema_of_variant(value)


def _has_value(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _list(value: Column, path: str) -> Column:
    """The list at `path`; no list, no items."""
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.array().cast(_NO_ITEMS))


def _not_a_list(value: Column, path: str) -> Column:
    there = _has_value(F.try_variant_get(value, path, "variant"))
    return there & F.try_variant_get(value, path, "array<variant>").isNull()


def _broken_product(product: Column) -> Column:
    """A null where a product or variant belongs, or variants that are no list."""
    return (
        F.is_variant_null(product)
        | _not_a_list(product, "$.variants")
        | F.exists(_list(product, "$.variants"), F.is_variant_null)
    )


FEED = "feed"


def parsed(pages: DataFrame) -> DataFrame:
    """Pages with their body as a VARIANT, null where it is no JSON, and what accounting needs of its text.

    Write it out: facts and decoding then read the typed column, and no body is parsed twice."""
    if FEED in pages.columns:
        return pages
    return pages.withColumns({
        FEED: F.try_parse_json("body"),
        "n_bytes": F.octet_length("body").cast("bigint"),
        "body_start": F.left("body", F.lit(BODY_START)),
        "content": F.xxhash64("http_status", "body"),
    }).drop("body")


def _any_broken(shape: Column) -> Column:
    """Whether a product of the feed is broken. `shape` tells it of most: the feed's items are looked at one by one only
    where one is no object, and its lists of variants where one is missing or no list."""
    no_object = F.exists(shape, lambda p: p.isNull() | F.exists(F.coalesce(
        p["variants"], F.array().cast("array<struct<id:boolean>>")), lambda v: v.isNull()))
    lists = F.try_variant_get(F.col(FEED), "$.products", "array<struct<variants:variant>>")
    return F.when(no_object, F.exists(_list(F.col(FEED), "$.products"), _broken_product)).when(
        F.exists(shape, lambda p: p["variants"].isNull()),
        F.exists(lists, lambda p: _has_value(p["variants"]) & F.try_variant_get(
            p["variants"], "$", "array<struct<id:boolean>>").isNull())).otherwise(F.lit(False))


def page_facts(pages: DataFrame) -> DataFrame:
    """What each landed page holds or why it is unusable, without its body."""
    parsed_pages = parsed(pages).withColumn("products", F.try_variant_get(F.col(FEED), "$.products", _SHAPE))
    status_ok = F.col("http_status").between(200, 299)
    no_list = F.col("products").isNull() & _has_value(F.try_variant_get(F.col(FEED), "$.products", "variant"))
    parsed_pages = parsed_pages.withColumn(
        "unusable", F.is_variant_null(FEED) | no_list | F.coalesce(_any_broken(F.col("products")), F.lit(False)))
    unusable = F.col("unusable")
    error = (
        F.when(F.col("http_status").isNull(), F.format_string("no response on page %d", "page"))
        .when(~status_ok, F.format_string(HTTP_ERROR, "http_status", "page"))
        .when(F.col("feed").isNull(), F.format_string(UNPARSEABLE_ERROR, "page", "body_start"))
        .when(unusable, F.format_string("unusable feed on page %d", "page"))
    )
    variants = F.coalesce(F.aggregate(
        "products", F.lit(0).cast("bigint"), lambda n, p: n + F.coalesce(F.array_size(p["variants"]), F.lit(0)),
    ), F.lit(0).cast("bigint"))
    return parsed_pages.select(
        *RUN_KEY, "page", "fetched_at", "http_status",
        F.coalesce(F.array_size("products"), F.lit(0)).cast("bigint").alias("n_products"),
        variants.alias("n_variants"),
        "n_bytes", "content",
        F.coalesce(unusable & status_ok, F.lit(False)).alias("misshapen"),
        error.alias("error"),
    )


def _landed_once(facts: DataFrame) -> DataFrame:
    """One row per page, the first of equal copies; copies that differ are an error.

    Copies shrink before the shuffle, so each run has at most as many rows as pages.
    """
    values = [c for c in facts.columns if c not in (*RUN_KEY, "page", "error", "content")]
    differ = F.format_string("page %d landed with different contents", "page")
    return (
        facts.groupBy(*RUN_KEY, "page")
        .agg(
            F.min(F.struct(*values, "error")).alias("first"), F.count(F.lit(1)).alias("landings"),
            (F.min("content") != F.max("content")).alias("differ"),
        )
        .select(
            *RUN_KEY, "page", "landings", *[f"first.{v}" for v in values],
            F.when(F.col("differ"), differ).otherwise(F.col("first.error")).alias("error"),
        )
    )


def derive_runs(
    facts: DataFrame,
    registry: DataFrame,
    page_limit: int = PAGE_LIMIT,
    crawled_pages: int = CRAWLED_PAGES,
    starts: DataFrame | None = None,
) -> DataFrame:
    """One complete run record per run of an enabled merchant.

    `starts` (run_id, merchant, started_at) names runs that began, so that one
    without a single landed page is still recorded, as failed.

    A run has all its landed pages up to the first short one; what landed after that
    was never asked for. Its first unusable page fails it and voids its volumes. The
    collector may stop after `crawled_pages` full pages; a run that stops before without
    a short one has no finish and counts as failed.
    `last_page`, `truncated` (more pages may exist), `copied` (a page landed more than
    once) and the registry's `currency` are extra columns.
    """
    per_run = Window.partitionBy(*RUN_KEY)
    short = F.col("error").isNull() & (F.col("n_products") < page_limit)
    reached = (
        _landed_once(facts)
        .withColumn("end_page", F.min(F.when(short, F.col("page"))).over(per_run))
        .where(F.col("end_page").isNull() | (F.col("page") <= F.col("end_page")))
    )
    told = F.when(~F.col("misshapen"), F.col("http_status")).alias("http_status")  # an answer in a wrong shape has none
    failing = F.when(F.col("error").isNotNull(), F.struct("page", "error", told, "fetched_at"))
    folded = reached.groupBy(*RUN_KEY).agg(
        F.min("fetched_at").alias("started_at"),
        F.max("fetched_at").alias("last_fetch"),
        F.max_by("http_status", "page").alias("last_status"),
        F.max("page").alias("last_page"),
        F.count(F.lit(1)).alias("pages"),
        F.max("landings").alias("landings"),
        F.min("end_page").alias("end_page"),
        F.min(failing).alias("failure"),
        F.sum("n_products").alias("products"),
        F.sum("n_variants").alias("variants"),
        F.sum("n_bytes").alias("volume"),
    )
    if starts is not None:
        begun = starts.select(*RUN_KEY, F.col("started_at").alias("begun_at"))
        started = F.coalesce("begun_at", "started_at")
        folded = folded.join(begun, list(RUN_KEY), "full_outer").withColumn("started_at", started)
    known = registry.where("enabled").select(F.col("slug").alias("merchant"), "method", "currency")
    whole = F.col("pages") == F.col("last_page")
    at_end = F.col("end_page").isNotNull() | (F.col("last_page") >= crawled_pages)
    no_adapter = F.col("method") != SUPPORTED_METHOD
    failed = F.col("failure").isNotNull()
    ok = ~no_adapter & ~failed & F.coalesce(whole & at_end, F.lit(False))
    finished = (
        F.when(no_adapter, F.col("started_at"))
        .when(failed, F.col("failure.fetched_at"))
        .when(ok, F.col("last_fetch"))
    )
    error = F.when(no_adapter, F.format_string(NO_ADAPTER_ERROR, "method")).when(
        failed, F.col("failure.error")
    )
    status = F.when(ok, F.col("last_status")).when(failed & ~no_adapter, F.col("failure.http_status"))
    volume = lambda c: F.when(ok, F.col(c)).otherwise(0).cast("bigint")
    return folded.join(known, "merchant").select(
        F.col("run_id").alias("id"), "merchant", "method",
        F.lit(None).cast("string").alias("provider"),
        "started_at", finished.alias("finished_at"),
        ok.cast("int").alias("ok"), status.alias("http_status"),
        error.alias("error"),
        volume("products").alias("products_seen"),
        volume("variants").alias("variants_seen"),
        volume("volume").alias("bytes"),
        F.floor((micros(finished) - micros(F.col("started_at"))) / 1000).alias("duration_ms"),
        F.lit(0.0).alias("cost_usd"),
        "last_page",
        (ok & F.col("end_page").isNull()).alias("truncated"),
        (F.coalesce("landings", F.lit(0)) > 1).alias("copied"),
        "currency",
    )


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _id(value: Column) -> Column:
    return F.coalesce(_text(value), F.when(F.is_variant_null(value), "null"), F.lit("undefined"))


def _money(value: Column) -> Column:
    """Price as text; a number in scientific notation is written out."""
    digits = F.format_string("%.20f", F.try_variant_get(value, "$", "double"))
    written_out = F.regexp_replace(digits, r"\.?0+\z", "")
    return F.when(_type(value) == "DOUBLE", written_out).otherwise(_text(value))


def _sent_as_text(value: Column) -> Column:
    return F.when(_has_value(value), _type(value) == "STRING")


def decode_pages(pages: DataFrame, runs: DataFrame, copied: DataFrame | None = None) -> DataFrame:
    """Readings of the successful runs, one row per variant, still as the feed sent them.

    `runs` comes from `derive_runs`; written out first, it is small enough for the
    planner to broadcast, so page bodies are not shuffled; only those of runs with
    copied pages are. `copied` has those of `runs` with copied pages, where they are written out
    on their own: they are few, so where `runs` is large, bodies are shuffled once and not twice. `id` orders the readings of a run, which all share one
    `observed_at`, and is their own within it: page and place on the page, of which a
    body has fewer than 2**31.
    """
    def read(of: DataFrame) -> DataFrame:
        good = of.where("ok = 1").select(
            F.col("id").alias("run_id"), "merchant", "last_page", "currency", F.col("finished_at").alias("observed_at"),
        )
        return parsed(pages).join(good, list(RUN_KEY)).where(F.col("page") <= F.col("last_page"))

    once = read((runs if copied is None else copied).where("copied")).dropDuplicates([*RUN_KEY, "page"])
    listed = read(runs.where("NOT copied")).unionByName(once).select(
        *RUN_KEY, "page", "currency", "observed_at",
        F.try_variant_get(F.col(FEED), "$.products", _PRODUCTS).alias("products"),
    )
    sizes = F.transform("products", lambda p: F.coalesce(F.array_size(p["variants"]), F.lit(0)))
    before = F.aggregate(F.slice("sizes", F.lit(1), F.col("product_no")), F.lit(0), lambda n, m: n + m)
    products = listed.withColumn("sizes", sizes).select(
        *RUN_KEY, "page", "currency", "observed_at", "sizes",
        F.posexplode("products").alias("product_no", "product"),
    )
    # What variants share is worked out once for each product.
    variants = products.select(
        *RUN_KEY, "page", "currency", "observed_at", before.alias("before"),
        _id(F.col("product.id")).alias("product_ext_id"),
        F.col("product.handle").alias("handle"),
        _text(F.col("product.title")).alias("title"),
        F.col("product.vendor").alias("vendor"),
        F.col("product.product_type").alias("product_type"),
        F.get("product.images", F.lit(0))["src"].alias("product_image"),
        _sent_as_text(F.col("product.title")).alias("title_is_text"),
        F.col("product.variants").alias("variants"),
    ).select("*", F.posexplode("variants").alias("variant_no", "item")).drop("variants")
    place = F.col("page").cast("bigint") * (1 << 31) + F.col("before") + F.col("variant_no")
    available = F.col("item.available")
    return variants.select(
        place.alias("id"), *RUN_KEY, "product_ext_id",
        _id(F.col("item.id")).alias("variant_ext_id"),
        "handle", "title",
        _text(F.col("item.title")).alias("variant_title"),
        "vendor", "product_type",
        _text(F.col("item.sku")).alias("sku"),
        _money(F.col("item.price")).alias("price_raw"),
        _money(F.col("item.compare_at_price")).alias("compare_at_raw"),
        "currency",
        F.when(_type(available) == "BOOLEAN", F.try_variant_get(available, "$", "boolean")).alias("available"),
        image_of(F.col("item.featured_image.src"), F.col("product_image")).alias("image_url"),
        _sent_as_text(F.col("item.sku")).alias("sku_is_text"),
        "title_is_text",
        _sent_as_text(F.col("item.title")).alias("variant_title_is_text"),
        "observed_at",
    )
