"""The current catalogue: latest reading per variant, folded into products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.functions.money import price_text, typed_price, zero_to_null
from shelfpulse.functions.text import empty_to_null
from shelfpulse.operators.skew import MAX_ROWS, latest_rows, sliced
from shelfpulse.schemas import SERIES_KEY
from shelfpulse.session import materialize

PRODUCT_KEY = ("merchant", "product_ext_id")
# Variants in one nested product row; a larger product continues in further parts.
MAX_VARIANTS_PER_DOCUMENT = 50_000


def latest_readings(observations: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The newest reading of every variant ever seen; equal moments are all kept."""
    return latest_rows(observations, SERIES_KEY, "observed_at", "id", max_rows)


def _position() -> list[Column]:
    """Catalogue order inside a product; ids settle what the titles leave open."""
    return [F.col(c) for c in ("title", "variant_title", "variant_ext_id", "id")]


def products(latest: DataFrame) -> DataFrame:
    """One row per product: attributes of its first variant, first image found.

    Minimum-of-struct aggregates combine in every task before the shuffle, so a
    product with very many variants stays small.
    """
    image = empty_to_null(F.col("image_url"))
    attributes = ("handle", "vendor", "product_type", "currency")
    per_product = latest.groupBy(*PRODUCT_KEY).agg(
        F.min(F.struct(*_position(), *attributes)).alias("first"),
        F.min(F.when(image.isNotNull(), F.struct(*_position(), image.alias("img")))).alias("image"),
        F.count(F.lit(1)).alias("n_variants"),
    )
    return per_product.select(
        *PRODUCT_KEY,
        F.col("first.handle").alias("handle"),
        F.col("first.title").alias("title"),
        empty_to_null(F.col("first.vendor")).alias("vendor"),
        empty_to_null(F.col("first.product_type")).alias("product_type"),
        F.col("image.img").alias("img"),
        F.col("first.currency").alias("currency"),
        "n_variants",
    )


def folded(observations: DataFrame, within: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Latest readings and their products, both written to the shared folder.

    The catalogue's parts share them, so neither is computed more than once.
    """
    latest = materialize(latest_readings(observations), "latest", within)
    return latest, materialize(products(latest), "products", within)


def _variant_rows(latest: DataFrame) -> DataFrame:
    raw, was = F.col("price_raw"), F.col("compare_at_raw")
    return latest.select(
        *PRODUCT_KEY, "variant_ext_id", "id", "title", "variant_title",
        empty_to_null(F.col("sku")).alias("sku"),
        typed_price(raw).alias("price"),
        price_text(raw).alias("price_text"),
        zero_to_null(typed_price(was)).alias("was"),
        empty_to_null(price_text(was)).alias("was_text"),
        F.col("available").cast("int").alias("avail"),
        empty_to_null(F.col("image_url")).alias("own_img"),
    )


def _own_image() -> Column:
    """A variant carries its image only where it differs from the product's."""
    return F.when(F.col("own_img") != F.col("product_img"), F.col("own_img"))


def variants(latest: DataFrame, product_rows: DataFrame) -> DataFrame:
    """Flat catalogue, one row per variant.

    Pass both inputs written out (`folded`): a small product table is then broadcast
    by its known size, and for a large one both sides shuffle straight into the
    join, where AQE splits a product holding most variants.
    """
    images = product_rows.select(*PRODUCT_KEY, F.col("img").alias("product_img"))
    return (
        _variant_rows(latest).join(images, list(PRODUCT_KEY))
        .withColumn("img", _own_image())
        .drop("own_img", "product_img")
    )


def documents(
    latest: DataFrame, product_rows: DataFrame, max_variants: int = MAX_VARIANTS_PER_DOCUMENT
) -> DataFrame:
    """Nested catalogue: a product with its sorted variants, in short publishing keys.

    A product above `max_variants` becomes several rows numbered by `part`, so no
    row or task has to hold an unbounded product; usual products have one part. Parts are cut
    at quantiles of the catalogue's order, so they follow each other in it.
    """
    order = ("title", "variant_title", "variant_ext_id", "id")
    variant_rows = _variant_rows(latest)
    zero = F.lit(0).cast("bigint")
    cut = sliced(variant_rows, PRODUCT_KEY, order, max_variants)
    if cut is not None:
        in_product = Window.partitionBy(*PRODUCT_KEY).orderBy("slice")
        numbers = materialize(cut.where("slice IS NOT NULL").select(*PRODUCT_KEY, "slice").distinct().withColumn(
            "part", F.row_number().over(in_product).cast("bigint") - 1), "parts")
        variant_rows = cut.join(numbers, [*PRODUCT_KEY, "slice"], "left").withColumn("part", F.coalesce("part", zero)).drop("slice")
        product_rows = product_rows.join(numbers.drop("slice"), list(PRODUCT_KEY), "left").withColumn(
            "part", F.coalesce("part", zero))
    else:
        variant_rows, product_rows = variant_rows.withColumn("part", zero), product_rows.withColumn("part", zero)

    key = [*PRODUCT_KEY, "part"]
    head = product_rows.select(
        *key, "handle", F.col("title").alias("product_title"), "vendor", "product_type",
        "currency", F.col("img").alias("product_img"),
    )
    entry = F.struct(
        "title", "variant_title", F.col("variant_ext_id").alias("v"), "id",
        F.col("variant_title").alias("vt"), "sku", "price", "price_text", "was", "was_text",
        "avail", _own_image().alias("img"),
    )
    shown = ("v", "vt", "sku", "price", "price_text", "was", "was_text", "avail", "img")
    attributes = [c for c in head.columns if c not in key]
    nested = (
        variant_rows.join(head, key)
        .groupBy(*key)
        .agg(*[F.first(c).alias(c) for c in attributes], F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    return nested.select(
        F.col("merchant").alias("m"), F.col("product_ext_id").alias("p"), "part",
        F.col("handle").alias("h"), F.col("product_title").alias("t"), "vendor",
        F.col("product_type").alias("type"), F.col("product_img").alias("img"),
        F.col("currency").alias("cur"),
        F.transform("entries", lambda e: F.struct(*[e[n].alias(n) for n in shown])).alias("variants"),
    )


def totals(latest: DataFrame) -> DataFrame:
    """Catalogue size, counted in one pass: products first, then their sums."""
    per_product = latest.groupBy(*PRODUCT_KEY).agg(
        F.count(F.lit(1)).alias("variants"),
        F.count_if("available").alias("in_stock"),
        F.count_if(F.col("available").isNull()).alias("unknown_stock"),
        F.max(empty_to_null(F.col("image_url")).isNotNull()).alias("has_image"),
    )
    sum_of = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return per_product.agg(
        F.count(F.lit(1)).alias("products"),
        sum_of("variants"), sum_of("in_stock"), sum_of("unknown_stock"),
        F.count_if("has_image").alias("with_image"),
    )
