"""Price moves and stock flips: full history, latest against previous, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.functions.money import price_text, sort_amount, typed_price
from shelfpulse.functions.text import display_name, stock_label
from shelfpulse.operators.skew import MAX_ROWS, with_previous
from shelfpulse.schemas import (
    CHANGE_KEY, NEWEST_CHANGES, PRICE_KIND, SERIES_KEY, STOCK_KIND, TOP_CHANGES,
)

# A price reading is its number, or its text when it is no number; either may be
# compared. It is unknown only when the feed sent nothing.
PRICE = ("price", "price_text")


def price_readings(observations: DataFrame) -> DataFrame:
    """The columns change detection needs, with the price split into number and text."""
    return observations.select(
        "id", *SERIES_KEY, "title", "variant_title", "observed_at", "available",
        typed_price(F.col("price_raw")).alias("price"),
        price_text(F.col("price_raw")).alias("price_text"),
    )


def _known(prefix: str) -> Column:
    return F.col(f"{prefix}price").isNotNull() | F.col(f"{prefix}price_text").isNotNull()


def _same(left: str, right: str, names: tuple[str, ...]) -> Column:
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"{left}{name}").eqNullSafe(F.col(f"{right}{name}"))
    return same


def with_previous_reading(observations: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    return with_previous(
        price_readings(observations), SERIES_KEY, "observed_at", "id",
        [*PRICE, "available"], max_rows,
    )


def differs() -> Column:
    """Whether a reading differs from its predecessor, whose price was known."""
    return _known("prev_") & (~_same("", "prev_", PRICE) | ~_same("", "prev_", ("available",)))


def change_events(readings: DataFrame) -> DataFrame:
    """Zero to two events per reading: a price move, then a stock flip.

    `readings` carry their predecessor in `prev_*`. A reading whose predecessor
    had no price never counts, not even for its stock.
    """
    price_moved = ~_same("", "prev_", PRICE)
    stock_flipped = ~_same("", "prev_", ("available",))
    flag = lambda name: F.col(name).cast("int").cast("double")
    no_text = F.lit(None).cast("string")

    def event(happened: Column, kind: str, *values: Column) -> Column:
        names = ("from_value", "to_value", "from_text", "to_text")
        fields = [v.alias(n) for v, n in zip(values, names)]
        return F.when(happened, F.struct(F.lit(kind).alias("kind"), *fields))

    moves = event(
        price_moved, PRICE_KIND,
        F.col("prev_price"), F.col("price"), F.col("prev_price_text"), F.col("price_text"),
    )
    flips = event(
        stock_flipped, STOCK_KIND, flag("prev_available"), flag("available"), no_text, no_text
    )
    return (
        readings.where(differs())
        .select(
            F.col("observed_at").alias("at"), *SERIES_KEY, "title", "variant_title", "id",
            F.explode(F.array_compact(F.array(moves, flips))).alias("event"),
        )
        .select("at", *SERIES_KEY, "title", "variant_title", "event.*", "id")
    )


def history(observations: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Every change between consecutive readings of a variant."""
    return change_events(with_previous_reading(observations, max_rows))


def newest_first() -> list[Column]:
    """The total order changes are kept in."""
    return [F.desc("at"), *[F.asc(c) for c in CHANGE_KEY if c != "at"]]


def _merged(published: DataFrame, fresh: DataFrame) -> DataFrame:
    values = [c for c in fresh.columns if c not in (*CHANGE_KEY, "id")]

    def entries(df: DataFrame, is_fresh: bool, order: Column) -> DataFrame:
        entry = F.struct(F.lit(is_fresh).alias("is_fresh"), order.alias("order"), *values)
        return df.select(*CHANGE_KEY, entry.alias("entry"))

    old = entries(published, False, F.lit(0).cast("bigint"))
    new = entries(fresh, True, F.col("id").cast("bigint"))
    return (
        old.unionByName(new)
        .groupBy(*CHANGE_KEY)
        .agg(F.max("entry").alias("entry"), F.count_if("entry.is_fresh").alias("found"))
        .select(*CHANGE_KEY, *[f"entry.{v}" for v in values], "found")
    )


def merge(published: DataFrame, fresh: DataFrame) -> DataFrame:
    """Published and fresh changes by key; fresh wins, and of equal fresh ones the last.

    One partially aggregated grouping does the union, the override and the
    duplicate removal, so repeated copies of a key shrink before the shuffle.
    """
    return _merged(published, fresh).drop("found")


def merge_counts(
    published: DataFrame, fresh: DataFrame, max_changes: int | None = None
) -> DataFrame:
    """How many changes this pass found, how many there are in all, how many are kept."""
    kept = F.col("merged") if max_changes is None else F.least("merged", F.lit(max_changes))
    return (
        _merged(published, fresh)
        .agg(
            F.coalesce(F.sum("found"), F.lit(0)).alias("fresh"),
            F.count(F.lit(1)).alias("merged"),
        )
        .withColumn("retained", kept.cast("bigint"))
    )


def newest(changes: DataFrame, rows: int = NEWEST_CHANGES) -> DataFrame:
    """The newest changes by a fixed total order: a view, never what is kept."""
    return changes.orderBy(*newest_first()).limit(rows)


def latest_diff(observations: DataFrame) -> DataFrame:
    """Each variant's latest reading against the one before, where both are known and differ.

    Two rows per variant survive in every task before the shuffle, so a variant
    with many readings costs no more than any other.
    """
    newest = Window.partitionBy(*SERIES_KEY).orderBy(F.desc("observed_at"), F.desc("id"))
    ranked = (
        price_readings(observations)
        .withColumn("rn", F.row_number().over(newest))
        .where("rn <= 2")
    )
    pick = lambda name, rn: F.max(F.when(F.col("rn") == rn, F.col(name)))
    paired = ranked.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("readings"),
        pick("title", 1).alias("title"),
        pick("variant_title", 1).alias("variant_title"),
        *[pick(c, 2).alias(f"prev_{c}") for c in (*PRICE, "available")],
        *[pick(c, 1).alias(f"curr_{c}") for c in (*PRICE, "available")],
    )
    price_differs = _known("prev_") & _known("curr_") & ~_same("prev_", "curr_", PRICE)
    stock_differs = F.col("prev_available") != F.col("curr_available")
    return (
        paired.where("readings = 2")
        .where(price_differs | stock_differs)
        .drop("readings")
        .withColumn("price_delta", price_delta())
    )


def price_delta() -> Column:
    amount = lambda side: sort_amount(F.col(f"{side}_price"), F.col(f"{side}_price_text"))
    return F.abs(amount("curr") - amount("prev"))


def diff_order() -> list[Column]:
    return [F.asc("merchant"), F.desc("price_delta"), F.asc("variant_ext_id")]


def price_moved() -> Column:
    return ~_same("prev_", "curr_", PRICE)


def stock_flipped() -> Column:
    return ~_same("prev_", "curr_", ("available",))


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.agg(
        F.count_if(price_moved()).alias("price_changes"),
        F.count_if(stock_flipped()).alias("stock_flips"),
    )


def diff_top(diff: DataFrame, rows: int = TOP_CHANGES) -> DataFrame:
    """The first changes of the report, as it words them."""
    shown = lambda side: F.coalesce(f"{side}_price_text", F.col(f"{side}_price").cast("string"))
    stock = lambda side: stock_label(F.col(f"{side}_available"))
    return (
        diff.orderBy(*diff_order()).limit(rows).select(
            "merchant", "variant_ext_id",
            display_name(F.col("title"), F.col("variant_title")).alias("name"),
            F.when(price_moved(), shown("prev")).alias("price_from"),
            F.when(price_moved(), shown("curr")).alias("price_to"),
            F.when(stock_flipped(), stock("prev")).alias("stock_from"),
            F.when(stock_flipped(), stock("curr")).alias("stock_to"),
        )
    )


def diff_remainder(diff: DataFrame, rows: int = TOP_CHANGES) -> DataFrame:
    return diff.agg(F.greatest(F.count(F.lit(1)) - rows, F.lit(0)).cast("bigint").alias("more"))
