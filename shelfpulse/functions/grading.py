"""ok / missing / invalid for each field of a reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions.money import cleaned, cleaned_amount
from shelfpulse.functions.text import has_length, is_blank, trimmed

# Helper columns holding the amount of each price text while grading.
AMOUNTS = {"price_raw": "price_amount", "compare_at_raw": "compare_at_amount"}


def with_amounts(readings: DataFrame) -> DataFrame:
    """Add the cleaned amounts the money grades look at.

    Two steps, so that each text is cleaned and parsed once however often it is used.
    """
    return readings.withColumns(
        {amount: cleaned(F.col(raw)) for raw, amount in AMOUNTS.items()}
    ).withColumns({amount: cleaned_amount(F.col(amount)) for amount in AMOUNTS.values()})


def _in_range(amount: Column, zero_is_valid: bool) -> Column:
    above = amount >= 0 if zero_is_valid else amount > 0
    return F.coalesce(above & (amount < float("inf")), F.lit(False))


def grade_price(raw: Column, amount: Column) -> Column:
    usable = _in_range(amount, zero_is_valid=False)
    return F.when(is_blank(raw), "missing").when(usable, "ok").otherwise("invalid")


def grade_compare_at(raw: Column, amount: Column) -> Column:
    """No former price means "not reduced": blank and zero are both fine."""
    usable = _in_range(amount, zero_is_valid=True)
    return F.when(is_blank(raw) | usable, "ok").otherwise("invalid")


def grade_flag(flag: Column) -> Column:
    return F.when(flag.isNull(), "missing").otherwise("ok")


def grade_text(text: Column, least: int = 1, is_text: Column | None = None) -> Column:
    """`is_text` says whether the feed sent a string; a number or object is invalid."""
    enough = F.lit(True) if least <= 1 else has_length(trimmed(text), least)
    if is_text is None:
        return F.when(is_blank(text), "missing").when(enough, "ok").otherwise("invalid")
    not_text = F.coalesce(~is_text, F.lit(False))
    return (
        F.when(text.isNull(), "missing")
        .when(not_text, "invalid")
        .when(is_blank(text), "missing")
        .when(enough, "ok")
        .otherwise("invalid")
    )


def field_grades(readings: DataFrame) -> dict[str, Column]:
    """One status expression per graded field of readings that carry their amounts."""

    def text(name: str, least: int = 1) -> Column:
        marker = f"{name}_is_text"
        known = F.col(marker) if marker in readings.columns else None
        return grade_text(F.col(name), least, known)

    return {
        "price": grade_price(F.col("price_raw"), F.col(AMOUNTS["price_raw"])),
        "compare_at_price": grade_compare_at(
            F.col("compare_at_raw"), F.col(AMOUNTS["compare_at_raw"])
        ),
        "available": grade_flag(F.col("available")),
        "sku": text("sku"),
        "title": text("title", 2),
        "variant_title": text("variant_title"),
    }
