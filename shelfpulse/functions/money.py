"""Prices: kept as the feed sent them, plus a typed reading of the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpulse.functions.text import trimmed

# Fixed patterns: what a numeric column accepts as a number, the number that text
# starts with in arithmetic, and what money cleaning removes.
NUMBER = r"\A[ \t\n\x0B\f\r]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\x0B\f\r]*\z"
LEADING_NUMBER = r"\A[ \t\n\x0B\f\r]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
NOT_MONEY = r"[^0-9.\-]"


def typed_price(raw: Column) -> Column:
    """The number a price text stands for, null when it is not purely a number."""
    return F.when(raw.rlike(NUMBER), trimmed(raw).try_cast("double"))


def price_text(raw: Column) -> Column:
    """The text of a price that is no number: still a reading, still comparable."""
    return F.when(~raw.rlike(NUMBER), raw)


def sort_amount(price: Column, text: Column) -> Column:
    """A price in arithmetic: typed value, else the text's leading number, else 0."""
    leading = F.regexp_extract(text, LEADING_NUMBER, 1).try_cast("double")
    return F.coalesce(price, leading, F.lit(0.0))


def cleaned(raw: Column) -> Column:
    """A money text without anything but digits, dot and minus."""
    return F.regexp_replace(raw, NOT_MONEY, "")


def cleaned_amount(text: Column) -> Column:
    """The amount in a cleaned text: nothing left means 0, a malformed rest means null."""
    return F.when(text == "", F.lit(0.0)).otherwise(text.try_cast("double"))


def zero_to_null(amount: Column) -> Column:
    return F.nullif(amount, F.lit(0.0))
