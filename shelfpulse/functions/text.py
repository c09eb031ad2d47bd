"""Text rules shared by grading, the catalogue and the report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfpulse.schemas import ERROR_LENGTH, NAME_WIDTH

# The characters that count as white space when text is trimmed.
WHITESPACE = (
    "\t\n\u000b\f\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
# Fixed value: the variant title that means "this product has no variants".
DEFAULT_VARIANT = "Default Title"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return text.isNull() | (trimmed(text) == "")


def has_length(text: Column, least: int) -> Column:
    """At least `least` UTF-16 units; characters outside the BMP count twice."""
    units = F.octet_length(F.encode(text, "UTF-16BE")) / 2
    return (F.char_length(text) >= least) | (units >= least)


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def without_query(url: Column) -> Column:
    """The address up to its first question mark; an empty address is no address."""
    return F.substring_index(empty_to_null(url), "?", 1)


def image_of(variant_image: Column, product_image: Column) -> Column:
    return F.coalesce(without_query(variant_image), without_query(product_image))


def display_name(title: Column, variant_title: Column, width: int = NAME_WIDTH) -> Column:
    plain = variant_title.isNull() | variant_title.isin("", DEFAULT_VARIANT)
    shown = F.coalesce(title, F.lit("null"))
    named = F.when(plain, shown).otherwise(F.concat(shown, F.lit(" ("), variant_title, F.lit(")")))
    return F.left(named, F.lit(width))


def shown_error(error: Column, width: int = ERROR_LENGTH) -> Column:
    return F.left(error, F.lit(width))


def stock_label(available: Column) -> Column:
    return (
        F.when(available.isNull(), "unknown").when(available, "in").otherwise("out")
    )


def percent_text(rate: Column) -> Column:
    return F.format_string("%.1f%%", rate * 100)


def letter_label(position: Column) -> Column:
    """merchant-A, merchant-B, … then merchant-27 onwards."""
    letter = F.char((position + 64).cast("int"))
    return F.concat(F.lit("merchant-"), F.when(position <= 26, letter).otherwise(position.cast("string")))
