"""Edge values of the column functions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfpulse.functions import money, text
from shelfpulse.operators import quality

PRICE = {
    None: ("missing", "ok"), "": ("missing", "ok"), " ": ("missing", "ok"),
    "\u00a0": ("missing", "ok"), "\ufeff": ("missing", "ok"), "\u3000\t\n\u2028": ("missing", "ok"),
    "229.99": ("ok", "ok"), "$1,299.00": ("ok", "ok"), ".5": ("ok", "ok"), "5.": ("ok", "ok"),
    "1e3": ("ok", "ok"), "007": ("ok", "ok"), " 12 ": ("ok", "ok"),
    "0": ("invalid", "ok"), "0.00": ("invalid", "ok"), "-0": ("invalid", "ok"), "abc": ("invalid", "ok"),
    "NaN": ("invalid", "ok"), "\u0085": ("invalid", "ok"),
    "-5": ("invalid", "invalid"), "1-2": ("invalid", "invalid"), "1e-3": ("invalid", "invalid"),
    ".": ("invalid", "invalid"), "--5": ("invalid", "invalid"), "-": ("invalid", "invalid"),
    "1.2.3": ("invalid", "invalid"), "9" * 400: ("invalid", "invalid"),
}


def graded(spark, **columns):
    names = ["price_raw", "compare_at_raw", "available", "sku", "title", "variant_title"]
    rows = list(zip(*[columns.get(n, [None] * len(next(iter(columns.values())))) for n in names]))
    schema = ", ".join(f"{n} {'boolean' if n == 'available' else 'string'}" for n in names)
    return quality.grade(spark.createDataFrame(rows, schema)).collect()


def test_money(spark):
    values = list(PRICE)
    for value, row in zip(values, graded(spark, price_raw=values, compare_at_raw=values)):
        assert (row.price_status, row.compare_at_price_status) == PRICE[value], repr(value)


def test_money_on_random_text(spark):
    rng = random.Random(11)
    alphabet = "0123456789..--+eE$, ab\u00a0\n"
    values = ["".join(rng.choices(alphabet, k=rng.randrange(7))) for _ in range(3000)]
    blanks = " \t\n\u000b\f\r\u00a0"

    def grade(raw, zero_is_valid):
        if raw.strip(blanks) == "":
            return "missing"
        rest = re.sub(r"[^0-9.\-]", "", raw)
        try:
            amount = float(rest) if rest else 0.0
        except ValueError:
            return "invalid"
        return "ok" if amount > 0 or (amount == 0 and zero_is_valid) else "invalid"

    def typed(raw):
        number = r"[ \t\n\x0b\f\r]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\x0b\f\r]*"
        return float(raw) if re.fullmatch(number, raw) else None

    df = spark.createDataFrame(list(enumerate(values)), "id int, price_raw string").withColumns(
        {"compare_at_raw": F.col("price_raw"), "available": F.lit(None).cast("boolean"), "sku": F.lit("a"),
         "title": F.lit("a"), "variant_title": F.lit("a"), "number": money.typed_price(F.col("price_raw"))}
    )
    for row in quality.grade(df).collect():
        raw = values[row.id]
        assert row.price_status == grade(raw, False), repr(raw)
        compare_at = grade(raw, True)
        assert row.compare_at_price_status == ("ok" if compare_at == "missing" else compare_at), repr(raw)
        assert row.number == typed(raw), repr(raw)


def test_flag_and_text(spark):
    rows = graded(
        spark,
        available=[None, True, False, None, None, None],
        sku=[None, "", "  ", "a", "\u00a0", "\u0085"],
        title=["x", "ab", "\U0001f600", " x ", None, "\u00e9"],
        variant_title=["a", None, "", "b", "\ufeff", "c"],
    )
    assert [r.available_status for r in rows] == ["missing", "ok", "ok", "missing", "missing", "missing"]
    assert [r.sku_status for r in rows] == ["missing", "missing", "missing", "ok", "missing", "ok"]
    assert [r.title_status for r in rows] == ["invalid", "ok", "ok", "invalid", "missing", "invalid"]
    assert [r.variant_title_status for r in rows] == ["ok", "missing", "missing", "ok", "missing", "ok"]


TYPED = {
    "229.99": 229.99, " 12 ": 12.0, "1e3": 1000.0, "5.": 5.0, ".5": 0.5, "+5": 5.0, "-5": -5.0,
    "$5.00": None, "1,299.00": None, "": None, "0x10": None, "NaN": None, "Infinity": None,
    "1d": None, "1f": None, "1 2": None, "5\n": 5.0, "\u00a05": None, "5\u0085": None,
}


def test_typed_price_and_text(spark):
    df = spark.createDataFrame([(v,) for v in TYPED] + [(None,)], "raw string")
    raw = F.col("raw")
    rows = df.select("raw", money.typed_price(raw).alias("n"), money.price_text(raw).alias("t")).collect()
    for row in rows[:-1]:
        assert row.n == TYPED[row.raw], repr(row.raw)
        assert row.t == (row.raw if row.n is None else None)
    assert (rows[-1].n, rows[-1].t) == (None, None)


def test_sort_amount(spark):
    cases = {"1-2": 1.0, "abc": 0.0, "": 0.0, "$5": 0.0, "12abc": 12.0, " 3x": 3.0, "-4z": -4.0}
    df = spark.createDataFrame([(v,) for v in cases], "t string")
    rows = df.select("t", money.sort_amount(F.lit(None).cast("double"), F.col("t")).alias("n")).collect()
    assert {r.t: r.n for r in rows} == cases


@pytest.mark.parametrize(
    ("url", "kept"), [("u?v=1", "u"), ("", None), ("?v", ""), ("a?b?c", "a"), ("plain", "plain"), (None, None)]
)
def test_without_query(spark, url, kept):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(text.without_query(F.col("u"))).first()[0] == kept


def test_names_and_labels(spark):
    rows = [("T", None), ("T", ""), ("T", "Default Title"), ("T", "Red"), ("x" * 50, "Red")]
    df = spark.createDataFrame(rows, "t string, v string")
    shown = [r[0] for r in df.select(text.display_name(F.col("t"), F.col("v"))).collect()]
    assert shown == ["T", "T", "T", "T (Red)", "x" * 44]
    numbers = spark.createDataFrame([(1,), (26,), (27,)], "n int")
    assert [r[0] for r in numbers.select(text.letter_label(F.col("n"))).collect()] == [
        "merchant-A", "merchant-Z", "merchant-27",
    ]
    flags = spark.createDataFrame([(None,), (True,), (False,)], "a boolean")
    assert [r[0] for r in flags.select(text.stock_label(F.col("a"))).collect()] == ["unknown", "in", "out"]


def test_shown_error_is_cut(spark):
    row = spark.range(1).select(text.shown_error(F.repeat(F.lit("é"), F.lit(400))).alias("long"), text.shown_error(F.lit("x")).alias("short")).first()
    assert (len(row.long), row.short) == (300, "x")
