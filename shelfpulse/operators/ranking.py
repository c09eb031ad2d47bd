"""Numbering rows in a total order without one task that sees them all.

Rows are dealt by ranges of the order and sorted inside each; a row's place is the number of rows in
the ranges before its own, which one count per range tells, and its place in its range.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.session import materialize

_ROW_BITS = (1 << 33) - 1


def in_ranges(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """`row` (all columns), its `range` and its number `within` it, by the order."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.spark_partition_id().alias("range"),
        F.monotonically_increasing_id().bitwiseAND(_ROW_BITS).alias("within"),
    )


def placed(df: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """`df` with each row's place, from 1. Only the sizes of the ranges, one number for each task, reach the driver."""
    spark = df.sparkSession
    rows = materialize(in_ranges(df, order), "ranges")
    sizes = sorted(tuple(row) for row in rows.groupBy("range").count().collect())
    before = accumulate((count for _, count in sizes), initial=0)
    starts = spark.createDataFrame([(number, start) for (number, _), start in zip(sizes, before)], "range int, start bigint")
    return rows.join(F.broadcast(starts), "range").select("row.*", (F.col("start") + F.col("within") + 1).alias(name))
