"""Figures that grow with each batch instead of being counted again.

Bitmaps of run numbers per merchant and day answer how many snapshots any window holds: they merge by OR, so the
answer is exact however batches and days overlap. Sums of outcomes per merchant, field and status are kept as signed
differences: a batch adds its own, a re-grade adds new less old, and a deletion of readings adds nothing, since
outcomes outlive them. Every step writes under its own name, so a repeated step replaces itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.operators import quality
from shelfpulse.schemas import OBSERVED_DAY
from shelfpulse.session import utc_day

STEP = "step"
CELL = ("merchant", "field", "status")


def _write(df: DataFrame, path: str, step: str) -> None:
    df.withColumn(STEP, F.lit(step)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(STEP).parquet(path)


def snapshot_bitmaps(observations: DataFrame) -> DataFrame:
    """Which runs a merchant's readings of a day come from: a bitmap for each 32,768 run numbers that has any.

    All readings of a run share one moment, so its number stands for a snapshot."""
    return observations.groupBy(
        "merchant", utc_day(F.col("observed_at")).alias(OBSERVED_DAY), F.bitmap_bucket_number("run_id").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("run_id")).alias("runs"))


def record_snapshots(observations: DataFrame, path: str, step: str) -> None:
    _write(snapshot_bitmaps(observations), path, step)


def snapshot_counts(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """Distinct snapshots per merchant, from the first whole UTC day at or after `since` on; no reading is read."""
    kept = spark.read.parquet(path)
    if since is not None:
        kept = kept.where(F.col(OBSERVED_DAY) >= since)
    merged = kept.groupBy("merchant", "bucket").agg(F.bitmap_or_agg("runs").alias("runs"))
    counted = merged.groupBy("merchant").agg(F.sum(F.bitmap_count("runs")).alias("snaps"))
    return counted.withColumn("comparable", F.col("snaps") > 1)


def outcome_difference(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """(merchant, field, status, count): what `after` adds to the sums that `before` is part of."""
    rows = after.select(*CELL, "count")
    if before is not None:
        rows = rows.unionByName(before.select(*CELL, (-F.col("count")).alias("count")))
    return rows.groupBy(*CELL).agg(F.sum("count").alias("count")).where("count <> 0")


def record_outcomes(after: DataFrame, path: str, step: str, before: DataFrame | None = None) -> None:
    """Add a batch's outcomes, or with `before` put them in the place of those."""
    _write(outcome_difference(before, after), path, step)


def field_quality(spark: SparkSession, path: str) -> DataFrame:
    """Whole-history field quality from the sums alone."""
    sums = spark.read.parquet(path).groupBy(*CELL).agg(F.sum("count").alias("count")).where("count <> 0")
    return quality.field_quality(sums)
