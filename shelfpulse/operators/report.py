"""The operating record: reliability, cost, snapshots, freshness, redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions.text import letter_label, shown_error
from shelfpulse.operators.ranking import placed
from shelfpulse.schemas import CYCLE_HOURS, UNLABELLED
from shelfpulse.session import days_before, materialize

ALL = "ALL"


def recent_runs(runs: DataFrame, as_of: object = None, days: float = 0) -> DataFrame:
    """Runs started in the last `days` before `as_of`; all of them when days <= 0."""
    if days <= 0:
        return runs
    return runs.where(F.col("started_at") >= days_before(runs, "started_at", as_of, days))


def _rate(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def _per_method(runs: DataFrame) -> DataFrame:
    """Sums per merchant and method: only numbers are kept while runs are read."""
    timed = F.nullif("duration_ms", F.lit(0))
    return runs.groupBy("merchant", "method").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("ok").alias("ok_runs"),
        F.sum("variants_seen").alias("variants"),
        F.sum(timed).alias("timed_ms"),
        F.count(timed).alias("timed_runs"),
        F.sum("bytes").alias("bytes"),
        F.sum("cost_usd").alias("cost"),
        F.max("started_at").alias("last_run"),
    )


def reliability(runs: DataFrame) -> DataFrame:
    """Per merchant: runs, successes, volumes, latency, cost; method of the latest run."""
    sums = ("runs", "ok_runs", "variants", "timed_ms", "timed_runs", "bytes", "cost")
    per_merchant = _per_method(runs).groupBy("merchant").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max_by("method", "last_run").alias("method"),
        F.max("last_run").alias("last_run"),
    )
    return per_merchant.select(
        "merchant", "method", "runs", "ok_runs",
        _rate(F.col("ok_runs"), F.col("runs")).alias("ok_rate"), "variants",
        F.round(_rate(F.col("timed_ms"), F.col("timed_runs"))).alias("avg_ms"),
        "bytes", "cost", "last_run",
    )


def reliability_with_total(runs: DataFrame) -> DataFrame:
    """Per merchant plus one grand total row, present even without any run.

    One pass over the runs: merchants and total come from the same rolled-up sums,
    to which an empty row is added so that there is always something to total.
    """
    sums = ("runs", "ok_runs", "variants", "cost")
    per_method = _per_method(runs).select("merchant", "method", "last_run", *sums)
    nothing = runs.sparkSession.range(1).select(
        *[
            F.lit(0 if f.name in sums else None).cast(f.dataType).alias(f.name)
            for f in per_method.schema
        ]
    )
    rolled = per_method.unionByName(nothing).rollup("merchant").agg(
        F.grouping("merchant").alias("total"),
        F.max_by("method", "last_run").alias("method"),
        *[F.sum(c).alias(c) for c in sums],
    )
    is_total = F.col("total") == 1
    return rolled.where(is_total | F.col("merchant").isNotNull()).select(
        F.when(is_total, ALL).otherwise(F.col("merchant")).alias("merchant"),
        F.when(~is_total, F.col("method")).alias("method"),
        *sums,
        is_total.alias("is_total"),
        F.coalesce(_rate(F.col("ok_runs"), F.col("runs")), F.lit(0.0)).alias("ok_rate"),
    )


def cost_per_parse(runs: DataFrame) -> DataFrame:
    """Cost per parsed variant of each paid merchant, and over all merchants."""
    rows = reliability_with_total(runs).where((F.col("cost") > 0) | F.col("is_total"))
    return rows.select(
        "merchant", "is_total", "cost", "variants",
        _rate(F.col("cost"), F.col("variants")).alias("cost_per_parse"),
    )


def snapshot_counts(observations: DataFrame) -> DataFrame:
    """Distinct reading moments per merchant, and whether changes can be detected yet."""
    return (
        observations.groupBy("merchant")
        .agg(F.count_distinct("observed_at").alias("snaps"))
        .withColumn("comparable", F.col("snaps") > 1)
    )


def failures(runs: DataFrame) -> DataFrame:
    """Failed runs as a text report shows them; the stored error is whole."""
    return runs.where("ok = 0").select("id", "merchant", "http_status", shown_error(F.col("error")).alias("error"))


def freshness(runs: DataFrame) -> DataFrame:
    """Start of the last successful run: never the time of publishing, null if none."""
    return runs.agg(F.max(F.when(F.col("ok") == 1, F.col("started_at"))).alias("collected_at"))


def cycle_summary(runs: DataFrame, hours: int = CYCLE_HOURS) -> DataFrame:
    """Succeeded and attempted merchants per collection cycle, told by its start in UTC.

    A merchant tried more than once in a cycle counts once.
    """
    width = hours * 3_600
    start = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("started_at").cast("timestamp")) / width) * width)
    merchant = F.when(F.col("ok") == 1, F.col("merchant"))
    return (
        runs.groupBy(start.cast(runs.schema["started_at"].dataType).alias("cycle"))
        .agg(F.count_distinct(merchant).alias("succeeded"), F.count_distinct("merchant").alias("attempted"))
        .withColumn("all_failed", F.col("succeeded") == 0)
    )


def merchant_labels(merchants: DataFrame) -> DataFrame:
    """Share-safe names in alphabetical order of the merchants' own.

    The distinct merchants are numbered range by range, and written out, so that joins know their size:
    a small list is broadcast, else AQE splits a merchant holding most rows.
    """
    numbered = placed(merchants.select("merchant").distinct(), F.asc_nulls_last("merchant"))
    return materialize(numbered.select("merchant", letter_label(F.col("place").cast("int")).alias("label")), "labels")


def redact(df: DataFrame, labels: DataFrame, column: str = "merchant") -> DataFrame:
    """Replace merchant names; only the row of a total keeps its own, and no name is left for want of a label."""
    names = labels.select(F.col("merchant").alias(column), "label")
    shown = F.coalesce("label", F.lit(UNLABELLED))
    if "is_total" in df.columns:
        shown = F.when(F.col("is_total"), F.col(column)).otherwise(shown)
    return df.join(names, column, "left").withColumn(column, shown).select(*df.columns)
