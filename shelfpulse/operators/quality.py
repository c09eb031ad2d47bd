"""Field quality: grading, tallies, re-grading history and comparing the results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.functions.grading import AMOUNTS, field_grades, with_amounts
from shelfpulse.schemas import FIELDS, STATUSES
from shelfpulse.session import days_before

OUTCOME_KEY = ("run_id", "field", "status")


def grade(readings: DataFrame) -> DataFrame:
    """Add `<field>_status` for each graded field."""
    statuses = {f"{f}_status": status for f, status in field_grades(readings).items()}
    return with_amounts(readings).withColumns(statuses).drop(*AMOUNTS.values())


def tally(readings: DataFrame, by: Sequence[str] = ("run_id", "merchant")) -> DataFrame:
    """Outcome counts (run_id, merchant, field, status, count), positive ones only.

    All counters are kept side by side in one partially aggregated row per run
    and unfolded afterwards, so readings are never multiplied by field.
    """
    grades = field_grades(readings)
    cells = [(f, s, f"{f}:{s}") for f in FIELDS for s in STATUSES]
    counters = [F.expr(f"count_if({f}_status = '{s}') AS `{cell}`") for f, s, cell in cells]
    unfolded = ", ".join(f"'{f}', '{s}', `{cell}`" for f, s, cell in cells)
    return (
        with_amounts(readings)
        .select(*by, *[grades[f].alias(f"{f}_status") for f in FIELDS])
        .groupBy(*by)
        .agg(*counters)
        .selectExpr(*by, f"stack({len(cells)}, {unfolded}) AS (field, status, count)")
        .where("count > 0")
    )


def _status_sums() -> list[Column]:
    return [
        F.sum(F.when(F.col("status") == s, F.col("count")).otherwise(0)).alias(s)
        for s in STATUSES
    ]


def summarise(outcomes: DataFrame, *by: str) -> DataFrame:
    """ok / missing / invalid, total and ok rate per `by` and field; rate null without rows."""
    total = F.col("ok") + F.col("missing") + F.col("invalid")
    return (
        outcomes.groupBy(*by, "field")
        .agg(*_status_sums())
        .withColumn("total", total)
        .withColumn("rate", F.col("ok") / F.nullif("total", F.lit(0)))
    )


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Per run: every field that was graded at all."""
    return summarise(outcomes, "run_id", "merchant").where("total > 0")


def run_summary_in_order(outcomes: DataFrame) -> DataFrame:
    """The same with each field's `place` in its run, the least reliable first."""
    in_run = Window.partitionBy("run_id", "merchant").orderBy(*least_reliable_first())
    return run_summary(outcomes).withColumn("place", F.row_number().over(in_run))


def field_quality(outcomes: DataFrame) -> DataFrame:
    """Whole history per merchant and field."""
    return summarise(outcomes, "merchant")


def field_quality_window(
    outcomes: DataFrame, runs: DataFrame, as_of: object, days: float
) -> DataFrame:
    """The same over runs started in the last `days`; no window when days <= 0."""
    recent = runs.select(F.col("id").alias("run_id"), "started_at")
    if days > 0:
        recent = recent.where(F.col("started_at") >= days_before(runs, "started_at", as_of, days))
    return summarise(outcomes.join(recent.select("run_id"), "run_id"), "merchant").where("total > 0")


def least_reliable_first() -> list[Column]:
    return [F.asc("rate"), F.asc("field")]


def worst_field(quality: DataFrame, *by: str) -> DataFrame:
    """The least reliable field per group, named only if it is not fully reliable."""
    by = by or ("merchant",)
    worst = quality.where("total > 0").groupBy(*by).agg(F.min(F.struct("rate", "field")).alias("worst"))
    flawed = F.col("worst.rate") < 1
    return worst.select(
        *by,
        F.when(flawed, F.col("worst.field")).alias("least_reliable"),
        F.col("worst.rate").alias("rate"),
        (~flawed).alias("all_complete"),
    )


def not_ok(outcomes: DataFrame) -> DataFrame:
    return (
        outcomes.where(F.col("status") != "ok").groupBy("field").agg(F.sum("count").alias("n"))
    )


def in_order(per_field: DataFrame, *order: Column) -> DataFrame:
    """A table of one row per field with each row's `place` in the order it is shown in."""
    return per_field.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def regraded_tally(observations: DataFrame, runs: DataFrame) -> DataFrame:
    """Fresh outcomes of every successful run that still has readings.

    Readings are counted per run before the join, so runs meet counts, not readings.
    """
    good = runs.where("ok = 1").select(F.col("id").alias("run_id"), "merchant")
    return tally(observations, ["run_id"]).join(good, "run_id").select(
        "run_id", "merchant", "field", "status", "count"
    )


def regrade(outcomes: DataFrame, observations: DataFrame, runs: DataFrame) -> DataFrame:
    """Outcomes with the re-graded runs replaced and all others as they were."""
    fresh = regraded_tally(observations, runs)
    replaced = fresh.select("run_id").distinct()
    kept = outcomes.join(replaced, "run_id", "left_anti")
    columns = ["run_id", "merchant", "field", "status", "count"]
    return kept.select(*columns).unionByName(fresh.select(*columns))


def regraded_runs(observations: DataFrame, runs: DataFrame) -> DataFrame:
    """How many runs a re-grade replaces."""
    with_readings = observations.select(F.col("run_id").alias("id")).distinct()
    return runs.where("ok = 1").join(with_readings, "id", "left_semi").agg(
        F.count(F.lit(1)).alias("regraded")
    )


def grade_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Not-ok counts before and after, for the fields of either side."""
    old = not_ok(before).withColumnRenamed("n", "not_ok_before")
    new = not_ok(after).withColumnRenamed("n", "not_ok_after")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (
        old.join(new, "field", "full_outer")
        .select("field", zero("not_ok_before"), zero("not_ok_after"))
        .withColumn("delta", F.col("not_ok_after") - F.col("not_ok_before"))
    )
