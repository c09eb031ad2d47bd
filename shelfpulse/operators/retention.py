"""Bounding the readings; runs and outcomes are never pruned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.schemas import OBSERVED_DAY, RETENTION_DAYS
from shelfpulse.session import days_before, utc_day


def cutoff(observations: DataFrame, as_of: object, days: float = RETENTION_DAYS) -> Column:
    return days_before(observations, "observed_at", as_of, days)


def plan(observations: DataFrame, as_of: object, days: float = RETENTION_DAYS) -> DataFrame:
    """What a prune would do, in one pass: total, doomed, kept."""
    doomed = F.count_if(F.col("observed_at") < cutoff(observations, as_of, days))
    return observations.agg(
        F.count(F.lit(1)).alias("total"), doomed.alias("doomed")
    ).withColumn("kept", F.col("total") - F.col("doomed"))


def keep(observations: DataFrame, as_of: object, days: float = RETENTION_DAYS) -> DataFrame:
    """Readings at or after the cutoff; of stored ones only the days that can hold any are read."""
    since = cutoff(observations, as_of, days)
    kept = observations.where(F.col("observed_at") >= since)
    return kept.where(F.col(OBSERVED_DAY) >= utc_day(since)) if OBSERVED_DAY in observations.columns else kept
