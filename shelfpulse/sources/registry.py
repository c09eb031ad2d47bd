"""The merchant registry: a hand-kept JSON list of flat objects, or a folder of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.schemas import REGISTRY


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The merchants at `path`: JSON lines, or documents of their own per file where a line begins a list."""
    line = F.trim(F.regexp_replace("value", r"[\s\uFEFF]", " "))
    whole = spark.read.text(path).where(line.startswith("[") | (line == "{"))
    return spark.read.schema(REGISTRY).option("multiLine", not whole.isEmpty()).json(path)


def enabled(registry: DataFrame, only: str | None = None) -> DataFrame:
    """Merchants to collect; asking for one that is not enabled is an error."""
    chosen = registry.where("enabled")
    if only is not None:
        chosen = chosen.where(F.col("slug") == only)
    if chosen.isEmpty():
        raise ValueError(f'no enabled merchant matching "{only}"' if only else "no enabled merchants")
    return chosen


def published(registry: DataFrame) -> DataFrame:
    return registry.select(
        "slug", "name", "base_url", "currency", "method", "enabled", "method_rationale"
    )
