"""Landed pages without their copies.

A collector that repeats itself lands a page again, in the same batch or a later one. Copies are told by run, merchant
and page within a watermark on the time of fetching: states of older pages are dropped, so they stay few however long
the stream runs. A page that lands behind the watermark is late and not let through, copy or not; `late_pages` lists those that
never were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfpulse.operators.ingest import RUN_KEY
from shelfpulse.schemas import PAGES

PAGE_KEY = (*RUN_KEY, "page")


def start_deduplicated(spark: SparkSession, landing: str, folder: str, checkpoint: str, delay: str) -> StreamingQuery:
    """Let each page landed since the last call through once, then stop; `delay` is how late a page may be."""
    landed = spark.readStream.schema(PAGES).parquet(landing)
    once = landed.withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(list(PAGE_KEY))
    return (
        once.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def late_pages(spark: SparkSession, landing: str, folder: str) -> DataFrame:
    """Keys of landed pages of which no copy came through."""
    passed = spark.read.schema(PAGES).parquet(folder).select(*PAGE_KEY)
    return spark.read.schema(PAGES).parquet(landing).select(*PAGE_KEY).distinct().join(passed, list(PAGE_KEY), "left_anti")
