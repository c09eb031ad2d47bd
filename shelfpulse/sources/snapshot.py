"""Publishing: the operating record and the catalogue as JSON, and reading them back.

Each section is a folder of JSON lines, written by all tasks; nothing is folded
into one document. The record stays apart from the much larger catalogue.
Each publication is a version of its own, which counts from the moment a marker says
that it is whole; only then does the one before go. So a run that dies on the way
leaves the last publication, and with it the durable change history, as it was.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.operators import catalogue, changes, quality, report
from shelfpulse.operators.ranking import placed
from shelfpulse.schemas import CHANGES, SCHEMA_VERSION
from shelfpulse.session import delete_folder, folder_exists, mark, materialize, numbered, scratch
from shelfpulse.sources.registry import published

# Microseconds survive the round trip, so a change read back keeps its key.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timeZone": "UTC",
}
# The short names changes are published under.
CHANGE_NAMES = {
    "merchant": "m", "variant_ext_id": "v", "title": "t", "variant_title": "vt",
    "from_value": "from", "to_value": "to",
}
# The columns of a run that are published.
RUN_COLUMNS = (
    "id", "merchant", "method", "provider", "started_at", "finished_at", "ok", "http_status",
    "error", "products_seen", "variants_seen", "bytes", "duration_ms", "cost_usd",
)


def write_json(df: DataFrame, folder: str, *partition: str) -> None:
    """JSON lines with nulls kept: an unknown is not the same as nothing there."""
    writer = df.write.mode("overwrite").options(**JSON_OPTIONS).option("ignoreNullFields", False)
    (writer.partitionBy(*partition) if partition else writer).json(folder)


def write_changes(kept: DataFrame, folder: str) -> None:
    short = [F.col(c).alias(CHANGE_NAMES.get(c, c)) for c in CHANGES.names]
    write_json(kept.orderBy(*changes.newest_first()).select(*short), folder)


MARKER = "_PUBLISHED"
VERSION = "version"


def current(spark: SparkSession, folder: str) -> str | None:
    """The newest whole publication in `folder`, if there is any."""
    for version in reversed(numbered(spark, folder, VERSION)):
        path = f"{folder}/{VERSION}={version}"
        if folder_exists(spark, f"{path}/{MARKER}"):
            return path
    return None


def _change_lines(spark: SparkSession, folder: str, within: str | None) -> DataFrame | None:
    """Published changes as they were parsed, and in `_corrupt_record` the lines that were not."""
    if not folder_exists(spark, folder):
        return None
    fields = [T.StructField(CHANGE_NAMES.get(f.name, f.name), f.dataType) for f in CHANGES]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).options(**JSON_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT)
    return materialize(reader.json(folder), "published-changes", within)


CORRUPT = "_corrupt_record"


def read_published_changes(
    spark: SparkSession, folder: str, within: str | None = None
) -> DataFrame:
    """The readable changes of a publication; none if there is none. Others are counted in a warning."""
    lines = _change_lines(spark, folder, within)
    if lines is None:
        return spark.createDataFrame([], CHANGES)
    bad = lines.where(F.col(CORRUPT).isNotNull()).count()
    if bad:
        warnings.warn(f"{bad} published changes are unreadable and put aside", stacklevel=2)
    good = lines.where(F.col(CORRUPT).isNull())
    return good.select(*[F.col(CHANGE_NAMES.get(c, c)).alias(c) for c in CHANGES.names])


def _put_aside(spark: SparkSession, record: str, into: str, within: str) -> None:
    """Carry the unreadable lines of the publication `record`, old and new, into the next one."""
    lines = _change_lines(spark, f"{record}/changes", f"{within}/aside")
    bad = spark.createDataFrame([], "value string") if lines is None else lines.where(
        F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
    if folder_exists(spark, f"{record}/unreadable"):
        bad = bad.unionByName(spark.read.text(f"{record}/unreadable"))
    bad.distinct().write.mode("overwrite").text(into)


def meta(runs: DataFrame, generated_at: Column) -> DataFrame:
    return report.freshness(runs).select(
        generated_at.alias("generated_at"), "collected_at",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def publish(
    folder: str,
    registry: DataFrame,
    runs: DataFrame,
    outcomes: DataFrame,
    observations: DataFrame,
    generated_at: Column | None = None,
    fresh: DataFrame | None = None,
) -> str:
    """Write a version with `snapshot/` (meta, merchants, runs, fields, changes, totals) and `catalogue/`.

    `fresh` are changes already detected, as by the stream; without them the history
    of all given observations is worked out here. Returns the version's folder.
    """
    spark = runs.sparkSession
    last = current(spark, folder)
    versions = numbered(spark, folder, VERSION)
    target = f"{folder}/{VERSION}={max(versions, default=0) + 1}"
    stamp = F.current_timestamp() if generated_at is None else generated_at
    record, products_folder = f"{target}/snapshot", f"{target}/catalogue"
    with scratch(spark, "publish") as work:
        # Written out first: a sorted write draws its ranges from the rows before it deals them, and runs are asked for often.
        runs = materialize(runs, "runs", work)
        about = meta(runs, stamp)
        found = changes.history(observations) if fresh is None else fresh
        before = read_published_changes(spark, f"{last}/snapshot/changes", work)
        if last is not None:
            _put_aside(spark, f"{last}/snapshot", f"{record}/unreadable", work)
        merged = materialize(changes.merge(before, found), "merged", work)
        latest, product_rows = catalogue.folded(observations, work)

        write_json(about, f"{record}/meta")
        write_json(published(registry), f"{record}/merchants")
        write_json(runs.select(*RUN_COLUMNS).orderBy("started_at", "id"), f"{record}/runs")
        fields = materialize(quality.field_quality(outcomes), "fields", work)
        write_json(fields.orderBy("merchant", *quality.least_reliable_first()), f"{record}/fields")
        write_changes(merged, f"{record}/changes")
        write_json(catalogue.totals(latest), f"{record}/totals")
        write_json(about, f"{products_folder}/meta")
        documents = catalogue.documents(latest, product_rows)
        # Ranges keep a merchant's products in few files and still split a large merchant.
        write_json(documents.repartitionByRange("m", "p", "part"), f"{products_folder}/products", "m")
    mark(spark, f"{target}/{MARKER}")
    for version in versions:
        delete_folder(spark, f"{folder}/{VERSION}={version}")
    return target


def in_file_order(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of a published section with their `place`, as a reader meets them file by file and line by line."""
    rows = spark.read.schema(schema).options(**JSON_OPTIONS).json(folder).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"))
    return placed(rows, "_file", "_start", "_line").drop("_file", "_start", "_line")


def report_sections(
    runs: DataFrame, outcomes: DataFrame, observations: DataFrame, as_of: object = None, days: float = 0
) -> dict[str, DataFrame]:
    """The four machine-readable report sections."""
    recent = report.recent_runs(runs, as_of, days)
    return {
        "reliability": report.reliability(recent),
        "fields": quality.field_quality_window(outcomes, runs, as_of, days),
        "changes": changes.latest_diff(observations),
        "snapshots": report.snapshot_counts(observations),
    }


def section_order(name: str) -> list[Column]:
    """The order the report reads in; changes come largest price move first."""
    if name == "fields":
        return [F.asc("merchant"), *quality.least_reliable_first()]
    return changes.diff_order() if name == "changes" else [F.asc("merchant")]


def write_report(folder: str, sections: dict[str, DataFrame], labels: DataFrame | None = None) -> None:
    """Write each section as JSON; with `labels`, merchant names are replaced in all of them."""
    for name, section in sections.items():
        shown = section if labels is None else report.redact(section, labels)
        write_json(shown.orderBy(*section_order(name)), f"{folder}/{name}")
