"""The stored tables as partitioned Parquet.

Readings are partitioned by UTC day, so retention drops whole folders and its bound
on the day prunes the rest; outcomes are partitioned by the day of their run, so re-grading
replaces whole partitions in one committed job. Compaction and retention replace folders of
readings behind one marker, so a job that dies leaves the readings as they were or as they should be.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.functions.money import typed_price
from shelfpulse.operators import quality, retention
from shelfpulse.schemas import (
    FIELD_OUTCOMES, OBSERVATIONS, OBSERVED_DAY, PAGES, RETENTION_DAYS, SERIES_KEY,
)
from shelfpulse.session import (
    CODEC, delete_folder, folder_exists, freed_shuffles, mark, materialize, move, numbered, scratch, subfolders, utc_day,
)

RUN_DAY = "run_date"
BATCH = "batch"


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with every column of `schema`: columns older data lacks are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def typed_prices(observations: DataFrame) -> DataFrame:
    return observations.withColumns(
        {
            "price": typed_price(F.col("price_raw")),
            "compare_at_price": typed_price(F.col("compare_at_raw")),
        }
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def append_observations(observations: DataFrame, path: str, batch: str) -> None:
    """Append the readings of one batch; repeating a batch replaces it. Bloom filters tell which files hold a run.

    Ranges of day and series put each day into few files, a large day into several,
    and lay the rows of a series side by side. Ranges are drawn from the rows before these are dealt, so the rows
    are written out first and worked out once. Groups of whole days are dealt one after the other, each committed alone.
    """
    with scratch(observations.sparkSession, "append") as work:
        append_written(written_out(observations, work), path, batch)


# About so many readings are dealt at once, or those of one day, so that shuffle files do not grow with the batch.
DEALT_ROWS = 20_000_000
# What is worked out from other columns once the rows are dealt, so that it is not shuffled.
_TYPED = ("price", "compare_at_price")


def written_out(observations: DataFrame, work: str) -> DataFrame:
    """The readings of one batch in the folder `work`, as `append_written` takes them; nothing reads `observations` later."""
    as_sent = T.StructType([f for f in OBSERVATIONS if f.name not in _TYPED])
    return materialize(evolve(observations, as_sent), "readings", work)


def append_written(readings: DataFrame, path: str, batch: str) -> None:
    """Append the readings of one batch that `written_out` gave; see `append_observations`."""
    order, day = (OBSERVED_DAY, *SERIES_KEY, "observed_at"), utc_day(F.col("observed_at"))
    for within in _groups_of_days(readings.groupBy(day.alias("day")).count().sort("day").collect(), day):  # a row for each day
        dealt = readings.where(within).repartitionByRange(day, *order[1:])
        rows = evolve(typed_prices(dealt), OBSERVATIONS).withColumns({OBSERVED_DAY: day, BATCH: F.lit(batch)})
        _dynamic(rows.sortWithinPartitions(*order), path, OBSERVED_DAY, BATCH)


def _groups_of_days(counts: list, day: Column) -> list[Column]:
    """A condition for each group of neighbouring days of about `DEALT_ROWS` rows, from (day, rows) in ascending order, no
    day first."""
    lasts, rows = [], 0
    for place, (at, count) in enumerate(counts):
        rows += count
        if at is not None and rows >= DEALT_ROWS and place < len(counts) - 1:
            lasts.append(F.lit(at))
            rows = 0
    if not lasts:
        return [F.lit(True)]
    between = [(day > low) & (day <= high) for low, high in zip(lasts, lasts[1:], strict=False)]
    return [day.isNull() | (day <= lasts[0]), *between, day > lasts[-1]]


# A rewritten batch carries this in its name, and in a column the batch that each row landed in.
REWRITTEN = "rewritten-"
LANDED = "landed_in"
_STAGED, _COMMITTED = "_staged", "_committed"


def _uncounted(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(day, batch) folders that do not count: rewritten ones not committed yet, and what committed ones replace."""
    committed = subfolders(spark, f"{path}/{_COMMITTED}")
    out = [(None, name) for name in subfolders(spark, f"{path}/{_STAGED}") if name not in committed]
    for name in committed:
        out += [(row[0], row[1]) for row in spark.read.schema(_REPLACED).json(f"{path}/{_COMMITTED}/{name}/replaced").collect()]
    return out


_REPLACED = "day string, batch string"


def _replace(spark: SparkSession, path: str, kept: DataFrame | None, replaced: list[tuple[str, str]]) -> None:
    """Put the rows `kept` in the place of the (day, batch) folders `replaced`, all in one step.

    The new folders are announced as staged before they are written, so that no reader counts them. One marker,
    written whole or not at all, makes them count and the replaced ones not; those are deleted after it. Dying
    anywhere leaves the rows as before or as after that marker, and `finish` does the rest."""
    name = f"{REWRITTEN}{uuid.uuid4().hex}"
    mark(spark, f"{path}/{_STAGED}/{name}/_")
    if kept is not None:
        landed = F.coalesce(LANDED, BATCH)
        rows = kept.withColumns({LANDED: landed, BATCH: F.lit(name)})
        order = (OBSERVED_DAY, *SERIES_KEY, "observed_at")
        ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        with freed_shuffles(spark):
            ranged.write.mode("append").options(**CODEC, **BLOOM).partitionBy(OBSERVED_DAY, BATCH).parquet(path)
    draft = f"{path}/{_STAGED}/{name}/replaced"
    spark.createDataFrame(replaced, _REPLACED).coalesce(1).write.mode("overwrite").json(draft)
    move(spark, draft, f"{path}/{_COMMITTED}/{name}/replaced")
    finish(spark, path)


def finish(spark: SparkSession, path: str) -> None:
    """Delete what committed rewrites replaced and what never was committed; repeating it is harmless."""
    committed = subfolders(spark, f"{path}/{_COMMITTED}")
    for name in committed:
        for row in spark.read.schema(_REPLACED).json(f"{path}/{_COMMITTED}/{name}/replaced").collect():
            delete_folder(spark, f"{path}/{OBSERVED_DAY}={row.day}/{BATCH}={row.batch}")
        delete_folder(spark, f"{path}/{_STAGED}/{name}")
        delete_folder(spark, f"{path}/{_COMMITTED}/{name}")
    for name in subfolders(spark, f"{path}/{_STAGED}"):
        for day in subfolders(spark, path):
            if day.startswith(f"{OBSERVED_DAY}="):
                delete_folder(spark, f"{path}/{day}/{BATCH}={name}")
        delete_folder(spark, f"{path}/{_STAGED}/{name}")


def compact(spark: SparkSession, path: str, *days: object) -> None:
    """Rewrite the batches of each day into one, in few files, sorted by series; nothing else may rewrite meanwhile."""
    finish(spark, path)
    rows = _counted(spark, path).where(F.col(OBSERVED_DAY).isin([F.lit(str(day)).cast("date") for day in days]))
    folders = rows.select(F.col(OBSERVED_DAY).cast("string").alias("day"), BATCH).distinct().collect()  # one for each folder
    several = {day for day, count in Counter(f.day for f in folders).items() if count > 1}
    if several:
        kept = rows.where(F.col(OBSERVED_DAY).isin([F.lit(day).cast("date") for day in sorted(several)]))
        _replace(spark, path, kept, [(f.day, f[BATCH]) for f in folders if f.day in several])


def stored_observations() -> T.StructType:
    own = [T.StructField(LANDED, T.StringType()), T.StructField(OBSERVED_DAY, T.DateType()), T.StructField(BATCH, T.StringType())]
    return T.StructType([*OBSERVATIONS.fields, *own])


def _counted(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(stored_observations()).parquet(path)
    for day, batch in _uncounted(spark, path):  # none, but while a rewrite goes on or after one that died
        there = F.col(BATCH) == batch
        rows = rows.where(~(there if day is None else there & (F.col(OBSERVED_DAY) == F.lit(day).cast("date"))))
    return rows


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """All readings; files written before a column existed read as null there."""
    return _counted(spark, path).drop(LANDED)


# How Parquet is told to keep a Bloom filter of a column, and for how many of its values in a row group.
BLOOM = {"parquet.bloom.filter.enabled#run_id": "true", "parquet.bloom.filter.expected.ndv#run_id": "10000"}


def _dynamic(df: DataFrame, path: str, *partition: str) -> None:
    """Replace exactly the partitions present in `df`."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**CODEC, **BLOOM)
    with freed_shuffles(df.sparkSession):
        writer.partitionBy(*partition).parquet(path)


# So many run ids are looked up by their values; more meet the readings in a join.
LISTED_RUNS = 1_000


def readings_of_runs(spark: SparkSession, path: str, runs: DataFrame) -> DataFrame:
    """The stored readings of the runs with the given `run_id`.

    A few ids become a filter that statistics and Bloom filters answer, so only files that hold one of them are read."""
    stored, ids = read_observations(spark, path), runs.select("run_id").distinct()
    few = [row[0] for row in ids.limit(LISTED_RUNS + 1).collect()]
    if len(few) <= LISTED_RUNS:
        return stored.where(F.col("run_id").isin(few))
    return stored.join(ids, "run_id", "left_semi")


def regrade_runs(spark: SparkSession, path: str, readings_path: str, runs: DataFrame) -> None:
    """Re-grade the given runs only, from the files that hold their readings."""
    regrade_store(spark, path, readings_of_runs(spark, readings_path, runs.select(F.col("id").alias("run_id"))), runs)


def save_series(observations: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Readings as a table bucketed by series and sorted in it: history, latest and difference need no exchange of it."""
    rows = evolve(typed_prices(observations), OBSERVATIONS).repartition(buckets, *SERIES_KEY)
    writer = rows.write.mode("overwrite").bucketBy(buckets, *SERIES_KEY).sortBy(*SERIES_KEY, "observed_at", "id")
    writer.format("parquet").option("path", path).saveAsTable(table)
    return observations.sparkSession.table(table)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    stored = T.StructType([*FIELD_OUTCOMES.fields, T.StructField(RUN_DAY, T.DateType())])
    return spark.read.schema(stored).parquet(path)


def _replace_outcomes(
    spark: SparkSession, path: str, fresh: DataFrame, runs: DataFrame, key: list[str]
) -> None:
    """Replace stored outcomes that share `key` with a fresh one, in one commit.

    Only days holding one of the fresh runs are read and rewritten. The fresh ones are written out
    first: they are asked for several times, and counted from readings once.
    """
    columns = [*FIELD_OUTCOMES.names, RUN_DAY]
    days = runs.select(F.col("id").alias("run_id"), utc_day(F.col("started_at")).alias(RUN_DAY))
    with scratch(spark, "outcomes") as work:
        rows = materialize(evolve(fresh, FIELD_OUTCOMES).join(days, "run_id").select(*columns), "fresh", work)
        if folder_exists(spark, path):
            touched = rows.select(RUN_DAY).distinct()
            kept = read_outcomes(spark, path).join(touched, RUN_DAY, "left_semi").join(
                rows.select(*key).distinct(), key, "left_anti"
            )
            rows = materialize(kept.select(*columns).unionByName(rows), "rows", work)
        _dynamic(rows.repartitionByRange(RUN_DAY, "run_id"), path, RUN_DAY)


def upsert_outcomes(spark: SparkSession, path: str, outcomes: DataFrame, runs: DataFrame) -> None:
    """Store outcomes; one already stored for the same run, field and status is replaced."""
    _replace_outcomes(spark, path, outcomes, runs, list(quality.OUTCOME_KEY))


def regrade_store(spark: SparkSession, path: str, observations: DataFrame, runs: DataFrame) -> None:
    """Re-grade: all outcomes of a run with readings are replaced, other runs stay."""
    fresh = quality.regraded_tally(observations, runs)
    _replace_outcomes(spark, path, fresh, runs, ["run_id"])


def read_boundary(spark: SparkSession, path: str) -> DataFrame:
    """The newest deleted reading of each variant; no rows if nothing was kept in `path`."""
    versions = numbered(spark, path, "version")
    if not versions:
        return spark.createDataFrame([], OBSERVATIONS)
    return spark.read.schema(OBSERVATIONS).parquet(f"{path}/version={versions[-1]}")


def _keep_boundary(spark: SparkSession, path: str, doomed: DataFrame) -> None:
    """Renew the newest deleted readings as a version of their own; the one before goes last."""
    versions = numbered(spark, path, "version")
    rows = evolve(doomed, OBSERVATIONS).unionByName(read_boundary(spark, path))
    others = [c for c in OBSERVATIONS.names if c not in (*SERIES_KEY, "observed_at", "id")]
    newest = F.max(F.struct("observed_at", "id", *others)).alias("newest")
    kept = rows.groupBy(*SERIES_KEY).agg(newest).select(*SERIES_KEY, "newest.*")
    evolve(kept, OBSERVATIONS).write.mode("overwrite").parquet(f"{path}/version={max(versions, default=0) + 1}")
    for version in versions:
        delete_folder(spark, f"{path}/version={version}")


def prune_store(
    spark: SparkSession, path: str, as_of: object, days: float = RETENTION_DAYS, dry_run: bool = False,
    boundary: str | None = None,
) -> dict[str, int]:
    """Delete readings older than the cutoff; returns total, doomed and kept.

    Whole days and batches go by folder; only the day of the cutoff is rewritten, and all of it counts at once.
    `boundary` keeps the newest deleted reading of each variant, which change detection
    needs to place a late reading.
    """
    finish(spark, path)
    stored = _counted(spark, path)
    counts = retention.plan(stored, as_of, days).first().asDict()
    if dry_run or counts["doomed"] == 0:
        return counts
    doomed = F.col("observed_at") < retention.cutoff(stored, as_of, days)
    expired = stored.where(
        F.col(OBSERVED_DAY) <= utc_day(retention.cutoff(stored, as_of, days))
    )
    if boundary is not None:
        _keep_boundary(spark, boundary, expired.where(doomed).drop(LANDED))
    folders = (
        expired.groupBy(F.col(OBSERVED_DAY).cast("string").alias(OBSERVED_DAY), BATCH)
        .agg(F.count_if(doomed).alias("doomed"), F.count_if(~doomed).alias("kept"))
        .where("doomed > 0")
        .collect()  # one row per day folder and batch
    )
    partly = [f for f in folders if f["kept"]]
    left = None
    if partly:
        of_them = F.concat_ws("/", F.col(OBSERVED_DAY).cast("string"), BATCH).isin([f"{f[OBSERVED_DAY]}/{f[BATCH]}" for f in partly])
        left = expired.where(~doomed & of_them)
    _replace(spark, path, left, [(f[OBSERVED_DAY], f[BATCH]) for f in folders])
    return counts
