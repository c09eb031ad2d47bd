"""Incremental change detection, equal to recomputing the whole history.

Each batch meets only the last readings of the variants it touches; these are kept in
hash buckets, of which a batch reads and renews those that it has variants of. A reading
older than the last one of its variant (a late one) makes events wrong from its moment
on: those are voided and worked out again from the stored readings. Events before it
stay, and so do those that readings deleted since cannot rebuild: the newest deleted reading of
a variant (see `store.prune_store`) leads its stored ones, and a late reading older than that
changes nothing; it is put aside.
All results are written under the batch number, so repeating a batch after a
failure replaces its output instead of adding to it. Files that compaction or retention wrote
again are no news: their rows say which batch they landed in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfpulse.operators import changes
from shelfpulse.operators.skew import MAX_ROWS, with_previous
from shelfpulse.schemas import CHANGE_KEY, SERIES_KEY
from shelfpulse.session import (
    days_before, delete_folder, folder_exists, materialize, numbered, scratch,
)
from shelfpulse.sources import store

EPOCH = "epoch"
BUCKET = "bucket"
# Buckets of the last readings: the least that a batch renews is one of them.
BUCKETS = 64


def _versions(spark: SparkSession, folder: str, before: int) -> dict[int, list[int]]:
    """For each bucket the batches before `before` that renewed it, oldest first."""
    found: dict[int, list[int]] = {}
    for epoch in numbered(spark, f"{folder}/last", EPOCH):
        if epoch < before:
            for bucket in numbered(spark, f"{folder}/last/{EPOCH}={epoch}", BUCKET):
                found.setdefault(bucket, []).append(epoch)
    return found


def _bucket_folder(folder: str, epoch: int, bucket: int) -> str:
    return f"{folder}/last/{EPOCH}={epoch}/{BUCKET}={bucket}"


def _newest_per_variant(readings: DataFrame) -> DataFrame:
    """One row per variant by an aggregate that combines before the shuffle."""
    others = [c for c in readings.columns if c not in (*SERIES_KEY, "observed_at", "id")]
    newest = F.max(F.struct("observed_at", "id", *others)).alias("newest")
    return readings.groupBy(*SERIES_KEY).agg(newest).select(*SERIES_KEY, "newest.*")


def _after_seeds(
    arriving: DataFrame, seeds: DataFrame, work: str
) -> tuple[DataFrame, DataFrame]:
    """Variants with late readings, and the series of all others led by their last reading."""
    touched = arriving.groupBy(*SERIES_KEY).agg(F.min(F.struct("observed_at", "id")).alias("first"))
    known = seeds.join(touched, list(SERIES_KEY))
    overtaken = known.where(F.col("first") < F.struct("observed_at", "id"))
    late = materialize(overtaken.select(*SERIES_KEY), "late", work)
    timely = arriving.join(late, list(SERIES_KEY), "left_anti").withColumn("is_seed", F.lit(False))
    # The last readings act as rows of the batch, so one window serves both.
    before = known.drop("first").join(late, list(SERIES_KEY), "left_anti")
    return late, timely.unionByName(before.withColumn("is_seed", F.lit(True)))


def detect_batch(
    observations: DataFrame,
    epoch: int,
    readings_path: str,
    folder: str,
    keep_days: float | None = None,
    max_rows: int = MAX_ROWS,
    boundary: str | None = None,
) -> None:
    with scratch(observations.sparkSession, "changes") as work:
        _detect(observations, epoch, readings_path, folder, work, keep_days, max_rows, boundary)


def _from_late_on(
    late: DataFrame, arriving: DataFrame, deleted: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Per late variant the moment from which its events are worked out again, and its newest
    deleted reading; and the late readings that are too old for it."""
    known = deleted.select(*SERIES_KEY, F.struct("observed_at", "id").alias("gone"))
    readings = arriving.join(late, list(SERIES_KEY), "left_semi").join(known, list(SERIES_KEY), "left")
    too_old = F.col("gone").isNotNull() & (F.struct("observed_at", "id") <= F.col("gone"))
    again_from = readings.where(~F.coalesce(too_old, F.lit(False))).groupBy(*SERIES_KEY).agg(
        F.min("observed_at").alias("void_from"))
    return again_from, readings.where(too_old).drop("gone")


def _not_forgotten(seeds: DataFrame, folder: str, epoch: int, keep_days: float) -> DataFrame:
    """Last readings at most `keep_days` older than the newest one of earlier batches."""
    newest = seeds.sparkSession.read.parquet(f"{folder}/newest").where(F.col(EPOCH) < epoch).agg(
        F.max("newest")).first()[0]
    return seeds.where(F.col("observed_at") >= days_before(seeds, "observed_at", newest, keep_days))


def _detect(
    observations: DataFrame, epoch: int, readings_path: str, folder: str, work: str,
    keep_days: float | None, max_rows: int, boundary: str | None,
) -> None:
    spark = observations.sparkSession
    bucket = F.pmod(F.xxhash64(*SERIES_KEY), F.lit(BUCKETS)).cast("int")
    arriving = materialize(changes.price_readings(observations), "readings", work)
    touched = [row[0] for row in arriving.select(bucket).distinct().collect()]  # at most BUCKETS
    versions = _versions(spark, folder, epoch)
    paths = [_bucket_folder(folder, versions[b][-1], b) for b in touched if b in versions]
    series = arriving.withColumn("is_seed", F.lit(False))
    seeds = late = None
    if paths:
        seeds = spark.read.schema(arriving.schema).parquet(*paths)
        if keep_days is not None:
            seeds = _not_forgotten(seeds, folder, epoch, keep_days)
        late, series = _after_seeds(arriving, seeds, work)
    linked = with_previous(
        series, SERIES_KEY, "observed_at", "id", [*changes.PRICE, "available"], max_rows
    )
    events = changes.change_events(linked.where("NOT is_seed"))
    if late is not None and not late.isEmpty():
        stored = store.evolve(store.read_observations(spark, readings_path), store.OBSERVATIONS)
        deleted = stored.limit(0) if boundary is None else store.read_boundary(spark, boundary).join(
            late, list(SERIES_KEY), "left_semi")
        again_from, unplaced = _from_late_on(late, arriving, changes.price_readings(deleted))
        again_from = materialize(again_from, "again", work)
        unplaced.write.mode("overwrite").parquet(f"{folder}/unplaced/{EPOCH}={epoch}")
        gone = deleted.select(*SERIES_KEY, F.struct("observed_at", "id").alias("gone"))
        kept = stored.join(again_from.select(*SERIES_KEY), list(SERIES_KEY), "left_semi").join(
            gone, list(SERIES_KEY), "left").where(
            F.col("gone").isNull() | (F.struct("observed_at", "id") > F.col("gone"))).drop("gone")
        rebuilt = changes.history(kept.unionByName(deleted), max_rows).join(again_from, list(SERIES_KEY))
        events = events.unionByName(rebuilt.where("at >= void_from").drop("void_from"))
        again_from.write.mode("overwrite").parquet(f"{folder}/recomputed/{EPOCH}={epoch}")
    events.write.mode("overwrite").parquet(f"{folder}/changes/{EPOCH}={epoch}")

    last = _newest_per_variant(arriving if seeds is None else seeds.unionByName(arriving))
    arriving.agg(F.max("observed_at").alias("newest")).write.mode("overwrite").parquet(
        f"{folder}/newest/{EPOCH}={epoch}")
    last.withColumn(BUCKET, bucket).write.mode("overwrite").partitionBy(BUCKET).parquet(
        f"{folder}/last/{EPOCH}={epoch}")
    for b in touched:  # the version before stays for a repeated batch
        for old in versions.get(b, [])[:-1]:
            delete_folder(spark, _bucket_folder(folder, old, b))
    for old in {epoch for epochs in versions.values() for epoch in epochs[:-1]}:
        if not numbered(spark, f"{folder}/last/{EPOCH}={old}", BUCKET):
            delete_folder(spark, f"{folder}/last/{EPOCH}={old}")


def unseen(readings: DataFrame, epoch: int, folder: str) -> DataFrame:
    """Readings of batches that no earlier epoch took in, and notes down theirs.

    Compaction and retention write rows again under a new batch; each row still says which it landed in."""
    spark = readings.sparkSession
    landed = F.coalesce(store.LANDED, store.BATCH)
    path = f"{folder}/seen"
    names = readings.select(landed.alias("landed"), store.OBSERVED_DAY).distinct()
    names.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")
    before = spark.read.parquet(path).where(F.col(EPOCH) < epoch).select("landed", store.OBSERVED_DAY).distinct()
    rewritten = readings.where(F.col(store.BATCH).startswith(store.REWRITTEN)).withColumn("landed", landed)
    fresh = rewritten.join(before, ["landed", store.OBSERVED_DAY], "left_anti").select(*readings.columns)
    return readings.where(~F.col(store.BATCH).startswith(store.REWRITTEN)).unionByName(fresh)


def start_changes(
    spark: SparkSession,
    readings_path: str,
    folder: str,
    checkpoint: str,
    keep_days: float | None = None,
    max_rows: int = MAX_ROWS,
    boundary: str | None = None,
) -> StreamingQuery:
    """Detect changes in all readings stored since the last call, then stop.

    `keep_days` forgets last readings that old, matching a pruned store; `boundary` is
    where pruning keeps each variant's newest deleted reading.
    """

    def detect(observations: DataFrame, epoch: int) -> None:
        news = unseen(observations, epoch, folder)
        detect_batch(news, epoch, readings_path, folder, keep_days, max_rows, boundary)

    stored = spark.readStream.schema(store.stored_observations()).parquet(readings_path)
    return (
        stored.writeStream.foreachBatch(detect)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Current events: none that a later batch voided, one per change key."""
    events = spark.read.parquet(f"{folder}/changes")
    if folder_exists(spark, f"{folder}/recomputed"):
        void = F.struct(F.col(EPOCH).alias("epoch"), F.col("void_from").alias("start"))
        voids = spark.read.parquet(f"{folder}/recomputed").groupBy(*SERIES_KEY).agg(
            F.collect_list(void).alias("voids"))  # one for each batch with late readings of the variant
        wrong = F.exists("voids", lambda v: (v["epoch"] > F.col(EPOCH)) & (v["start"] <= F.col("at")))
        events = events.join(voids, list(SERIES_KEY), "left").where(
            ~F.coalesce(wrong, F.lit(False))).drop("voids")
    others = [c for c in events.columns if c not in (*CHANGE_KEY, EPOCH, "id")]
    newest = F.max(F.struct(EPOCH, "id", *others)).alias("event")
    return events.groupBy(*CHANGE_KEY).agg(newest).select(*CHANGE_KEY, "event.*").drop(EPOCH)
