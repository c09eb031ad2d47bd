"""Session helpers: shared work folder, written intermediate tables, time parameters."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


@functools.cache
def _private_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"shelfpulse-{application}-")


# Settings the jobs are meant to run with: runtime re-planning with skew joins, and
# feeds that repeat a JSON key (the last one counts) instead of failing.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def work_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only on a single machine."""
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return _private_dir(spark.sparkContext.applicationId)


def _folder(spark: SparkSession, path: str) -> tuple:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in `path`; none if it does not exist."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(folder) if entry.isDirectory())


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders `name`=number in `path`, ascending."""
    found = (entry.partition("=") for entry in subfolders(spark, path))
    return sorted(int(number) for key, _, number in found if key == name)


def mark(spark: SparkSession, path: str) -> None:
    """Create the empty file `path`, which is there whole or not at all."""
    files, target = _folder(spark, path)
    files.create(target, True).close()


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder, in one step where the file system can."""
    files, source = _folder(spark, path)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(new.getParent())
    if not files.rename(source, new):
        raise OSError(f"cannot move {path} to {target}")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/shelfpulse/{name}-{uuid.uuid4().hex}"


# A written table needs its query's shuffle files no more; on a cluster that ignores it they stay until collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Zstandard needs less disk than the default codec.
CODEC = {"compression": "zstd"}


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go with its query, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage so that lost executors do not recompute it, and gives the
    planner the real size of the table for its join choices. Its shuffle files go at once.
    """
    spark = df.sparkSession
    folder = new_folder(spark, name) if within is None else f"{within}/{name}"
    with freed_shuffles(spark):
        df.write.mode("overwrite").options(**CODEC).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A shared folder for the intermediate tables of one job, gone when it ends."""
    folder = new_folder(spark, name)
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def moment(df: DataFrame, column: str, value: object) -> Column:
    """`value` (text, datetime or Column) in the same time type as `df[column]`."""
    literal = value if isinstance(value, Column) else F.lit(str(value))
    return literal.cast(df.schema[column].dataType)


def days_before(df: DataFrame, column: str, as_of: object, days: float) -> Column:
    seconds = F.lit(float(days) * 86_400).cast("decimal(18,6)")
    return moment(df, column, as_of) - F.make_dt_interval(secs=seconds)


def micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def utc_day(at: Column) -> Column:
    """The UTC date of a moment, whatever the session's time zone."""
    days = F.floor(F.unix_seconds(at.cast("timestamp")) / 86_400)
    return F.date_from_unix_date(days.cast("int"))
