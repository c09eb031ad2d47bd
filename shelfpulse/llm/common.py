"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import io
import sys
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.session import delete_folder, folder_exists, new_folder

__all__ = ["delete_folder", "folder_exists", "materialize", "new_folder", "table", "crc_mod",
           "bucketed", "give_back", "ship", "shipped", "slices", "small_batches", "spare", "mix", "prefix_sums", "span_hash"]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, by way of the shared folder.

    Python tasks import it there; without this it would have to be on every worker's path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    path = context._jvm.org.apache.hadoop.fs.Path(f"{new_folder(spark, 'code')}/{package.name}.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    context.addPyFile(path.toString())
    _shipped.add(context.applicationId)


def shipped(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """`job` (its first argument is the session) after `ship`."""
    @wraps(job)
    def run(spark: SparkSession, *rest: object) -> DataFrame:
        ship(spark)
        return job(spark, *rest)

    return run


# Texts go to a Python worker in batches, which lie in the JVM and in the worker at once; Spark's default is 64 MB.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches of at most `BATCH_BYTES` from now on, unless the session was given a size of its own."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, BATCH_BYTES)


# A written table needs its query's shuffle files no more; on a cluster that ignores it they stay until collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, within: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back; its shuffle files go at once, not at the end of the job.

    Zstandard needs less disk than the default codec, and no direct buffers that outlive a task."""
    spark = df.sparkSession
    folder = new_folder(spark, name) if within is None else f"{within}/{name}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def bucketed(df: DataFrame, name: str, folder: str, by: str) -> tuple[DataFrame, str]:
    """`df` written to the shared folder in buckets of `by`, as many as there are shuffle partitions, and its name in the
    catalogue: joins and groupings by that column read it without shuffling it again."""
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(count, by).write.bucketBy(count, by).format("parquet")
    writer.option("path", f"{folder}/{name}").option("compression", "zstd").saveAsTable(listed)
    return spark.table(listed), listed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def spare(taken: Iterable[str], name: str) -> str:
    """`name`, led by underscores until no column in `taken` is called so, in any case."""
    used = {own.lower() for own in taken}
    while name in used:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Return to the system what this process's allocators hold unused.

    A Python worker outlives its tasks, and all workers of an executor share its memory with the JVM."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of about `limit` bytes of `column`, however long its values."""
    try:
        for batch in batches:
            sizes = np.fromiter(
                (len(value.as_buffer() or b"") if value.is_valid else 0 for value in batch.column(column)),
                np.int64, batch.num_rows,
            )
            block = np.cumsum(sizes) // limit
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if stop > start:
                    yield batch.slice(start, stop - start)
    finally:
        give_back()


# Odd multipliers of a 64-bit finalizer and of the rolling hash.
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
BASE = 0x9E3779B97F4A7C15


def mix(values: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of each 64-bit value."""
    out = values ^ (values >> np.uint64(30))
    out *= MIX_1
    out ^= out >> np.uint64(27)
    out *= MIX_2
    out ^= out >> np.uint64(31)
    return out


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below a power of two of at least `count`."""
    size = 1 << max(10, int(count - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, BASE, np.uint64), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value * BASE**-i before each place; span_hash() turns them into hashes of any span."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(len(values) + 1)[1][: len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the values from start to stop that does not depend on where they stand."""
    up = powers(len(sums))[0]
    return mix((sums[stop] - sums[start]) * up[start] + (stop - start).astype(np.uint64))
