"""Change detection with one state per variant, kept by Spark's state store.

The state is a variant's last reading. A batch's readings of a variant are taken in their order and each meets
the one before it, the first of them the state. A state that nothing has followed for `keep_days` is dropped by a timer
on the readings' own time, whatever the clock says; a reading that comes later than that after the one before starts
afresh, whether the timer ran or not, so results do not depend on how readings fall into batches. Readings older than
their variant's state are late: they are told apart in the output and change nothing. With `keep_days`, Spark drops
readings that far behind the newest of earlier batches before they get here.

Unlike `streaming.changes` nothing is rewritten per batch but the states that changed. `limit_files` bounds the files,
and so the readings of one variant, that a batch brings.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from shelfpulse.operators import changes
from shelfpulse.schemas import SERIES_KEY, struct_of
from shelfpulse.sources import store

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

COMPARED = (*changes.PRICE, "available")
_VALUES = "price double, price_text string, available boolean"
_STATE = struct_of(f"micros bigint, id bigint, {_VALUES}, timer bigint")
LINKED = struct_of(
    f"id bigint, merchant string, variant_ext_id string, title string, variant_title string, observed_at timestamp, {_VALUES},"
    " prev_price double, prev_price_text string, prev_available boolean, has_prev boolean, late boolean"
)
_linked = Row(*LINKED.names)
# What a reading comes in as, read by place: a name is searched for anew in every row.
_READING = ("id", *SERIES_KEY, "title", "variant_title", "observed_at", *COMPARED, "micros")
_PASSED, _VALUES_AT = slice(0, 6), slice(6, 6 + len(COMPARED))


class LastReading(StatefulProcessor):
    """Adds to each reading the values of its variant's last one."""

    def __init__(self, keep_ms: int | None) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        last = self.last.get()
        timer = last[-1] if last else None
        for row in sorted(rows, key=lambda r: (r[-1], r[0])):
            at, values = (row[-1], row[0]), tuple(row[_VALUES_AT])
            late = last is not None and at < (last[0], last[1])
            follows = last is not None and not late and (
                self.keep_ms is None or at[0] - last[0] <= 1000 * self.keep_ms)
            before = tuple(last[2:5]) if follows else (None,) * len(COMPARED)
            yield _linked(*row[_PASSED], *values, *before, follows, late)
            if not late:
                last = (*at, *values, timer)
        if last is not None:
            if self.keep_ms is not None:
                due = -(-last[0] // 1000) + self.keep_ms + 1
                if due != timer:
                    if timer is not None:
                        self.handle.deleteTimer(timer)
                    self.handle.registerTimer(due)
                last = (*last[:5], due)
            self.last.update(last)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def linked(readings: DataFrame, keep_days: float | None = None) -> DataFrame:
    """A stream of stored readings, each with its predecessor from the state."""
    split = changes.price_readings(readings).withColumn("observed_at", F.col("observed_at").cast("timestamp"))
    timed = split.withColumn("micros", F.unix_micros("observed_at")).select(*_READING)
    if keep_days is not None:
        timed = timed.withWatermark("observed_at", f"{round(keep_days * 86_400)} seconds")
    return timed.groupBy(*SERIES_KEY).transformWithState(
        LastReading(None if keep_days is None else round(keep_days * 86_400_000)), LINKED, "Append",
        "None" if keep_days is None else "EventTime")


def start_state_changes(
    spark: SparkSession, readings_path: str, folder: str, checkpoint: str,
    keep_days: float | None = None, limit_files: int | None = None,
) -> StreamingQuery:
    """Detect changes in all readings stored since the last call, then stop. Rewritten files hold no news."""
    reader = spark.readStream.schema(store.stored_observations())
    reader = reader if limit_files is None else reader.option("maxFilesPerTrigger", limit_files)
    stored = reader.parquet(readings_path).where(~F.col(store.BATCH).startswith(store.REWRITTEN))
    rows = linked(stored, keep_days)
    moved = rows.where(F.col("late") | (F.col("has_prev") & changes.differs()))
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (
            moved.writeStream.format("parquet").option("path", f"{folder}/moved")
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(PROVIDER, before)


def _moved(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LINKED).parquet(f"{folder}/moved")


def read_state_changes(spark: SparkSession, folder: str) -> DataFrame:
    """All events found, each once: the sink counts a batch's files only when it is whole."""
    return changes.change_events(_moved(spark, folder).where("NOT late"))


def read_late(spark: SparkSession, folder: str) -> DataFrame:
    """Readings that came after a later one of their variant."""
    return _moved(spark, folder).where("late").select("id", *SERIES_KEY, "observed_at")
