"""Keeping one hot key from landing in one task.

A merchant, product or variant may hold a large share of all readings. Window
functions put a whole partition key into one task, so keys that measure as hot
are cut into slices first and the slices' ends are stitched together. Slices are cut at
quantiles of the rows' own order, so rows crowded into a moment, or under one id
range of it, are split like any others. Which keys are hot and where they are cut only
steers the balance; the result is the same for any choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.session import materialize

# A key with more rows than this is sliced.
MAX_ROWS = 2_000_000
# Rows of a key at the threshold that the measuring sample should contain.
SAMPLE_ROWS = 1_000
# Size of a key's quantile summary, the most cuts drawn from one, and how often slices are cut again.
CELLS, MOST_CUTS, LEVELS = 8_192, 511, 4


def _sample(df: DataFrame, max_rows: int) -> tuple[DataFrame, float]:
    """A sample sized from the threshold, like range partitioning takes; results never depend on it."""
    fraction = min(1.0, SAMPLE_ROWS / max_rows)
    return (df if fraction == 1.0 else df.sample(fraction, seed=7)), fraction


def hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame | None:
    """Keys holding more than about `max_rows` rows, with `group_rows`; None if no key is hot.

    They are written out, so that the planner knows the table's size; the threshold leaves at
    most one key for each `max_rows` rows, however many keys there are."""
    measured, fraction = _sample(df, max_rows)
    rows = (F.count(F.lit(1)) / fraction).cast("bigint").alias("group_rows")
    found = measured.groupBy(*keys).agg(rows).where(F.col("group_rows") > max_rows)
    return None if found.isEmpty() else materialize(found, "hot-groups")


def cut_points(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS
) -> DataFrame | None:
    """`cuts` of every hot key: one row's `order` for about each `max_rows` rows, ascending, `MOST_CUTS` at most.

    None if no key is hot. Of each of `CELLS` cells, dealt by hash, the row of the least other hash is
    kept: a summary of fixed size that combines before the shuffle, however many rows a key has."""
    hot = hot_groups(df.select(*keys), keys, max_rows)
    if hot is None:
        return None
    measured, _ = _sample(df.select(*keys, F.struct(*order).alias("point")), max_rows)
    one_each = measured.join(hot, list(keys)).groupBy(*keys, F.pmod(F.xxhash64("point"), F.lit(CELLS)).alias("cell")).agg(
        F.min_by("point", F.xxhash64(F.lit(1), "point")).alias("point"), F.first("group_rows").alias("group_rows"))
    points = one_each.groupBy(*keys).agg(
        F.sort_array(F.collect_list("point")).alias("points"), F.first("group_rows").alias("group_rows"))
    parts = F.least(F.ceil(F.col("group_rows") / max_rows), F.size("points"), F.lit(MOST_CUTS + 1)).cast("int")
    ranks = F.sequence(F.lit(1), F.col("parts") - 1)
    at = lambda n: F.get("points", F.floor(n * F.size("points") / F.col("parts")).cast("int"))
    cuts = points.withColumn("parts", parts).where("parts > 1").select(
        *keys, F.array_distinct(F.transform(ranks, at)).alias("cuts"))
    return materialize(cuts, "cut-points")


def slice_of(value: Column, cuts: Column) -> Column:
    """How many of the ascending `cuts` are not above `value`, by binary search."""
    count = F.size(cuts)
    powers = F.sequence(F.floor(F.log2(count)).cast("int"), F.lit(0), F.lit(-1))

    def narrow(found: Column, power: Column) -> Column:
        more = found + F.pow(F.lit(2), power).cast("int")
        return F.when((more <= count) & (F.get(cuts, more - 1) <= value), more).otherwise(found)

    return F.aggregate(powers, F.lit(0), narrow)


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame | None:
    """`df` with the `slice` of each row of a hot key, null for the others; None if no key is hot.

    Slices ascend with the order. One that still holds more than twice the rows is cut once more, so its number
    gets another place; equal rows cannot be cut apart."""
    cuts = cut_points(df, keys, order, max_rows)
    if cuts is None:
        return None
    number = F.when(F.col("cuts").isNotNull(), F.array(slice_of(F.struct(*order), F.col("cuts"))))
    out = df.join(cuts, list(keys), "left").withColumn("slice", number).drop("cuts")
    for _ in range(LEVELS - 1):
        within = [*keys, "slice"]
        cuts = cut_points(out.where("slice IS NOT NULL"), within, order, 2 * max_rows)
        if cuts is None:
            break
        deeper = F.concat("slice", F.array(slice_of(F.struct(*order), F.col("cuts"))))
        out = out.join(cuts, within, "left").withColumn(
            "slice", F.when(F.col("cuts").isNotNull(), deeper).otherwise(F.col("slice"))).drop("cuts")
    return out


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    tie: str,
    values: Sequence[str],
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add `prev_<value>` and `has_prev` from the row before, per key by (at, tie).

    Without hot keys this is one LAG window. With hot keys the window runs per
    slice, and only the first row of each slice is looked up again against the
    last row of the slice before: one row per slice, whatever the slice holds.
    """
    names = [f"prev_{v}" for v in values]

    def previous(window) -> list[Column]:
        lags = [F.lag(v).over(window).alias(n) for v, n in zip(values, names)]
        return [*lags, F.lag(F.lit(True), 1, False).over(window).alias("has_prev")]

    cut = sliced(df, keys, (at, tie), max_rows)
    if cut is None:
        whole = Window.partitionBy(*keys).orderBy(at, tie)
        return df.select("*", *previous(whole))

    inside = Window.partitionBy(*keys, "slice").orderBy(at, tie)
    lagged = cut.select("*", *previous(inside))
    settled = lagged.where(F.col("slice").isNull() | F.col("has_prev")).drop("slice")

    order = [F.col(at), F.col(tie)]
    others = [F.col(c) for c in df.columns if c not in (at, tie, *keys)]
    ends = (
        cut.where("slice IS NOT NULL")
        .groupBy(*keys, "slice")
        .agg(
            F.min(F.struct(*order, *others)).alias("head"),
            F.max(F.struct(*order, *others)).alias("tail"),
        )
    )
    by_slice = Window.partitionBy(*keys).orderBy("slice")
    heads = ends.select(
        *keys, "head.*",
        *[F.lag(f"tail.{v}").over(by_slice).alias(n) for v, n in zip(values, names)],
        F.lag(F.lit(True), 1, False).over(by_slice).alias("has_prev"),
    )
    return settled.unionByName(heads)


def latest_rows(
    df: DataFrame, keys: Sequence[str], at: str, tie: str, max_rows: int = MAX_ROWS
) -> DataFrame:
    """All rows carrying the newest `at` of their key, ties included.

    Ranking drops all but each task's newest rows before the shuffle, so only a crowd
    of rows at one moment can still be hot. Keys with such a crowd are cut down to
    their newest moment where they are read, and its rows, which all rank first, are
    spread by id.
    """
    crowds = hot_groups(df.select(*keys, at), [*keys, at], max_rows)
    if crowds is None:
        newest_first = Window.partitionBy(*keys).orderBy(F.desc(at))
        return df.withColumn("newest", F.rank().over(newest_first)).where("newest = 1").drop("newest")

    hot = crowds.groupBy(*keys).agg(F.max("group_rows").alias("crowd_rows"))
    newest = (
        df.join(hot, list(keys))
        .groupBy(*keys)
        .agg(F.max(at).alias("hot_newest"), F.max("crowd_rows").alias("crowd_rows"))
    )
    marked = df.join(newest, list(keys), "left").where(
        F.col("hot_newest").isNull() | (F.col(at) == F.col("hot_newest"))
    )
    spread = F.coalesce(
        F.pmod(F.xxhash64(tie), F.ceil(F.col("crowd_rows") / max_rows)), F.lit(0)
    )
    newest_first = Window.partitionBy(*keys, "spread").orderBy(F.desc(at))
    return (
        marked.withColumn("spread", spread)
        .withColumn("newest", F.rank().over(newest_first))
        .where("newest = 1")
        .drop("newest", "spread", "hot_newest", "crowd_rows")
    )
