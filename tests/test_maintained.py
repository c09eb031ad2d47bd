"""Figures kept up to date equal those counted anew; readings bucketed by series; rules checked in one pass."""

import re

from pyspark.sql import functions as F

from shelfpulse.operators import catalogue, changes, constraints, quality, report
from shelfpulse.session import materialize
from shelfpulse.sources import maintained, store


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_of_overlapping_and_repeated_steps(spark, tables, tmp_path):
    path, day = str(tmp_path / "bitmaps"), tables.obs_day()
    for step, part in (("a", F.col("id") % 3 < 2), ("b", F.col("id") % 3 > 0), ("a", F.col("id") % 3 < 2)):
        maintained.record_snapshots(day.where(part), path, step)
    got = {r.merchant: r.snaps for r in maintained.snapshot_counts(spark, path).collect()}
    assert got == {r.merchant: r.snaps for r in report.snapshot_counts(day).collect()}
    assert maintained.snapshot_counts(spark, path, F.lit("2030-01-01").cast("date")).collect() == []


def test_bitmaps_of_large_run_numbers(spark, tmp_path):
    path = str(tmp_path / "bitmaps")
    rows = spark.range(1000).select(
        (F.col("id") * 2**34).alias("run_id"), F.lit("m").alias("merchant"), F.timestamp_seconds(F.col("id") * 3600).alias("observed_at"))
    maintained.record_snapshots(rows.unionByName(rows), path, "0")
    assert maintained.snapshot_counts(spark, path).first().snaps == 1000


def test_sums_after_repeated_regrades(spark, tables, tmp_path):
    path = str(tmp_path / "sums")
    right = quality.tally(tables.obs())
    wrong = right.withColumn("status", F.when(F.col("field") == "sku", "invalid").otherwise(F.col("status"))).groupBy(
        "run_id", "merchant", "field", "status").agg(F.sum("count").alias("count"))
    maintained.record_outcomes(wrong, path, "batch")
    for _ in range(2):  # repeating a step replaces it
        maintained.record_outcomes(right, path, "regrade", wrong)
    want = quality.field_quality(right)
    got = maintained.field_quality(spark, path).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert spark.read.parquet(path).where("step = 'regrade'").count() <= 5 * 2 * 3  # merchants, fields changed, statuses


def test_bucketed_series_need_no_exchange(spark, tables, tmp_path):
    series = store.save_series(tables.obs(), "series_of_the_test", str(tmp_path / "series"), 5)
    try:
        for frame in (changes.history(series), changes.latest_diff(series), catalogue.latest_readings(series)):
            assert "Exchange" not in plan_of(frame) and "Bucketed: true" in plan_of(frame)
        assert changes.history(series).count() == changes.history(tables.obs()).count()
    finally:
        spark.sql("DROP TABLE series_of_the_test")


def test_rules_read_each_table_once(spark, tables):
    written = [materialize(df, name) for name, df in (("a", tables.evruns()), ("b", tables.oldout()), ("c", tables.obs()))]
    plan = plan_of(constraints.violations(*written))
    assert len(re.findall("FileScan", plan)) == 3 and "Join" not in plan


def test_few_runs_read_few_files(spark, tmp_path):
    """Run numbers that say nothing about the file: Bloom filters leave out the files without the run."""
    path = str(tmp_path / "obs")
    rows = spark.range(20_000).select(
        "id", F.pmod(F.xxhash64(F.floor(F.col("id") / 1000)), F.lit(10**6)).alias("run_id"), F.lit("m").alias("merchant"),
        F.lit("p").alias("product_ext_id"), F.col("id").cast("string").alias("variant_ext_id"), F.lit("1").alias("price_raw"),
        F.lit("2").alias("compare_at_raw"), F.lit("2024-01-01").cast("timestamp").alias("observed_at"))
    for batch in range(10):
        store.append_observations(rows.where(F.floor(F.col("id") / 2000) == batch), path, str(batch))
    wanted = rows.where("id = 4321").select("run_id")
    assert store.readings_of_runs(spark, path, wanted).count() == 1000
    assert 1000 <= _rows_scanned(store.readings_of_runs(spark, path, wanted)) <= 4000
    assert _rows_scanned(store.read_observations(spark, path).where("abs(run_id) >= 0")) == 20_000
    more = rows.select("run_id").distinct()
    old, store.LISTED_RUNS = store.LISTED_RUNS, 3
    try:
        assert store.readings_of_runs(spark, path, more).count() == 20_000
    finally:
        store.LISTED_RUNS = old


def _rows_scanned(df):
    """How many rows the scans of a plan gave, by their own count."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(n).metrics().apply("numOutputRows").value() for n in range(leaves.size()))
