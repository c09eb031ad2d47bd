"""Streaming equals recomputing everything, also with late readings and repeats."""

from pyspark.sql import functions as F

from shelfpulse.operators import changes
from shelfpulse.session import numbered
from shelfpulse.sources import store
from shelfpulse.streaming import changes as stream


def events(df):
    return sorted(tuple(r) for r in df.select("at", "merchant", "variant_ext_id", "kind", "from_value",
                                              "to_value", "from_text", "to_text").fillna(-1.0).fillna("").collect())


def run(spark, folder, batches, max_rows=10_000_000, **options):
    path = f"{folder}/observations"
    for number, batch in enumerate(batches):
        store.append_observations(batch, path, str(number))
        stream.start_changes(
            spark, path, f"{folder}/out", f"{folder}/checkpoint", max_rows=max_rows, **options
        ).awaitTermination()
    return stream.read_changes(spark, f"{folder}/out"), store.read_observations(spark, path)


def test_late_readings(spark, tables, tmp_path):
    obs, day = tables.obs(), F.dayofmonth("observed_at")
    batches = [obs.where(day <= 10), obs.where(day > 20), obs.where((day > 10) & (day <= 20))]
    detected, stored = run(spark, str(tmp_path), batches)
    assert events(detected) == events(changes.history(stored))


def test_hot_variant_in_stream(spark, tables, tmp_path):
    obs = tables.obs().withColumn("merchant", F.lit("m")).withColumn(
        "variant_ext_id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("variant_ext_id"))
    )
    day = F.dayofmonth("observed_at")
    detected, stored = run(spark, str(tmp_path), [obs.where(day <= 15), obs.where(day > 15)], max_rows=20)
    assert events(detected) == events(changes.history(stored))


def test_repeated_batch_changes_nothing(spark, tables, tmp_path):
    obs, folder = tables.obs(), str(tmp_path)
    detected, _ = run(spark, folder, [obs.where("dayofmonth(observed_at) <= 15"), obs.where("dayofmonth(observed_at) > 15")])
    before = events(detected)
    second = store.read_observations(spark, f"{folder}/observations").where("batch = '1'")
    stream.detect_batch(second, 1, f"{folder}/observations", f"{folder}/out")
    assert events(stream.read_changes(spark, f"{folder}/out")) == before


def test_old_last_readings_are_forgotten(spark, tables, tmp_path):
    obs, day = tables.obs(), F.dayofmonth("observed_at")
    kept = [obs.where(day == 1), obs.where(day == 28), obs.where(day == 29)]
    detected, _ = run(spark, str(tmp_path), kept, keep_days=5)
    expected = changes.history(kept[1].unionByName(kept[2])).unionByName(changes.history(kept[0].unionByName(kept[1])))
    found = {e[:4] for e in events(detected)}
    assert {e[:4] for e in events(changes.history(kept[1].unionByName(kept[2])))} <= found
    assert found <= {e[:4] for e in events(expected)}
    assert spark.read.parquet(f"{tmp_path}/out/last/epoch=2").where("dayofmonth(observed_at) = 1").isEmpty()


def test_a_batch_renews_only_the_buckets_it_touches(spark, tables, tmp_path):
    path, detected, ck = (f"{tmp_path}/{name}" for name in ("observations", "detected", "checkpoint"))
    obs, day = tables.obs(), F.dayofmonth("observed_at")
    store.append_observations(obs.where(day <= 20), path, "0")
    stream.start_changes(spark, path, detected, ck).awaitTermination()
    one = obs.where((day > 20) & (F.col("variant_ext_id") == "7") & (F.col("merchant") == "click"))
    store.append_observations(one, path, "1")
    stream.start_changes(spark, path, detected, ck).awaitTermination()
    assert len(numbered(spark, f"{detected}/last/epoch=0", "bucket")) > 10
    assert len(numbered(spark, f"{detected}/last/epoch=1", "bucket")) == (0 if one.isEmpty() else 1)
    whole = changes.history(obs.where(day <= 20).unionByName(one))
    assert events(stream.read_changes(spark, detected)) == events(whole)


def test_days_are_stored_in_few_files_and_compacted(spark, tables, tmp_path):
    path, obs = f"{tmp_path}/observations", tables.obs()
    days = obs.select(F.to_date("observed_at")).distinct().count()
    store.append_observations(obs.where("id % 2 = 0").repartition(16), path, "0")
    assert len(store.read_observations(spark, path).inputFiles()) <= 2 * days
    store.append_observations(obs.where("id % 2 = 1").repartition(16), path, "1")
    day = obs.select(F.to_date("observed_at").cast("string")).first()[0]
    before = store.read_observations(spark, path).where(F.col("obs_date") == day).count()
    store.compact(spark, path, day)
    after = store.read_observations(spark, path)
    assert after.where(F.col("obs_date") == day).count() == before and after.count() == obs.count()
    assert after.where(F.col("obs_date") == day).select("batch").distinct().count() == 1
