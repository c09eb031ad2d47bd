"""Stored tables, publishing, and the properties that keep re-runs harmless."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfpulse.operators import catalogue, changes, constraints, quality, report, retention
from shelfpulse.plans import queries
from shelfpulse.schemas import CHANGES, OBSERVATIONS, RUNS
from shelfpulse.sources import registry, snapshot, store

NOW = "2024-01-31 00:00:00"


def same(left, right):
    columns = sorted(left.columns)
    left, right = left.select(columns), right.select(columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_merge_is_idempotent(tables):
    fresh, published = changes.history(tables.obs()), tables.published_changes()
    once = changes.merge(published, fresh)
    assert same(once, changes.merge(once, fresh))


def test_merge_counts(tables):
    row = changes.merge_counts(tables.published_changes(), changes.history(tables.obs()), None).first()
    assert row.retained == row.merged > row.fresh > 0


def test_regrade_is_idempotent(tables):
    obs, runs = tables.obs(), tables.evruns()
    once = quality.regrade(tables.oldout(), obs, runs)
    twice = quality.regrade(once, obs, runs)
    assert same(once, twice)
    assert quality.grade_delta(once, twice).where("delta <> 0").isEmpty()


def test_evolve_is_idempotent(tables):
    once = store.evolve(tables.obs().drop("image_url"), OBSERVATIONS)
    assert once.schema.names == OBSERVATIONS.names
    assert same(once, store.evolve(once, OBSERVATIONS))


def test_batch_written_twice_counts_once(spark, tables, tmp_path):
    path = str(tmp_path / "obs")
    for _ in range(2):
        store.append_observations(tables.obs(), path, "7")
    assert store.read_observations(spark, path).count() == 1000


@pytest.mark.parametrize("now", ["2024-01-31 00:00:00", "2024-01-31 07:30:00", "2024-03-01 00:00:00"])
def test_prune(spark, tables, tmp_path, now):
    path = str(tmp_path / "obs")
    store.append_observations(tables.obs(), path, "0")
    before = store.read_observations(spark, path)
    expected = {r.id for r in retention.keep(before, now).collect()}
    dry = store.prune_store(spark, path, now, dry_run=True)
    assert store.read_observations(spark, path).count() == dry["total"] == dry["doomed"] + dry["kept"]
    assert store.prune_store(spark, path, now) == dry
    assert {r.id for r in store.read_observations(spark, path).collect()} == expected
    assert store.prune_store(spark, path, now)["doomed"] == 0


def test_prune_from_another_time_zone(spark, tables, tmp_path):
    path, now = str(tmp_path / "obs"), dt.datetime(2024, 1, 31, 3, tzinfo=dt.timezone.utc)
    store.append_observations(tables.obs(), path, "0")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        local = F.lit(now)
        counts = store.prune_store(spark, path, local)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    stored = store.read_observations(spark, path)
    assert counts["doomed"] > 0 and stored.count() == counts["kept"]
    assert stored.where("observed_at < timestamp'2024-01-17 03:00:00'").isEmpty()


def test_publish_changes_of_the_stream(spark, tables, tmp_path):
    folder, obs = str(tmp_path / "public"), tables.obs()
    found = changes.history(obs).where("kind = 'stock'")
    runs = store.evolve(tables.evruns(), RUNS)
    snapshot.publish(folder, tables.registry(), runs, tables.oldout(), obs, fresh=found)
    kept = snapshot.read_published_changes(spark, f"{snapshot.current(spark, folder)}/snapshot/changes")
    assert kept.count() == found.count()


def counted(rows, counter):
    """`rows`, each of which adds one to `counter` whenever it is worked out."""
    def run(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(run, rows.schema)


def test_rows_are_worked_out_once(spark, tables, tmp_path):
    """Readings that are stored, outcomes that are upserted and runs that are published, whatever sorts or asks for them."""
    obs, runs, tallied = tables.obs().where("id < 500"), tables.evruns(), quality.tally(tables.obs())
    counters = [spark.sparkContext.accumulator(0) for _ in range(4)]
    store.append_observations(counted(obs, counters[0]), f"{tmp_path}/store", "0")
    assert counters[0].value == obs.count()
    store.upsert_outcomes(spark, f"{tmp_path}/outcomes", tallied, runs)
    store.upsert_outcomes(spark, f"{tmp_path}/outcomes", counted(tallied, counters[1]), runs)
    assert counters[1].value == tallied.count()
    whole = store.evolve(runs, RUNS)
    snapshot.publish(f"{tmp_path}/public", tables.registry(), counted(whole, counters[2]), counted(tallied, counters[3]), obs)
    assert (counters[2].value, counters[3].value) == (whole.count(), tallied.count())


def test_outcomes_are_upserted_by_key(spark, tables, tmp_path):
    path, runs = str(tmp_path / "outcomes"), tables.evruns()
    first = tables.oldout()
    store.upsert_outcomes(spark, path, first, runs)
    changed = first.where("status = 'invalid'").withColumn("count", F.col("count") + 1)
    for _ in range(2):
        store.upsert_outcomes(spark, path, changed, runs)
    expected = first.where("status <> 'invalid'").unionByName(changed)
    assert same(store.read_outcomes(spark, path).drop(store.RUN_DAY), expected)


def test_broken_rules_are_found(spark, tables):
    runs = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "id bigint, merchant string")
    outcomes = spark.createDataFrame(
        [(1, "a", "sku", "ok", 3), (1, "a", "sku", "ok", 4), (1, "a", "sku", "odd", 1), (9, "a", "sku", "ok", 1)],
        "run_id bigint, merchant string, field string, status string, count bigint",
    )
    observations = spark.createDataFrame([(1, 1, None), (2, 8, "a")], "id bigint, run_id bigint, merchant string")
    found = {tuple(r) for r in constraints.violations(runs, outcomes, observations).collect()}
    assert found == {
        ("runs", "required", "merchant", 1), ("runs", "unique", "1", 2),
        ("field_outcomes", "unique", "1|sku|ok", 2), ("field_outcomes", "status", "odd", 1),
        ("field_outcomes", "run", "9", 1), ("observations", "required", "merchant", 1),
        ("observations", "run", "8", 1),
    }


def test_cutoff_is_strict(spark):
    moments = [dt.datetime(2024, 1, 17) + dt.timedelta(microseconds=n) for n in (-1, 0, 1)]
    df = spark.createDataFrame([(m,) for m in moments], "observed_at timestamp_ntz")
    assert retention.keep(df, NOW).count() == 2


def test_published_changes(spark, tmp_path):
    folder = str(tmp_path / "changes")
    assert snapshot.read_published_changes(spark, folder).isEmpty()
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    row = (moment, "m", "v", None, "x", "price", 1.5, None, None, "abc")
    snapshot.write_changes(spark.createDataFrame([row], CHANGES), folder)
    assert snapshot.read_published_changes(spark, folder).collect()[0] == row
    text = spark.read.text(folder).first()[0]
    assert '"at":"2024-01-02T03:04:05.678901Z","m":"m","v":"v","t":null' in text and '"to":null' in text
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(folder)
    with pytest.warns(UserWarning, match="1 published changes are unreadable"):
        assert snapshot.read_published_changes(spark, folder).collect() == [row]


def test_registry_of_many_lines_and_files(spark, tables, tmp_path):
    rows, path = tables.registry(), str(tmp_path / "lines")
    line = F.to_json(F.struct(*rows.columns)).alias("value")
    rows.select(line).repartition(3).write.text(path)
    want = sorted(map(str, rows.collect()))
    assert sorted(map(str, registry.read_registry(spark, path).select(*rows.columns).collect())) == want
    lines = [r.value for r in rows.select(line).collect()]
    for n, text in enumerate(["[" + ",".join(lines) + "]", "[\n  " + ",\n  ".join(lines) + "\n]\n"]):
        (tmp_path / f"{n}.json").write_text(text)
        assert sorted(map(str, registry.read_registry(spark, str(tmp_path / f"{n}.json")).select(*rows.columns).collect())) == want


def test_publish(spark, tables, tmp_path):
    folder, obs = str(tmp_path / "public"), tables.obs()
    runs = store.evolve(tables.evruns(), RUNS)
    folder = snapshot.publish(folder, tables.registry(), runs, quality.tally(obs), obs)
    assert spark.read.json(f"{folder}/snapshot/changes").count() == changes.history(obs).count()
    assert spark.read.json(f"{folder}/snapshot/runs").count() == runs.count()
    assert spark.read.json(f"{folder}/snapshot/merchants").count() == 10
    meta = spark.read.json(f"{folder}/snapshot/meta").first()
    assert meta.schema_version == spark.read.json(f"{folder}/catalogue/meta").first().schema_version == 1
    totals = spark.read.json(f"{folder}/snapshot/totals").first()
    products = spark.read.json(f"{folder}/catalogue/products")
    assert products.count() == totals.products
    assert products.select(F.explode("variants")).count() == totals.variants


def test_every_query_publishes_anew(tables, monkeypatch):
    published, publish = [], snapshot.publish
    monkeypatch.setattr(snapshot, "publish", lambda folder, *rest: published.append(folder) or publish(folder, *rest))
    first, second = queries.published_merchants(tables), queries.published_merchants(tables)
    assert len(published) == 4 and len(set(published)) == 2
    assert sorted(first.collect()) == sorted(second.collect())


def test_a_failed_publication_leaves_the_last_one(spark, tables, tmp_path, monkeypatch):
    folder, obs = str(tmp_path / "public"), tables.obs()
    runs, tallied = store.evolve(tables.evruns(), RUNS), quality.tally(obs)
    first = snapshot.publish(folder, tables.registry(), runs, tallied, obs)
    before = spark.read.json(f"{first}/snapshot/changes").count()
    monkeypatch.setattr(snapshot, "mark", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        snapshot.publish(folder, tables.registry(), runs, tallied, obs.where("false"))
    monkeypatch.undo()
    assert snapshot.current(spark, folder) == first
    assert spark.read.json(f"{first}/snapshot/changes").count() == before
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(f"{first}/snapshot/changes")
    with pytest.warns(UserWarning, match="put aside"):
        last = snapshot.publish(folder, tables.registry(), runs, tallied, obs.where("false"))
    assert last != first and spark.read.json(f"{last}/snapshot/changes").count() == before
    assert [r.value for r in spark.read.text(f"{last}/snapshot/unreadable").collect()] == ["{broken"]


def test_redaction_covers_every_section(spark, tables, tmp_path):
    obs, runs = tables.obs(), tables.evruns().withColumns(
        {"duration_ms": F.lit(5), "bytes": F.lit(1), "cost_usd": F.lit(0.0)}
    )
    sections = snapshot.report_sections(runs, quality.tally(obs), obs)
    snapshot.write_report(str(tmp_path), sections, report.merchant_labels(runs))
    for name in sections:
        shown = {r.merchant for r in spark.read.json(str(tmp_path / name)).select("merchant").distinct().collect()}
        assert shown <= {f"merchant-{c}" for c in "ABCDE"} and shown


def test_unknown_stock_stays_unknown(spark, tables):
    latest = catalogue.latest_readings(tables.obs())
    rows = catalogue.variants(latest, catalogue.products(latest))
    row = catalogue.totals(latest).first()
    assert rows.where("avail IS NULL").count() == row.unknown_stock > 0


def test_total_row_without_runs(tables):
    rows = report.reliability_with_total(tables.runs().where("false")).collect()
    assert [(r.merchant, r.runs, r.ok_rate, r.cost) for r in rows] == [("ALL", 0, 0.0, 0.0)]
