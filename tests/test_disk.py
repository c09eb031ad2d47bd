"""What jobs leave on disk while they run: shuffle files, copies of pages, tables no longer read."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from shelfpulse.operators import ingest
from shelfpulse.plans import queries
from shelfpulse.plans.fixtures import Tables
from shelfpulse.schemas import OBSERVATIONS, PAGES
from shelfpulse.session import materialize, subfolders, work_dir
from shelfpulse.sources import store
from shelfpulse.streaming import ingest as page_stream

START = dt.datetime(2024, 1, 1)


def shuffle_files(spark):
    tops = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def page(run, number, products, merchant="m", at=START, status=200):
    items = [{"id": p, "variants": [{"id": p, "price": "1.50"}]} for p in range(products)]
    return (run, merchant, number, status, json.dumps({"products": items}), at)


def shops(spark):
    return spark.createDataFrame(
        [("m", "shopify_products_json", "USD", True)], "slug string, method string, currency string, enabled boolean")


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_written_tables_leave_no_shuffle_files(spark, tables, tmp_path):
    before = shuffle_files(spark)
    dealt = materialize(tables.obs().repartition(5, "id"), "dealt")
    assert not shuffle_files(spark) - before
    store._dynamic(dealt.repartitionByRange("id"), str(tmp_path / "by-merchant"), "merchant")
    assert not shuffle_files(spark) - before
    dealt.repartition(5, "id").write.parquet(str(tmp_path / "plain"))
    assert shuffle_files(spark) - before  # so those above went because they were told to


def test_pages_landed_in_parts_are_all_pages(spark, tmp_path):
    orders = [(n, "1-URGENT") for n in [*range(0, 1200, 7), 14, 14, -7, 1049, None, None]]
    lines = [(n, float(n or 0) / 3, "ANR"[i]) for n in [*range(0, 1200, 5), 14, -7, None] for i in range(3)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_extendedprice double, l_returnflag string").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    t = Tables(spark, str(tmp_path))
    whole = [r for r in t.pages().collect() if r.run_id is not None]
    parts = [t.pages(part, 3).collect() for part in range(3)]
    assert sorted(map(repr, whole)) == sorted(repr(r) for part in parts for r in part)
    assert all(parts) and any(r.page == 11 for r in whole)


def test_landed_pages_have_no_second_copy(spark, tables):
    folder = f"{work_dir(spark)}/shelfpulse"
    before = set(subfolders(spark, folder))
    assert queries.stream_runs_split(tables).count() > 0
    new = set(subfolders(spark, folder)) - before
    assert [name.rsplit("-", 1)[0] for name in new] == ["stream-runs"]
    assert "landing" not in subfolders(spark, f"{folder}/{new.pop()}")


def test_parsed_pages_are_gone_when_readings_are_dealt(spark, tables, tmp_path, monkeypatch):
    pages = spark.createDataFrame([page(1, 1, 2), page(2, 1, 1)], PAGES)
    registry = shops(spark)
    seen, dynamic, folder = [], store._dynamic, f"{work_dir(spark)}/shelfpulse"
    before = set(subfolders(spark, folder))

    def watched(df, path, *partition):
        work = [n for n in subfolders(spark, folder) if n.startswith("ingest-") and n not in before]
        seen.append({table for name in work for table in subfolders(spark, f"{folder}/{name}")})
        dynamic(df, path, *partition)

    monkeypatch.setattr(store, "_dynamic", watched)
    page_stream.ingest_batch(pages, registry, str(tmp_path), 0, 3)
    assert store.read_observations(spark, f"{tmp_path}/observations").count() == 3
    assert "readings" in seen[0] and not any("pages" in tables for tables in seen)


def test_waiting_pages_keep_their_bodies(spark, tmp_path):
    """Copies, a settled run's late page, pages that wait too long: what waits is what landed, and ends as one batch would."""
    registry = shops(spark)
    day = dt.timedelta(days=1)
    first = [
        page(1, 2, 1), page(1, 2, 1), page(2, 1, 2), page(3, 1, 3, at=START - 9 * day), page(4, 1, 1, "unknown"),
        page(5, 1, 3, at=START + day),
    ]
    second = [page(1, 1, 3), page(1, 1, 3), page(2, 2, 3), page(3, 2, 1, at=START + 2 * day)]
    for number, rows in enumerate([first, second]):
        page_stream.ingest_batch(spark.createDataFrame(rows, PAGES), registry, str(tmp_path), number, 3, wait_days=5.0)
    waiting = [spark.read.schema(PAGES).parquet(f"{tmp_path}/pending/batch={n}") for n in (0, 1)]
    assert rows_of(waiting[0]) == rows_of(spark.createDataFrame([first[0], first[1], first[5]], PAGES))
    assert rows_of(waiting[1]) == rows_of(spark.createDataFrame([second[3], first[5]], PAGES))
    assert {r.id: (r.ok, r.variants_seen) for r in page_stream.read_runs(spark, str(tmp_path)).collect()} == {
        1: (1, 4), 2: (1, 2), 3: (0, 0), 5: (0, 0)}
    readings = store.read_observations(spark, f"{tmp_path}/observations")
    assert sorted((r.run_id, r.variant_ext_id, r.price) for r in readings.collect()) == [
        (1, "0", 1.5), (1, "0", 1.5), (1, "1", 1.5), (1, "2", 1.5), (2, "0", 1.5), (2, "1", 1.5)]


def test_bodies_are_shuffled_once_where_runs_are_large(spark):
    pages = materialize(ingest.parsed(spark.createDataFrame([page(1, 1, 2), page(2, 1, 1), page(2, 1, 1)], PAGES)), "pages")
    registry = shops(spark)
    runs = materialize(ingest.derive_runs(ingest.page_facts(pages), registry, 3), "runs")
    plain, copied = ingest.decode_pages(pages, runs), runs.where("copied")
    assert rows_of(ingest.decode_pages(pages, runs, spark.createDataFrame(copied.collect(), copied.schema))) == rows_of(plain)
    many = runs.hint("merge")  # as the planner joins runs too many to broadcast
    plan = ingest.decode_pages(pages, many, materialize(copied, "copied"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == plan.count("BroadcastHashJoin") == 1


def test_readings_are_dealt_in_groups_of_days(spark, tables, tmp_path, monkeypatch):
    obs = tables.obs().withColumn("observed_at", F.expr("IF(id % 31 = 0, NULL, observed_at)"))
    days = {r[0]: r[1] for r in obs.groupBy(F.to_date("observed_at")).count().collect()}
    assert len(days) > 20 and None in days
    dealt, dynamic = [], store._dynamic
    monkeypatch.setattr(store, "DEALT_ROWS", sum(days.values()) // 5)
    monkeypatch.setattr(store, "_dynamic", lambda df, *rest: dealt.append(df.count()) or dynamic(df, *rest))
    path = str(tmp_path / "observations")
    for _ in range(2):  # the second time replaces the first
        store.append_observations(obs, path, "0")
    assert 3 <= len(dealt) / 2 <= 6 and sum(dealt) == 2 * obs.count()
    assert max(dealt) < store.DEALT_ROWS + max(days.values())
    want = store.evolve(store.typed_prices(obs), OBSERVATIONS)
    assert rows_of(store.read_observations(spark, path).select(OBSERVATIONS.names)) == rows_of(want)
    monkeypatch.setattr(store, "DEALT_ROWS", 1)  # a day each
    store.append_observations(obs, path, "0")
    assert rows_of(store.read_observations(spark, path).select(OBSERVATIONS.names)) == rows_of(want)
    assert store.read_observations(spark, path).where("obs_date IS NULL").count() == days[None]
