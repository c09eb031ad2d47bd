"""The plans are the ones meant: no cross joins, no Python, early reduction."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfpulse.operators import catalogue, ingest, retention
from shelfpulse.plans.fixtures import PAGE_PRODUCTS
from shelfpulse.plans.queries import QUERIES
from shelfpulse.session import materialize
from shelfpulse.sources import store

# Queries that only read back what they wrote; their result says nothing of the jobs before it.
WRITING = tuple(n for n in QUERIES if n.startswith(("stream_", "published_", "report_", "bucketed_")) or n.endswith("_stored")
                ) + ("snapshot_changes", "registry_json", "field_quality_maintained", "snapshot_counts_by_window")
CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITING])
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    for node in (*CROSS, *PYTHON):
        assert node not in plan


@pytest.mark.parametrize("name", ["latest_diff", "latest_per_variant", "catalogue_products", "catalogue_totals"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMALL))
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning(merchant")
    assert "WindowGroupLimit" in plan and "Final" in plan and partial > exchange


def test_latest_diff_shuffles_once(spark):
    assert plan_of(entry.queries()["latest_diff"](spark, SMALL)).count("Exchange") == 1


def test_history_shuffles_once(spark):
    assert plan_of(entry.queries()["change_history"](spark, SMALL)).count("Exchange") == 1


def test_top_changes_need_no_total_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["changes_newest"](spark, SMALL))


def test_tally_combines_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["field_tally"](spark, SMALL))
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "Expand" not in plan


def test_page_bodies_are_not_shuffled(spark, tables):
    pages = materialize(tables.pages(), "landed")
    facts = materialize(ingest.page_facts(pages), "facts")
    runs = materialize(ingest.derive_runs(facts, tables.registry(), PAGE_PRODUCTS), "runs")
    plan = plan_of(ingest.decode_pages(pages, runs))
    # Only pages of runs with copied pages are, to keep one of each.
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_retention_prunes_day_folders(spark, tables, tmp_path):
    path = str(tmp_path / "observations")
    store.append_observations(tables.obs(), path, "0")
    kept = retention.keep(store.read_observations(spark, path), "2024-01-31 00:00:00", 14)
    plan = plan_of(kept)
    assert "PartitionFilters: [isnotnull(obs_date" in plan and "(obs_date" in plan.split("PartitionFilters")[1]
    assert kept.count() == retention.keep(tables.obs(), "2024-01-31 00:00:00", 14).count()


def test_large_product_is_split_in_the_join(spark):
    """A product holding most variants does not end up in one join task."""
    names = [F.lit(None).cast("string").alias(c) for c in (
        "handle", "title", "variant_title", "vendor", "product_type", "sku", "price_raw", "compare_at_raw")]
    latest = spark.range(200_000).select(
        "id", F.lit("m").alias("merchant"), F.lit("USD").alias("currency"), F.lit(True).alias("available"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("product_ext_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("variant_ext_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("image_url"), *names,
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        latest = materialize(latest, "latest")
        rows = catalogue.variants(latest, materialize(catalogue.products(latest), "products"))
        rows.collect()
        assert "skew=true" in plan_of(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
