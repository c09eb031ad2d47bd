"""Places in a total order, without a task that sees all rows."""

import pytest
from pyspark.sql import functions as F

from shelfpulse.operators import ingest, ranking, report
from shelfpulse.session import materialize


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_places(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = spark.range(1000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") * 31 % 17).alias("a"), F.lit(1).alias("range"))
        placed = ranking.placed(rows, F.desc_nulls_first("a"), F.asc("id"))
        got = [(r.place, r.id) for r in placed.orderBy("place").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = sorted(rows.collect(), key=lambda r: (r.a is not None, -(r.a or 0), r.id))
    assert got == [(n + 1, r.id) for n, r in enumerate(want)] and placed.columns == ["id", "a", "range", "place"]
    assert ranking.placed(rows.where("false"), "id").collect() == []


def test_no_single_task(spark, tables):
    names = tables.obs().select("merchant").distinct()
    for plan in (plan_of(ranking.in_ranges(names, ["merchant"])), plan_of(report.redact(tables.obs(), report.merchant_labels(tables.obs())))):
        assert "SinglePartition" not in plan and "Window" not in plan


def test_bodies_are_parsed_once(spark, tables):
    typed = ingest.parsed(materialize(tables.pages(), "landed"))
    parses = lambda df: plan_of(df).lower().replace("_", "").count("parsejson")
    assert parses(typed.select("feed")) == 1
    pages = materialize(typed, "pages")
    facts = ingest.page_facts(pages)
    runs = materialize(ingest.derive_runs(facts, tables.registry()), "runs")
    for later in (facts, ingest.decode_pages(pages, runs)):
        for column in later.columns:
            assert parses(later.select(column)) == 0
    assert dict(pages.dtypes)["feed"] == "variant"
