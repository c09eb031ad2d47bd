"""Hot keys are split, and the split never shows in the result."""

import random

import pytest
from pyspark.sql import functions as F

from shelfpulse.operators import catalogue, changes, skew

SCHEMA = (
    "id bigint, run_id bigint, merchant string, product_ext_id string, variant_ext_id string,"
    " handle string, title string, variant_title string, vendor string, product_type string, sku string,"
    " price_raw string, compare_at_raw string, currency string, available boolean, image_url string,"
    " observed_at timestamp_ntz"
)


def readings(spark, seed):
    """A third of all rows under one variant, a third of those at one moment."""
    import datetime as dt

    rng, start = random.Random(seed), dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1500):
        hot = rng.random() < 0.4
        merchant, variant = ("m0", "v0") if hot else (f"m{rng.randrange(3)}", f"v{rng.randrange(60)}")
        minute = 5000 if hot and rng.random() < 0.35 else rng.randrange(10_000)
        rows.append((
            rng.randrange(10**6) * 2000 + i, i % 7, merchant, f"p{int(variant[1:]) % 4}", variant, "h",
            rng.choice(["A", "B", None]), rng.choice(["x", "y"]), "", "t", "s",
            rng.choice(["1", "1.0", "2", "abc", "", None]), rng.choice([None, "0", "9"]), "USD",
            rng.choice([True, False, None]), rng.choice([None, "", "i1", "i2"]),
            start + dt.timedelta(minutes=minute),
        ))
    return spark.createDataFrame(rows, SCHEMA), rows


def brute_history(rows):
    def key(raw):
        if raw is None:
            return None
        try:
            return float(raw)
        except ValueError:
            return raw

    series, found = {}, []
    for r in sorted(rows, key=lambda r: (r[2], r[4], r[16], r[0])):
        before = series.get((r[2], r[4]))
        now = (key(r[11]), r[14])
        if before and before[0] is not None:
            if before[0] != now[0]:
                found.append((r[0], "price"))
            if before[1] != now[1]:
                found.append((r[0], "stock"))
        series[(r[2], r[4])] = now
    return sorted(found)


@pytest.mark.parametrize(("seed", "max_rows"), [(1, 10), (2, 37), (3, 100), (4, 10_000)])
def test_history_with_hot_variant(spark, seed, max_rows):
    df, rows = readings(spark, seed)
    got = changes.history(df, max_rows).select("id", "kind").collect()
    assert sorted((r.id, r.kind) for r in got) == brute_history(rows)


@pytest.mark.parametrize("max_rows", [10, 50])
def test_hot_variant_is_really_split(spark, max_rows):
    df, _ = readings(spark, 5)
    order = ("observed_at", "id")
    parts = skew.sliced(df, changes.SERIES_KEY, order, max_rows).where("slice IS NOT NULL").groupBy(*changes.SERIES_KEY, "slice").count()
    largest = parts.agg(F.max("count")).first()[0]
    whole = df.groupBy(*changes.SERIES_KEY).count().agg(F.max("count")).first()[0]
    assert whole > 500 and largest <= 4 * max_rows


@pytest.mark.parametrize("spread", [1, 60])
def test_rows_clustered_in_time_are_split(spark, spread):
    """All but one of a key's rows within a minute, or at one moment, decades after the first."""
    rows = spark.range(60_000).select(
        "id", F.lit("m").alias("merchant"), F.lit("v").alias("variant_ext_id"),
        F.when(F.col("id") == 0, F.lit(0)).otherwise(10**15 + F.col("id") % (spread * 1_000)).alias("micros"),
    ).select("*", F.timestamp_micros("micros").alias("observed_at"))
    order = ("observed_at", "id")
    parts = skew.sliced(rows, changes.SERIES_KEY, order, 600).groupBy("slice").count().collect()
    assert max(r["count"] for r in parts) <= 4 * 600 and len(parts) > 60


def test_summary_of_a_hot_key_has_a_fixed_size(spark):
    """Ten million rows under one key: slices of at most twice the threshold, from arrays that do not grow with the key."""
    rows = spark.range(10_000_000).select(
        F.pmod(F.xxhash64("id"), F.lit(10**12)).alias("at"), "id", F.lit("m").alias("merchant"), F.lit("v").alias("variant_ext_id"))
    cut = skew.sliced(rows, changes.SERIES_KEY, ("at", "id"), 100_000)
    found = cut.groupBy("slice").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).orderBy("slice").collect()
    assert max(r.n for r in found) <= 2 * 100_000 and sum(r.n for r in found) == 10_000_000
    assert all(a.high <= b.low for a, b in zip(found, found[1:]))


def test_cuts_stay_few_and_slices_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(skew, "CELLS", 64)
    monkeypatch.setattr(skew, "MOST_CUTS", 3)
    rows = spark.range(20_000).select("id", (F.col("id") * 7919 % 20_011).alias("at"), F.lit("m").alias("merchant"), F.lit("v").alias("variant_ext_id"))
    cuts = skew.cut_points(rows, changes.SERIES_KEY, ("at", "id"), 500).first().cuts
    assert len(cuts) == 3
    found = skew.sliced(rows, changes.SERIES_KEY, ("at", "id"), 500).groupBy("slice").agg(
        F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).orderBy("slice").collect()
    assert max(r.n for r in found) <= 2 * 500 and len(found) > 20 and max(len(r.slice) for r in found) > 2
    assert all(a.high < b.low for a, b in zip(found, found[1:]))


@pytest.mark.parametrize("max_rows", [5, 40, 10_000])
def test_latest_with_hot_ties(spark, max_rows):
    df, rows = readings(spark, 6)
    df = df.withColumn("observed_at", F.date_trunc("day", "observed_at").cast("timestamp_ntz"))
    newest = {}
    for r in rows:
        day = r[16].date()
        newest[(r[2], r[4])] = max(day, newest.get((r[2], r[4]), day))
    expected = sorted(r[0] for r in rows if r[16].date() == newest[(r[2], r[4])])
    assert sorted(r.id for r in catalogue.latest_readings(df, max_rows).collect()) == expected


def test_sampling_only_steers_balance(spark):
    """A threshold above the sample size measures on a sample and changes nothing."""
    rows = spark.range(60_000).select(
        F.col("id"), F.lit("m").alias("merchant"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("variant_ext_id"),
        F.timestamp_micros(F.col("id") * 1000).alias("observed_at"), (F.col("id") * 7).alias("n"),
    )
    hot = skew.hot_groups(rows, ["merchant", "variant_ext_id"], 4_000)
    assert [r.variant_ext_id for r in hot.collect()] == ["hot"]
    linked = skew.with_previous(rows, ["merchant", "variant_ext_id"], "observed_at", "id", ["n"], 4_000)
    bad = linked.where(
        (F.col("variant_ext_id") == "hot") & (F.col("id") > 0) & ~F.col("prev_n").eqNullSafe(F.col("n") - 21)
    )
    assert linked.count() == 60_000 and bad.count() == 0


@pytest.mark.parametrize("max_variants", [3, 7, 1000])
def test_documents_in_parts(spark, max_variants):
    df, _ = readings(spark, 7)
    latest, product_rows = catalogue.folded(df)
    docs = catalogue.documents(latest, product_rows, max_variants)
    flat = docs.select("m", "p", F.explode("variants").alias("v")).select("m", "p", "v.*")
    expected = catalogue.variants(latest, product_rows).select(
        F.col("merchant").alias("m"), F.col("product_ext_id").alias("p"),
        F.col("variant_ext_id").alias("v"), F.col("variant_title").alias("vt"),
        "sku", "price", "price_text", "was", "was_text", "avail", "img",
    )
    assert flat.exceptAll(expected).isEmpty() and expected.exceptAll(flat).isEmpty()
    assert docs.where(F.size("variants") == 0).isEmpty()
    entry = F.struct("title", "variant_title", "variant_ext_id", "id")
    whole_order = latest.groupBy(F.col("merchant").alias("m"), F.col("product_ext_id").alias("p")).agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["variant_ext_id"]).alias("v")).collect()
    assert docs.agg(F.max(F.size("variants"))).first()[0] <= 2 * max_variants
    for product in docs.groupBy("m", "p").agg(F.sort_array(F.collect_list(F.struct("part", "variants"))).alias("d")).collect():
        assert [e.part for e in product.d] == list(range(len(product.d)))
        unfolded = [v.v for e in product.d for v in e.variants]
        whole = {(r.m, r.p): r.v for r in whole_order}
        assert unfolded == whole[product.m, product.p]
    parts = docs.groupBy("m", "p").count().agg(F.max("count")).first()[0]
    assert (parts == 1) == (max_variants == 1000)
