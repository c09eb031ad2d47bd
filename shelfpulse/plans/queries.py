"""One callable per registered query: (spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.functions import text
from shelfpulse.operators import catalogue, changes, constraints, ingest, quality, report, retention
from shelfpulse.plans.fixtures import PAGE_PRODUCTS, Tables
from shelfpulse.schemas import FIELDS, OBSERVATIONS, PAGES, RUNS
from shelfpulse.session import CODEC, delete_folder, freed_shuffles, materialize, new_folder
from shelfpulse.sources import registry as merchants
from shelfpulse.sources import maintained, snapshot, store
from shelfpulse.streaming import changes as change_stream
from shelfpulse.streaming import ingest as page_stream
from shelfpulse.streaming import landing
from shelfpulse.streaming import state as state_stream

# Fixed "now" of the given data, and the windows used with it.
OBS_NOW = "2024-01-31 00:00:00"
RUNS_NOW = "2001-01-01 00:00:00"
DAYS = 14
RUN_DAYS = 365
STATE_DAYS = 0.5
SERIES_BUCKETS = 8

JSON_TEXT = {"ignoreNullFields": "false", **snapshot.JSON_OPTIONS}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


# --- change detection -------------------------------------------------------

@query
def change_history(t: Tables) -> DataFrame:
    return changes.history(t.obs()).drop("id")


@query
def change_history_ties(t: Tables) -> DataFrame:
    return changes.history(t.obs_day())


@query
def change_history_sliced(t: Tables) -> DataFrame:
    """The same history with every longer series treated as hot and cut into slices."""
    return changes.history(t.obs(), max_rows=8).drop("id")


@query
def change_history_ties_sliced(t: Tables) -> DataFrame:
    return changes.history(t.obs_day(), max_rows=3)


@query
def latest_diff(t: Tables) -> DataFrame:
    return changes.latest_diff(t.obs())


@query
def latest_diff_counts(t: Tables) -> DataFrame:
    return changes.diff_counts(changes.latest_diff(t.obs()))


@query
def latest_diff_top12(t: Tables) -> DataFrame:
    return changes.diff_top(changes.latest_diff(t.obs()), 12)


@query
def latest_diff_remainder(t: Tables) -> DataFrame:
    return changes.diff_remainder(changes.latest_diff(t.obs()), 12)


@query
def changes_merged(t: Tables) -> DataFrame:
    return changes.merge(t.published_changes(), changes.history(t.obs()))


@query
def changes_newest(t: Tables) -> DataFrame:
    """The newest changes, as a view of all."""
    return changes.newest(changes.merge(t.published_changes(), changes.history(t.obs())))


@query
def changes_merged_ties(t: Tables) -> DataFrame:
    """Several fresh changes under one key: the last one stays."""
    fresh = changes.history(t.obs_day())
    return changes.merge(fresh.where("false").drop("id"), fresh)


@query
def change_merge_counts(t: Tables) -> DataFrame:
    return changes.merge_counts(t.published_changes(), changes.history(t.obs()))


# --- catalogue --------------------------------------------------------------

@query
def latest_per_variant(t: Tables) -> DataFrame:
    return catalogue.latest_readings(t.obs_day()).select(
        "id", "merchant", "variant_ext_id", "price_raw", "available", "observed_at"
    )


@query
def latest_per_variant_spread(t: Tables) -> DataFrame:
    """The same rows with every variant that has ties treated as hot."""
    return catalogue.latest_readings(t.obs_day(), max_rows=1).select(
        "id", "merchant", "variant_ext_id", "price_raw", "available", "observed_at"
    )


@query
def catalogue_products(t: Tables) -> DataFrame:
    return catalogue.products(catalogue.latest_readings(t.obs()))


@query
def catalogue_variants(t: Tables) -> DataFrame:
    return catalogue.variants(*catalogue.folded(t.obs())).drop("id")


@query
def catalogue_documents(t: Tables) -> DataFrame:
    """The nested catalogue, unfolded again with each variant's place in its product."""
    nested = catalogue.documents(*catalogue.folded(t.obs()))
    return nested.select(
        "m", "p", "part", "h", "t", "vendor", "type", F.col("img").alias("product_img"), "cur",
        F.posexplode("variants").alias("place", "variant"),
    ).select("m", "p", "part", "h", "t", "vendor", "type", "product_img", "cur", "place", "variant.*")


@query
def catalogue_document_parts(t: Tables) -> DataFrame:
    """Nested products of at most about two variants per row, unfolded again."""
    nested = catalogue.documents(*catalogue.folded(t.obs()), max_variants=2)
    return nested.select("m", "p", "h", "t", F.explode("variants").alias("variant")).select(
        "m", "p", "h", "t", "variant.*"
    )


@query
def catalogue_totals(t: Tables) -> DataFrame:
    return catalogue.totals(catalogue.latest_readings(t.obs()))


@query
def freshness(t: Tables) -> DataFrame:
    return report.freshness(t.runs())


# --- field quality ----------------------------------------------------------

@query
def grade_rows(t: Tables) -> DataFrame:
    return quality.grade(t.obs()).select("id", *[f"{f}_status" for f in FIELDS])


@query
def field_tally(t: Tables) -> DataFrame:
    return quality.tally(t.obs())


@query
def run_tally_summary(t: Tables) -> DataFrame:
    return quality.run_summary(quality.tally(t.obs()))


@query
def field_quality_all(t: Tables) -> DataFrame:
    return quality.field_quality(quality.tally(t.obs()))


@query
def field_quality_window(t: Tables) -> DataFrame:
    return quality.field_quality_window(quality.tally(t.obs()), t.evruns(), OBS_NOW, DAYS)


@query
def worst_field(t: Tables) -> DataFrame:
    return quality.worst_field(quality.field_quality(quality.tally(t.obs())))


@query
def worst_field_per_run(t: Tables) -> DataFrame:
    return quality.worst_field(quality.run_summary(quality.tally(t.obs())), "run_id", "merchant")


@query
def not_ok_by_field(t: Tables) -> DataFrame:
    return quality.in_order(quality.not_ok(quality.tally(t.obs())), F.desc("n"), F.asc("field"))


@query
def regrade_outcomes(t: Tables) -> DataFrame:
    return quality.regrade(t.oldout(), t.obs(), t.evruns())


@query
def regrade_delta(t: Tables) -> DataFrame:
    before = t.oldout()
    delta = quality.grade_delta(before, quality.regrade(before, t.obs(), t.evruns()))
    return quality.in_order(delta, F.asc("field"))


@query
def regraded_runs(t: Tables) -> DataFrame:
    return quality.regraded_runs(t.obs(), t.evruns())


@query
def constraint_violations(t: Tables) -> DataFrame:
    """Against the successful runs only, so that rows of failed runs have no run; some readings come
    twice, and some without their variant."""
    obs = t.obs()
    lost = F.when(F.col("id") % 500 != 0, F.col("variant_ext_id")).alias("variant_ext_id")
    readings = obs.unionByName(obs.where(F.col("id") % 700 == 0)).withColumn("variant_ext_id", lost)
    return constraints.violations(t.evruns().where("ok = 1"), t.oldout(), readings)


# --- operating record -------------------------------------------------------

@query
def run_reliability(t: Tables) -> DataFrame:
    return report.reliability(t.runs())


@query
def run_reliability_window(t: Tables) -> DataFrame:
    return report.reliability(report.recent_runs(t.runs(), RUNS_NOW, RUN_DAYS))


@query
def run_reliability_all(t: Tables) -> DataFrame:
    rows = report.reliability_with_total(t.runs())
    return rows.withColumn("ok_text", text.percent_text(F.col("ok_rate")))


@query
def cost_per_parse(t: Tables) -> DataFrame:
    return report.cost_per_parse(t.runs())


@query
def snapshot_counts(t: Tables) -> DataFrame:
    return report.snapshot_counts(t.obs_day())


@query
def cycle_summary(t: Tables) -> DataFrame:
    return report.cycle_summary(t.runs())


@query
def redacted_reliability(t: Tables) -> DataFrame:
    runs = t.runs()
    return report.redact(report.reliability_with_total(runs), report.merchant_labels(runs))


@query
def redacted_changes(t: Tables) -> DataFrame:
    return report.redact(changes.latest_diff(t.obs()), report.merchant_labels(t.obs()))


@query
def report_json(t: Tables) -> DataFrame:
    """The machine-readable report: one JSON text per row of each section."""
    tallied = quality.tally(t.obs())
    sections = snapshot.report_sections(t.runs(), tallied, t.obs(), RUNS_NOW, RUN_DAYS)
    sections["fields"] = quality.field_quality_window(tallied, t.evruns(), OBS_NOW, DAYS)
    lines = [
        section.select(
            F.lit(name).alias("section"), "merchant",
            F.to_json(F.struct(*section.columns), JSON_TEXT).alias("line"),
        )
        for name, section in sections.items()
    ]
    joined = lines[0]
    for line in lines[1:]:
        joined = joined.unionByName(line)
    return joined


# --- retention and stored tables --------------------------------------------

@query
def prune_plan(t: Tables) -> DataFrame:
    return retention.plan(t.obs(), OBS_NOW, DAYS)


@query
def prune_keep(t: Tables) -> DataFrame:
    return retention.keep(t.obs(), OBS_NOW, DAYS)


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


STORED = [
    "id", "run_id", "merchant", "product_ext_id", "variant_ext_id", "title", "price_raw", "price",
    "compare_at_raw", "compare_at_price", "available", "image_url", "observed_at",
]


@query
def prune_stored(t: Tables) -> DataFrame:
    """Readings written to the store, pruned there and read back."""
    folder = new_folder(t.spark, "store")
    store.append_observations(t.obs(), folder, "0")
    store.prune_store(t.spark, folder, OBS_NOW, DAYS)
    return _ntz(store.read_observations(t.spark, folder).select(STORED), "observed_at")


@query
def evolve_schema(t: Tables) -> DataFrame:
    """Readings written before images were kept, read with today's columns."""
    older = t.obs().drop("image_url")
    rows = store.typed_prices(older)
    return _ntz(store.evolve(rows, OBSERVATIONS).select(STORED), "observed_at")


@query
def regrade_stored(t: Tables) -> DataFrame:
    """Outcomes written to the store and re-graded there."""
    folder = new_folder(t.spark, "outcomes")
    runs = t.evruns()
    store.upsert_outcomes(t.spark, folder, t.oldout(), runs)
    store.regrade_store(t.spark, folder, t.obs(), runs)
    return store.read_outcomes(t.spark, folder).drop(store.RUN_DAY)


def _published(t: Tables) -> str:
    """A publication made twice over the same readings, anew for each query that reads it back."""
    folder, runs, tallied = new_folder(t.spark, "public"), store.evolve(t.evruns(), RUNS), quality.tally(t.obs())
    for _ in range(2):
        snapshot.publish(folder, t.registry(), runs, tallied, t.obs())
    return snapshot.current(t.spark, folder)


def _read_back(t: Tables, section: str, like: DataFrame) -> DataFrame:
    return t.spark.read.schema(like.schema).options(**snapshot.JSON_OPTIONS).json(f"{_published(t)}/{section}")


@query
def snapshot_changes(t: Tables) -> DataFrame:
    """Changes published as JSON twice over the same readings: the second time adds nothing."""
    return _ntz(snapshot.read_published_changes(t.spark, f"{_published(t)}/snapshot/changes"), "at")


@query
def published_runs(t: Tables) -> DataFrame:
    """The operating record as published: every run with its fourteen columns."""
    like = store.evolve(t.evruns(), RUNS).select(*snapshot.RUN_COLUMNS)
    return _ntz(_read_back(t, "snapshot/runs", like), "started_at", "finished_at")


@query
def published_fields(t: Tables) -> DataFrame:
    return _read_back(t, "snapshot/fields", quality.field_quality(quality.tally(t.obs())))


@query
def published_merchants(t: Tables) -> DataFrame:
    return _read_back(t, "snapshot/merchants", merchants.published(t.registry()))


@query
def published_totals(t: Tables) -> DataFrame:
    return _read_back(t, "snapshot/totals", catalogue.totals(catalogue.latest_readings(t.obs())))


@query
def published_catalogue(t: Tables) -> DataFrame:
    """The nested catalogue read back from its files, unfolded again."""
    documents = _read_back(t, "catalogue/products", catalogue.documents(*catalogue.folded(t.obs())))
    return documents.select(
        "m", "p", "part", "h", "t", "vendor", "type", F.col("img").alias("product_img"), "cur",
        F.posexplode("variants").alias("place", "variant"),
    ).select("m", "p", "part", "h", "t", "vendor", "type", "product_img", "cur", "place", "variant.*")


@query
def registry_json(t: Tables) -> DataFrame:
    """The registry landed as JSON lines, from all partitions, and read as a collector would."""
    path = f"{new_folder(t.spark, 'registry')}/merchants"
    rows = t.registry()
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(path)
    return merchants.published(merchants.enabled(merchants.read_registry(t.spark, path)))


@query
def report_written(t: Tables) -> DataFrame:
    """The report's snapshot section as written, with the merchants' names replaced."""
    folder = new_folder(t.spark, "report")
    sections = {"snapshots": report.snapshot_counts(t.obs_day())}
    snapshot.write_report(folder, sections, report.merchant_labels(t.obs()))
    return t.spark.read.schema(sections["snapshots"].schema).json(f"{folder}/snapshots")


# --- collection -------------------------------------------------------------

@query
def merchant_registry(t: Tables) -> DataFrame:
    return merchants.published(merchants.enabled(t.registry()))


@query
def one_merchant(t: Tables) -> DataFrame:
    return merchants.enabled(t.registry(), only="shop-3").select("slug", "currency", "method")


@query
def page_facts(t: Tables) -> DataFrame:
    return ingest.page_facts(t.pages()).select("run_id", "page", "n_products", "n_variants", "error")


def _accounted(t: Tables) -> tuple[DataFrame, DataFrame]:
    pages = materialize(ingest.parsed(t.pages()), "landed")
    facts = materialize(ingest.page_facts(pages), "page-facts")
    return pages, ingest.derive_runs(facts, t.registry(), PAGE_PRODUCTS, starts=t.starts())


def _decoded(t: Tables) -> DataFrame:
    pages, runs = _accounted(t)
    return ingest.decode_pages(pages, materialize(runs, "runs"))


@query
def run_accounting(t: Tables) -> DataFrame:
    return _accounted(t)[1].drop("currency", "copied")


@query
def run_failures(t: Tables) -> DataFrame:
    return report.failures(_accounted(t)[1])


@query
def feed_decode(t: Tables) -> DataFrame:
    return _decoded(t).drop("id")


@query
def feed_grades(t: Tables) -> DataFrame:
    """Grades at collection time, where the feed's own value types still count."""
    return quality.tally(_decoded(t))


# --- streaming --------------------------------------------------------------

# The pages that land are built in so many parts, to hold the shuffle files of one part at a time.
LANDED_PARTS = 4


def _taken_in(t: Tables, name: str, wave: Column) -> str:
    """The folder of a store that took in the landed pages wave by wave, in ascending order of `wave`.

    Each wave's pages are built when they land, so no other copy of them lies beside; all go when all are taken in."""
    spark, folder, registry = t.spark, new_folder(t.spark, name), t.registry()
    for number in (0, 1):
        for part in range(LANDED_PARTS):
            landing = store.evolve(t.pages(part, LANDED_PARTS), PAGES).where(wave == number)
            with freed_shuffles(spark):
                landing.write.mode("append").options(**CODEC).parquet(f"{folder}/landing")
        page_stream.start_ingest(
            spark, f"{folder}/landing", registry, f"{folder}/store", f"{folder}/checkpoint",
            PAGE_PRODUCTS, starts=t.starts(),
        ).awaitTermination()
    delete_folder(spark, f"{folder}/landing")
    return f"{folder}/store"


def _readings_taken_in(t: Tables, folder: str) -> DataFrame:
    stored = store.read_observations(t.spark, f"{folder}/observations").select(STORED)
    return _ntz(stored, "observed_at").drop("id")


@query
def stream_ingest(t: Tables) -> DataFrame:
    """Pages landing in two waves, taken in as they come."""
    return _readings_taken_in(t, _taken_in(t, "stream-ingest", F.col("run_id") % 2))


@query
def stream_ingest_split(t: Tables) -> DataFrame:
    """The pages of each run land in two waves, every other page first."""
    return _readings_taken_in(t, _taken_in(t, "stream-split", F.col("page") % 2))


@query
def stream_runs_split(t: Tables) -> DataFrame:
    """One record per run, whatever the waves its pages came in."""
    runs = page_stream.read_runs(t.spark, _taken_in(t, "stream-runs", F.col("page") % 2))
    return _ntz(runs, "started_at", "finished_at")


@query
def stream_regrade(t: Tables) -> DataFrame:
    """Outcomes the stream stored, kept through a prune of the readings; those of runs with readings left are spoilt first,
    so that only a re-grading gives them back."""
    folder = _taken_in(t, "stream-regrade", F.col("page") % 2)
    store.prune_store(t.spark, f"{folder}/observations", "2024-02-15 00:50:00", DAYS)
    left, runs = store.read_observations(t.spark, f"{folder}/observations"), page_stream.read_runs(t.spark, folder)
    outcomes = materialize(page_stream.read_outcomes(t.spark, folder).drop(store.RUN_DAY), "outcomes")
    spoilt = outcomes.join(left.select("run_id").distinct(), "run_id", "left_semi").withColumn("count", F.col("count") + 1)
    store.upsert_outcomes(t.spark, f"{folder}/field_outcomes", spoilt, runs)
    store.regrade_store(t.spark, f"{folder}/field_outcomes", left, runs)
    return page_stream.read_outcomes(t.spark, folder).drop(store.RUN_DAY)


def _detected(t: Tables, name: str, steps: list[Column], prune: bool = False) -> DataFrame:
    """Changes detected after each of `steps` of the readings is stored, with a prune before the last."""
    spark, folder = t.spark, new_folder(t.spark, name)
    readings, path, boundary = t.obs(), f"{folder}/observations", f"{folder}/boundary"
    for number, step in enumerate(steps):
        if prune and number == len(steps) - 1:
            store.prune_store(spark, path, OBS_NOW, DAYS, boundary=boundary)
        store.append_observations(readings.where(step), path, str(number))
        change_stream.start_changes(
            spark, path, f"{folder}/detected", f"{folder}/checkpoint", boundary=boundary
        ).awaitTermination()
    return _ntz(change_stream.read_changes(spark, f"{folder}/detected"), "at").drop("id")


@query
def stream_changes(t: Tables) -> DataFrame:
    """Readings stored in three steps, changes detected after each."""
    day = F.dayofmonth("observed_at")
    return _detected(t, "stream-changes", [day <= 12, (day > 12) & (day <= 22), day > 22])


def _with_late() -> list[Column]:
    """Two steps without, and then a third of the readings of five days."""
    day = F.dayofmonth("observed_at")
    late = day.between(20, 24) & (F.col("id") % 3 == 0)
    return [(day <= 12) & ~late, (day > 12) & ~late, late]


@query
def stream_changes_late(t: Tables) -> DataFrame:
    """A third of the readings of five days comes after all later ones."""
    return _detected(t, "stream-late", _with_late())


@query
def stream_changes_late_pruned(t: Tables) -> DataFrame:
    """The same after readings of more than two weeks were deleted: recorded changes stay."""
    return _detected(t, "stream-late-pruned", _with_late(), prune=True)


def _in_steps() -> list[Column]:
    day = F.dayofmonth("observed_at")
    return [day <= 12, (day > 12) & (day <= 22), day > 22]


def _by_state(t: Tables, name: str, steps: list[Column], keep_days: float | None = None) -> str:
    """The folder of a detection by state, started anew after each of `steps` of the readings is stored."""
    folder, readings = new_folder(t.spark, name), t.obs()
    for number, step in enumerate(steps):
        store.append_observations(readings.where(step), f"{folder}/observations", str(number))
        state_stream.start_state_changes(
            t.spark, f"{folder}/observations", f"{folder}/detected", f"{folder}/checkpoint", keep_days
        ).awaitTermination()
    return f"{folder}/detected"


@query
def stream_state_changes(t: Tables) -> DataFrame:
    """Readings stored in three steps, changes detected by the state of each variant, restarted between them."""
    found = state_stream.read_state_changes(t.spark, _by_state(t, "state-changes", _in_steps()))
    return _ntz(found, "at").drop("id")


@query
def stream_state_changes_kept(t: Tables) -> DataFrame:
    """The same with states kept for half a day: a longer pause starts a variant afresh."""
    found = state_stream.read_state_changes(t.spark, _by_state(t, "state-kept", _in_steps(), STATE_DAYS))
    return _ntz(found, "at").drop("id")


@query
def stream_state_late(t: Tables) -> DataFrame:
    """Readings that come after a later one of their variant are told apart."""
    late = state_stream.read_late(t.spark, _by_state(t, "state-late", _with_late()))
    return _ntz(late, "observed_at")


@query
def stream_changes_compacted(t: Tables) -> DataFrame:
    """Changes detected around a compaction of all days: the second step brings no reading twice."""
    spark, folder, readings = t.spark, new_folder(t.spark, "stream-compacted"), t.obs()
    path, odd = f"{folder}/observations", F.col("id") % 2 == 1
    days = [row[0] for row in readings.select(F.to_date("observed_at").cast("string")).distinct().collect()]  # at most a month
    early = F.dayofmonth("observed_at") <= 3
    for number, step in enumerate([early & odd, early & ~odd, ~early]):
        store.append_observations(readings.where(step), path, str(number))
        if number == 1:
            store.compact(spark, path, *days)
        change_stream.start_changes(spark, path, f"{folder}/detected", f"{folder}/checkpoint").awaitTermination()
    return _ntz(change_stream.read_changes(spark, f"{folder}/detected"), "at").drop("id")


@query
def compact_stored(t: Tables) -> DataFrame:
    """Readings stored in three batches, every day compacted into one, read back with the batches that are left."""
    folder = new_folder(t.spark, "compacted")
    for part in range(3):
        store.append_observations(t.obs().where(F.col("id") % 3 == part), folder, str(part))
    days = [row[0] for row in store.read_observations(t.spark, folder).select(
        F.col(store.OBSERVED_DAY).cast("string")).distinct().collect()]  # one for each day folder
    store.compact(t.spark, folder, *days)
    rows = store.read_observations(t.spark, folder)
    per_day = rows.groupBy(store.OBSERVED_DAY).agg(F.count_distinct(store.BATCH).alias("batches"))
    return _ntz(rows.join(per_day, store.OBSERVED_DAY).select(*STORED, "batches"), "observed_at")


# Pages fetched this long before the newest one of earlier waves are late.
PAGE_DELAY = "3 minutes"


def _landed_twice(t: Tables) -> tuple[str, str]:
    """Landing and output folder of pages that land in two waves, the second with all of the first again."""
    folder = new_folder(t.spark, "landed-twice")
    pages = materialize(store.evolve(t.pages(), PAGES), "landed")
    for wave in (F.col("page") % 5 != 0, F.lit(True)):
        pages.where(wave).unionByName(pages.where(wave & (F.col("page") == 1))).write.mode("append").parquet(f"{folder}/landing")
        landing.start_deduplicated(
            t.spark, f"{folder}/landing", f"{folder}/once", f"{folder}/checkpoint", PAGE_DELAY).awaitTermination()
    return f"{folder}/landing", f"{folder}/once"


@query
def stream_deduplicated(t: Tables) -> DataFrame:
    """Pages that landed several times, in one wave or two, let through once; late ones not."""
    rows = t.spark.read.schema(PAGES).parquet(_landed_twice(t)[1])
    return _ntz(rows.select(*landing.PAGE_KEY, "http_status", "fetched_at", F.octet_length("body").alias("n_bytes")), "fetched_at")


@query
def stream_late_pages(t: Tables) -> DataFrame:
    """Pages that came too late to be told from copies."""
    return landing.late_pages(t.spark, *_landed_twice(t))


# --- orders, read back from what was written ----------------------------------

def _places(t: Tables, section: str, like: DataFrame) -> DataFrame:
    return snapshot.in_file_order(t.spark, f"{_published(t)}/{section}", like.schema)


@query
def published_runs_in_order(t: Tables) -> DataFrame:
    """Runs by their start, as published."""
    rows = _places(t, "snapshot/runs", store.evolve(t.evruns(), RUNS).select(*snapshot.RUN_COLUMNS))
    return _ntz(rows.select("id", "merchant", "started_at", "place"), "started_at")


@query
def published_fields_in_order(t: Tables) -> DataFrame:
    """Fields by merchant, the least reliable first, as published."""
    return _places(t, "snapshot/fields", quality.field_quality(quality.tally(t.obs()))).select("merchant", "field", "rate", "place")


@query
def published_changes_in_order(t: Tables) -> DataFrame:
    """Changes, the newest first, as published."""
    short = [F.col(c).alias(snapshot.CHANGE_NAMES.get(c, c)) for c in ("at", "merchant", "variant_ext_id", "kind")]
    rows = _places(t, "snapshot/changes", _ntz(changes.history(t.obs()), "at").select(
        F.col("at").cast("timestamp").alias("at"), *short[1:]))
    return _ntz(rows, "at")


@query
def run_fields_in_order(t: Tables) -> DataFrame:
    """The fields of each run, the least reliable first."""
    return quality.run_summary_in_order(quality.tally(t.obs()))


def _report(t: Tables, section: str) -> DataFrame:
    """A section of the written report with its rows' places, merchants' names replaced."""
    folder, runs, tallied = new_folder(t.spark, "report"), t.runs(), quality.tally(t.obs())
    sections = snapshot.report_sections(runs, tallied, t.obs(), RUNS_NOW, RUN_DAYS)
    sections["fields"] = quality.field_quality_window(tallied, t.evruns(), OBS_NOW, DAYS)
    names = t.obs().select("merchant").unionByName(runs.select("merchant"))
    snapshot.write_report(folder, sections, report.merchant_labels(names))
    return snapshot.in_file_order(t.spark, f"{folder}/{section}", sections[section].schema)


@query
def report_reliability_written(t: Tables) -> DataFrame:
    return _report(t, "reliability")


@query
def report_fields_written(t: Tables) -> DataFrame:
    return _report(t, "fields")


@query
def report_changes_written(t: Tables) -> DataFrame:
    return _report(t, "changes")


@query
def report_snapshots_written(t: Tables) -> DataFrame:
    return _report(t, "snapshots")


# --- figures kept up to date ----------------------------------------------------

@query
def snapshot_counts_by_window(t: Tables) -> DataFrame:
    """Snapshots of the last week, the last two and all time, from bitmaps stored batch by batch."""
    folder, readings = new_folder(t.spark, "bitmaps"), t.obs_day()
    for part in range(3):
        maintained.record_snapshots(readings.where(F.col("id") % 3 == part), folder, str(part))
    now = F.lit(OBS_NOW).cast("date")
    windows = [maintained.snapshot_counts(t.spark, folder, None if days is None else F.date_sub(now, days)).withColumn(
        "days", F.lit(days).cast("int")) for days in (7, DAYS, None)]
    return windows[0].unionByName(windows[1]).unionByName(windows[2])


@query
def field_quality_maintained(t: Tables) -> DataFrame:
    """Sums kept through two batches, the first graded wrongly, a prune of the readings and a re-grade."""
    spark, folder = t.spark, new_folder(t.spark, "maintained")
    sums, outcomes, path, runs = f"{folder}/sums", f"{folder}/outcomes", f"{folder}/observations", t.evruns().withColumn("ok", F.lit(1))
    even = F.col("run_id") % 2 == 0
    for step, part in enumerate((even, ~even)):
        store.append_observations(t.obs().where(part), path, str(step))
        graded = quality.tally(t.obs().where(part))
        wrong = graded.withColumn("count", F.col("count") + 3) if step == 0 else graded
        store.upsert_outcomes(spark, outcomes, wrong, runs)
        maintained.record_outcomes(wrong, sums, f"batch-{step}")
    before = store.read_outcomes(spark, outcomes).where(even)
    again = quality.tally(store.read_observations(spark, path).where(even))
    maintained.record_outcomes(again, sums, "regrade", before)
    store.prune_store(spark, path, OBS_NOW, DAYS)
    return maintained.field_quality(spark, sums)


# --- readings bucketed by series --------------------------------------------------

def _series(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "series")
    return store.save_series(t.obs(), folder.rpartition("/")[2].replace("-", "_"), folder, SERIES_BUCKETS)


@query
def bucketed_history(t: Tables) -> DataFrame:
    return _ntz(changes.history(_series(t)), "at").drop("id")


@query
def bucketed_latest_diff(t: Tables) -> DataFrame:
    return changes.latest_diff(_series(t))


@query
def bucketed_latest(t: Tables) -> DataFrame:
    return _ntz(catalogue.latest_readings(_series(t)).select(STORED), "observed_at")


# --- files of another age, files of a few runs -----------------------------------

@query
def evolve_stored(t: Tables) -> DataFrame:
    """Files written before images were kept, next to files of today, read as one table."""
    folder, readings = new_folder(t.spark, "evolved"), t.obs()
    older = store.typed_prices(readings.where(F.col("id") % 2 == 0)).select(
        *[c for c in OBSERVATIONS.names if c in readings.columns and c != "image_url"], "price", "compare_at_price",
        F.to_date("observed_at").alias(store.OBSERVED_DAY), F.lit("old").alias(store.BATCH))
    older.write.partitionBy(store.OBSERVED_DAY, store.BATCH).parquet(folder)
    store.append_observations(readings.where(F.col("id") % 2 == 1), folder, "new")
    return _ntz(store.read_observations(t.spark, folder).select(STORED), "observed_at")


@query
def regrade_few_stored(t: Tables) -> DataFrame:
    """Outcomes of every seventh run re-graded from the files that hold its readings; all others as they were."""
    folder, runs = new_folder(t.spark, "regrade-few"), t.evruns()
    store.append_observations(t.obs(), f"{folder}/observations", "0")
    store.upsert_outcomes(t.spark, f"{folder}/outcomes", t.oldout(), runs)
    store.regrade_runs(t.spark, f"{folder}/outcomes", f"{folder}/observations", runs.where(F.col("id") % 7 == 0))
    return store.read_outcomes(t.spark, f"{folder}/outcomes").drop(store.RUN_DAY)
