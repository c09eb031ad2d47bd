"""Change detection by state: restarts, expiry, late readings, batches of any size."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfpulse.operators import changes
from shelfpulse.schemas import OBSERVATIONS
from shelfpulse.session import folder_exists
from shelfpulse.sources import store
from shelfpulse.streaming import landing, state

START = dt.datetime(2024, 1, 1)


def readings(spark, rows):
    """Readings (id, variant, hours, price, available) of one merchant."""
    frame = spark.createDataFrame(
        [(n, 1, "m", "p", v, price, available, START + dt.timedelta(hours=hours)) for n, v, hours, price, available in rows],
        "id bigint, run_id bigint, merchant string, product_ext_id string, variant_ext_id string, price_raw string,"
        " available boolean, observed_at timestamp")
    return store.evolve(frame, OBSERVATIONS)


def detect(spark, folder, batches, **options):
    for number, rows in enumerate(batches):
        store.append_observations(readings(spark, rows), f"{folder}/obs", str(number))
        state.start_state_changes(spark, f"{folder}/obs", f"{folder}/out", f"{folder}/checkpoint", **options).awaitTermination()
    found = state.read_state_changes(spark, f"{folder}/out").collect()
    return sorted((r.id, r.kind) for r in found), sorted(r.id for r in state.read_late(spark, f"{folder}/out").collect())


def brute(batches, keep_hours=None):
    last, found, late = {}, [], []
    for batch in batches:
        for n, v, hours, price, available in sorted(batch, key=lambda r: (r[2], r[0])):
            before = last.get(v)
            if before and (hours, n) < before[:2]:
                late.append(n)
                continue
            if before and before[2] is not None and (keep_hours is None or hours - before[0] <= keep_hours):
                found += [(n, "price")] * (price != before[2]) + [(n, "stock")] * (available != before[3])
            last[v] = (hours, n, price, available)
    return sorted(found), sorted(late)


def random_batches(seed, shuffled=0):
    rng = random.Random(seed)
    rows = [(n, f"v{rng.randrange(6)}", n // 3, rng.choice(["1", "2", "x", None]), rng.choice([True, False, None])) for n in range(240)]
    batches = [rows[:80], rows[80:90], rows[90:]]
    for _ in range(shuffled):  # some readings of the first batch land with the last
        batches[2].append(batches[0].pop(rng.randrange(len(batches[0]))))
    return batches


@pytest.mark.parametrize(("seed", "late"), [(1, 0), (2, 15)])
def test_restarts_and_late_readings(spark, tmp_path, seed, late):
    batches = random_batches(seed, late)
    found, behind = detect(spark, str(tmp_path), batches)
    assert (found, behind) == brute(batches)
    if not late:
        whole = changes.history(readings(spark, sum(batches, []))).collect()
        assert found == sorted((r.id, r.kind) for r in whole) and behind == []


def test_expiry_is_exact(spark, tmp_path):
    """States are dropped by timers, and a pause that long starts a variant afresh, in one batch or over several."""
    batches = [[(1, "a", 0, "1", True), (2, "b", 0, "1", True), (3, "c", 0, "1", True), (4, "c", 10, "2", True)],
               [(5, "a", 24, "2", True), (6, "b", 25, "2", True)],
               [(7, "d", 200, "1", True)],
               [(8, "a", 201, "3", False), (9, "b", 202, "3", True), (10, "d", 203, "9", True)]]
    found, late = detect(spark, str(tmp_path), batches, keep_days=1)
    assert (found, late) == brute(batches, 24) == ([(4, "price"), (5, "price"), (10, "price")], [])


def test_batches_of_few_files(spark, tmp_path):
    batches = random_batches(3)
    found, late = detect(spark, str(tmp_path), [sum(batches, [])], limit_files=1)
    assert found == brute([sum(batches, [])])[0] and late == []


def test_states_survive_a_dead_batch(spark, tmp_path, monkeypatch):
    """A query that dies before its first batch ends takes that batch in again when started anew."""
    batches = random_batches(4)
    folder = str(tmp_path)
    store.append_observations(readings(spark, batches[0]), f"{folder}/obs", "0")
    query = state.start_state_changes(spark, f"{folder}/obs", f"{folder}/out", f"{folder}/checkpoint")
    query.stop()
    assert folder_exists(spark, f"{folder}/obs")
    state.start_state_changes(spark, f"{folder}/obs", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    found = sorted((r.id, r.kind) for r in state.read_state_changes(spark, f"{folder}/out").collect())
    assert found == brute(batches[:1])[0]


def test_copies_of_pages(spark, tmp_path):
    landed, once, checkpoint = (str(tmp_path / name) for name in ("landing", "once", "checkpoint"))

    def page(run, number, minutes):
        return (run, "m", number, 200, f"{run}-{number}", START + dt.timedelta(minutes=minutes))

    waves = [[page(1, 1, 0), page(1, 1, 0), page(1, 2, 10)], [page(1, 1, 0), page(1, 2, 10), page(2, 1, 9), page(3, 1, 2)], [page(2, 1, 9), page(2, 2, 30)]]
    for wave in waves:
        spark.createDataFrame(wave, "run_id bigint, merchant string, page int, http_status int, body string, fetched_at timestamp").write.mode(
            "append").parquet(landed)
        landing.start_deduplicated(spark, landed, once, checkpoint, "5 minutes").awaitTermination()
    assert sorted((r.run_id, r.page) for r in spark.read.parquet(once).collect()) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert [(r.run_id, r.page) for r in landing.late_pages(spark, landed, once).collect()] == [(3, 1)]


def test_readings_are_read_by_place():
    """A reading needs no names, which are searched for anew in every row."""
    class Last:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    processor = state.LastReading(None)
    processor.last = Last()
    rows = [(1, "m", "v", "T", "V", None, 2.0, None, True, 50), (0, "m", "v", "T", "V", None, 1.0, "x", False, 40)]
    found = [r.asDict() for r in processor.handleInputRows(("m", "v"), iter(rows), None)]
    assert [(r["id"], r["price"], r["prev_price"], r["prev_price_text"], r["prev_available"], r["has_prev"]) for r in found] == [
        (0, 1.0, None, None, None, False), (1, 2.0, 1.0, "x", False, True)]
    assert processor.last.value == (50, 1, 2.0, None, True, None)
