"""Compaction and retention count at once, wherever they die, and are no news to the change stream."""

import pytest
from pyspark.sql import functions as F

from shelfpulse.operators import retention
from shelfpulse.session import numbered
from shelfpulse.sources import store
from shelfpulse.streaming import changes as stream

NOW = "2024-01-31 07:30:00"


class Died(Exception):
    pass


def dying(real, steps):
    """`real` that works `steps` times and then dies."""
    left = [steps]

    def call(*args):
        if left[0] == 0:
            raise Died
        left[0] -= 1
        return real(*args)

    return call


def ids(spark, path):
    return sorted(r.id for r in store.read_observations(spark, path).select("id").collect())


def filled(spark, tables, path, day="2024-01-05"):
    obs = tables.obs().where(F.col("observed_at").cast("date").between("2024-01-04", "2024-01-19"))
    for part in range(3):
        store.append_observations(obs.where(F.col("id") % 3 == part), path, str(part))
    return obs, day


@pytest.mark.parametrize("what", ["delete_folder", "move", "mark"])
@pytest.mark.parametrize("steps", [0, 1, 2, 3, 4])
def test_compaction_that_dies(spark, tables, tmp_path, monkeypatch, what, steps):
    path = str(tmp_path / "obs")
    _, day = filled(spark, tables, path)
    before = ids(spark, path)
    monkeypatch.setattr(store, what, dying(getattr(store, what), steps))
    try:
        store.compact(spark, path, day)
    except Died:
        assert ids(spark, path) == before
    monkeypatch.undo()
    store.compact(spark, path, day)
    assert ids(spark, path) == before
    rows = store.read_observations(spark, path).where(F.col("obs_date") == day)
    assert rows.select("batch").distinct().count() == 1
    store.compact(spark, path, day)
    assert ids(spark, path) == before


@pytest.mark.parametrize("what", ["delete_folder", "move"])
@pytest.mark.parametrize("steps", [0, 1, 3, 6])
def test_prune_that_dies(spark, tables, tmp_path, monkeypatch, what, steps):
    path = str(tmp_path / "obs")
    obs, _ = filled(spark, tables, path)
    before, after = ids(spark, path), sorted(r.id for r in retention.keep(obs, NOW).collect())
    assert 0 < len(after) < len(before)
    monkeypatch.setattr(store, what, dying(getattr(store, what), steps))
    try:
        store.prune_store(spark, path, NOW)
    except Died:
        assert ids(spark, path) in (before, after)  # nothing in between
    monkeypatch.undo()
    store.prune_store(spark, path, NOW)
    assert ids(spark, path) == after
    assert store.prune_store(spark, path, NOW)["doomed"] == 0


def test_a_rewrite_is_hidden_until_it_counts(spark, tables, tmp_path, monkeypatch):
    path = str(tmp_path / "obs")
    _, day = filled(spark, tables, path)
    before, seen = ids(spark, path), []
    real = store.move
    monkeypatch.setattr(store, "move", lambda *args: (seen.append(ids(spark, path)), real(*args), seen.append(ids(spark, path))))
    store.compact(spark, path, day)
    assert seen == [before, before]


def test_rewritten_files_are_no_news(spark, tables, tmp_path):
    path, out, checkpoint = (str(tmp_path / name) for name in ("obs", "out", "checkpoint"))
    obs, day = filled(spark, tables, path)

    def detect():
        stream.start_changes(spark, path, out, checkpoint).awaitTermination()
        return sorted(map(str, stream.read_changes(spark, out).collect()))

    first = detect()
    store.compact(spark, path, day)
    store.prune_store(spark, path, "2024-01-18 12:00:00")
    assert detect() == first and numbered(spark, f"{out}/recomputed", "epoch") == []


def test_rewritten_before_it_was_seen(spark, tables, tmp_path):
    """Batches compacted before the stream came to them are taken in from the compacted files, once."""
    path, out, checkpoint = (str(tmp_path / name) for name in ("obs", "out", "checkpoint"))
    obs, day = filled(spark, tables, path)
    store.compact(spark, path, day)
    stream.start_changes(spark, path, out, checkpoint).awaitTermination()
    from shelfpulse.operators import changes

    want = sorted((r.merchant, r.variant_ext_id, r.kind) for r in changes.history(obs).collect())
    assert sorted((r.merchant, r.variant_ext_id, r.kind) for r in stream.read_changes(spark, out).collect()) == want
