"""Virtual slots: every row placed once, shards near equal, few records moved."""

import zlib

import numpy as np
import pytest
from conftest import SMALL

from shelfpulse.llm import sharding
from shelfpulse.llm.common import new_folder, table

MIDDLE = "/root/testdata/sf0.01"


def check(rows, texts, shards):
    """Rows hold every (doc_id, text) once, shards are gapless, loads differ by less than any record that could move."""
    assert sorted(map(str, ((r["doc_id"], r["size"], r["text_crc32"]) for r in rows))) == sorted(
        str((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))) for i, t in texts)
    by_shard, slots = {}, {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
        slots.setdefault((r["shard"], r["virtual_slot"]), []).append(r["size"])
    assert set(by_shard) <= set(range(shards))
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    loads = np.zeros(shards, int)
    for shard, own in by_shard.items():
        loads[shard] = sum(r["size"] for r in own)
    for shard in by_shard:
        least = min(sum(own) for (at, _), own in slots.items() if at == shard)
        assert loads[shard] - loads.min() <= least
    return loads


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_given_tables(spark, folder):
    texts = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()]
    rows = sharding.op12_virtual_slots(spark, folder).collect()
    check(rows, texts, 40)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 7)
    texts = [(1, None), (1, ""), (None, "no id"), (None, None), (2, "long " * 100_000), (3, "ça va 日本語"), *[(4, "copy")] * 40,
             *[(n, f"text {n}") for n in range(10, 400)], *[(500 + n, "one text under many ids") for n in range(200)]]
    frame = spark.createDataFrame([(i, t, 1, 2, "s", 9) for i, t in texts], "doc_id long, text string, size int, slot int, shard string, virtual_slot int")
    out = sharding.sharded(frame.repartition(3), new_folder(spark, "slots"), shards=5, slots=256)
    loads = check(out.collect(), texts, 5)
    assert sorted(loads)[-1] > 500_000 > sorted(loads)[-2]
    assert sorted(map(str, out.collect())) == sorted(map(str, sharding.sharded(
        frame.repartition(7), new_folder(spark, "slots"), shards=5, slots=256).collect()))  # whatever the partitions
    empty = sharding.sharded(frame.where("1 = 0"), new_folder(spark, "slots"), shards=5, slots=256)
    assert empty.collect() == []


def test_copies_spread_over_slots(spark):
    frame = spark.createDataFrame([(1, "the same row")] * 3000, "doc_id long, text string")
    slots = sharding.slot_sizes(sharding.records(frame, 64)).collect()
    assert len(slots) == 64 and sum(r["records"] for r in slots) == 3000 and max(r["records"] for r in slots) < 100


def test_maps():
    rng = np.random.default_rng(1)
    for turn in range(40):
        sizes = (rng.pareto(1.5, 512) * 1000).astype(np.int64)
        sizes[rng.integers(0, 512, 100)] = 0
        first = sharding.SlotMap.first(10, 512)
        even = first.rebalanced(sizes)
        loads = even.loads(sizes)
        for shard in range(10):
            held = sizes[(even.shard_of == shard) & (sizes > 0)]
            assert loads[shard] - loads.min() <= held.min(initial=loads[shard])
        assert even.version == 2 and (even.rebalanced(sizes).shard_of == even.shard_of).all()
        grown = even.grown(sizes)
        moved = grown.shard_of != even.shard_of
        assert grown.shards == 11 and (grown.shard_of[moved] == 10).all() and not (even.shard_of == 10).any()
        part = sizes.sum() // 11
        assert loads.sum() == grown.loads(sizes).sum() and grown.loads(sizes)[10] <= part
        gone = grown.without(3, sizes)
        assert not (gone.shard_of == 3).any() and ((gone.shard_of != grown.shard_of) <= (grown.shard_of == 3)).all()


def test_versions(spark):
    path = new_folder(spark, "slot-map")
    first = sharding.SlotMap.first(4, 32)
    sharding.store_map(spark, path, first)
    sharding.store_map(spark, path, first.edited([(3, 0), (5, 2)]))
    assert (sharding.read_map(spark, path, 1).shard_of == first.shard_of).all()
    newest = sharding.read_map(spark, path)
    assert newest.version == 2 and np.flatnonzero(newest.shard_of != first.shard_of).tolist() == [3, 5]
    with pytest.raises(ValueError, match="already stored"):
        sharding.store_map(spark, path, first)
    # a version without its marker, as a lost writer leaves it, does not count
    spark.createDataFrame([(0, 1, 4)], "virtual_slot int, shard int, shards int").write.parquet(f"{path}/version=3/slots")
    assert sharding.read_map(spark, path).version == 2
