"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles (see shingles.py). Equal sets are one class with its members; only
classes are joined. In each of `RUNS` runs a set goes to the buckets of the shingles it samples: those whose hash
with the path so far lies below RATE / size, so two similar sets sample some shared shingle together. A bucket of more
than `BUCKET` sets is split again by shingles sampled with its path, up to `DEPTH` times; of paths with the same
members, of whichever runs, one is kept and samples as much as all of them would, at most as much as one of each run, so
a split loses no run's share. Small buckets are compared by brute force, first by sketches of 256 one-bit
minima that rule out pairs far below the threshold, then by the sets themselves.

What is still large then are near copies of one text, which no shingle separates. Such a bucket gets a pivot, the
shingles that half of a few members hold, and each set is kept as its difference from that. Two sets that are close
enough to the pivot are similar whatever their differences share; how many such partners each set has follows from the
sorted weights of all, without any pair. Only sets that are neither that close nor too far are compared, in blocks of
sets of like weight, by the shingles that their differences share.

Buckets with the same members, and buckets whose members have all met in another one, are compared once. A pair is
counted in the first bucket that it shares.

Of a pair at similarity 0.8 the worst case (one set holds the other) shares 1.2 samples a level on average: a run
misses it with chance 0.30 at the first level and 0.51 at the third, all ten with less than 0.0012; of sets of equal
size at 0.85, less than 0.0004. Near copies that differ in one place share their paths, so a crowded group of them is
found or missed as one, with that chance at most. Similarities are exact on the shingles' 64-bit hashes; sets are told
apart by 128 bits.

Texts without words form one class without links. Null text counts as empty. Rows with the same id and text each
get a row; null ids are kept. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.llm.common import bucketed, delete_folder, materialize, mix, new_folder, slices, table
from shelfpulse.llm.shingles import SIMILAR, keyed_sets

RUNS, RATE, BUCKET, DEPTH = 10, 1.5, 400, 3
PIVOT, BLOCK = 64, 2048  # members that a pivot is drawn from, sets in a block of a crowded bucket
NEARLY = 1e-6
CHILD, SECOND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _sampled(tokens: np.ndarray, seed: np.ndarray, rate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens are sampled under a path, and the paths they lead to."""
    value = mix(tokens ^ seed)
    chosen = np.flatnonzero((value >> np.uint64(11)) * 2.0**-53 < rate)
    return chosen, mix(value[chosen] ^ CHILD)


def _lists(values: np.ndarray, owner: np.ndarray, rows: int) -> pa.ListArray:
    order = np.argsort(owner, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[order].view(np.int64)))


BINS = 256


def sketches(tokens: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """64 bytes for each set: of each of 256 bins of hashes one bit of the smallest, and whether it has any."""
    value = mix(tokens ^ SECOND)
    least = np.full(rows * BINS, ~np.uint64(0))
    np.minimum.at(least, owner * BINS + (value >> np.uint64(56)).astype(np.int64), value << np.uint64(8))
    bits = np.stack([(least >> np.uint64(8)) & np.uint64(1), least != ~np.uint64(0)]).astype(bool).reshape(2, rows, BINS)
    return np.concatenate([np.packbits(bits[0], axis=1), np.packbits(bits[1], axis=1)], 1)


def maybe_similar(drawn: np.ndarray, share: float) -> np.ndarray:
    """Which pairs of sketches do not rule out a similarity of `share`: within five deviations of what it gives."""
    held = np.unpackbits(drawn[:, BINS // 8:], axis=1).astype(np.float32)
    ones = np.unpackbits(drawn[:, : BINS // 8], axis=1) * held
    zeros = held - ones
    same = ones @ ones.T + zeros @ zeros.T
    used = np.maximum(1, BINS - (1 - held) @ (1 - held).T)
    return same / used >= share - 5 * np.sqrt(share * (1 - share) / used)


# Bytes of text hashed at once: a worker keeps eight tables of 8 bytes for each place of the longest slice (or text).
TEXT_SLICE = 3 << 16


def cards(documents: DataFrame) -> DataFrame:
    """doc_id, seen (a hash of the text), key (of the shingle set), n (its size), sampled paths and sketch of each row."""
    seeds = mix(np.arange(1, RUNS + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_SLICE):
            sets, keys = keyed_sets(batch.column("text").to_pylist())
            sizes = np.array([len(s) for s in sets], np.int64)
            tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
            owner = np.repeat(np.arange(len(sets)), sizes)
            rate = np.repeat(RATE / np.maximum(sizes, 1), sizes)
            owners, paths = [], []
            for seed in seeds:
                chosen, path = _sampled(tokens, seed, rate)
                owners.append(owner[chosen])
                paths.append(path)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("seen"), pa.array(keys, pa.binary()),
                pa.array(sizes, pa.int64()), _lists(np.concatenate(paths), np.concatenate(owners), len(sets)),
                pa.array([row.tobytes() for row in sketches(tokens, owner, len(sets))], pa.binary()),
            ], names=["doc_id", "seen", "key", "n", "paths", "sketch"])

    schema = T.StructType([
        documents.schema["doc_id"], T.StructField("seen", T.LongType()), T.StructField("key", T.BinaryType()),
        T.StructField("n", T.LongType()), T.StructField("paths", T.ArrayType(T.LongType(), False)),
        T.StructField("sketch", T.BinaryType())])
    return documents.select("doc_id", _seen(), "text").mapInArrow(run, schema)


def _seen() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("seen")


def _crowded(rows: DataFrame) -> DataFrame:
    """Rows (path, key) of the paths with at least two sets, one path for each set of members, with its size c and the
    number m of the paths it stands for."""
    paths = rows.groupBy("path").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("key")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("b")).where("c > 1")
    once = paths.groupBy("c", "a", "b").agg(F.min("path").alias("path"), F.count("*").alias("m")).select("path", "c", "m")
    return rows.join(once, "path").select("path", "key", "c", "m")


def _tokens(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, n and tokens (8-byte hashes, sorted) of the wanted classes, read from one member's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_SLICE):
            sets, keys = keyed_sets(batch.column("text").to_pylist())
            own = pa.array(keys, pa.binary())
            right = pa.compute.equal(own, batch.column("key"))  # a repeated id may stand for other texts
            made = pa.RecordBatch.from_arrays([
                own, pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
            ], names=["key", "n", "tokens"])
            yield made.filter(right)

    same = F.col("d.doc_id").eqNullSafe(F.col("w.rep.doc_id")) & (F.col("d.seen") == F.col("w.rep.seen"))
    texts = documents.select("doc_id", _seen(), "text").alias("d").join(
        wanted.alias("w").hint("shuffle_hash"), same).select("w.key", "d.text")
    return texts.mapInArrow(run, "key binary, n long, tokens binary")


def _split(big: DataFrame, tokens: DataFrame) -> DataFrame:
    """The children of crowded paths: (path, key) for each shingle a set samples under its path, at the rate of the m
    paths it stands for (of ten at most: a pair is then missed with a chance below exp(-12))."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "tokens"):
            sets = [np.frombuffer(t, np.uint64) for t in batch.column("tokens").to_pylist()]
            under = [[(way["path"], way["m"]) for way in ways] for ways in batch.column("ways").to_pylist()]
            which = np.repeat(np.arange(len(sets)), [len(ways) for ways in under])
            seed, times = np.array([way for ways in under for way in ways], np.int64).reshape(-1, 2).T
            sizes = np.array([len(s) for s in sets], np.int64)[which]
            rate = np.minimum(0.9, RATE * np.minimum(RUNS, times) / sizes)
            tokens = np.concatenate([*(sets[n] for n in which), np.zeros(0, np.uint64)])
            chosen, path = _sampled(tokens, np.repeat(seed.view(np.uint64), sizes), np.repeat(rate, sizes))
            owner = which[np.repeat(np.arange(len(which)), sizes)[chosen]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(path.view(np.int64)), batch.column("key").take(pa.array(owner))], names=["path", "key"])

    ways = big.groupBy("key").agg(F.collect_list(F.struct("path", "m")).alias("ways"))  # a few for each run and level
    return ways.join(tokens, "key").select("key", "ways", "tokens").mapInArrow(run, "path long, key binary")


def _largest_first(members: DataFrame) -> DataFrame:
    """Paths numbered anew so that larger buckets come first: most sets of a group then share their first one.

    Two small buckets of one size may get one number; they are then compared as one."""
    most = 1 << 23
    size = F.shiftleft(most - F.least(F.col("c"), F.lit(most - 1)), 40)
    return members.withColumn("path", size.bitwiseOR(F.col("path").bitwiseAND(F.lit((1 << 40) - 1))))


def _uncovered(members: DataFrame) -> DataFrame:
    """Without the buckets whose members all meet in another one; `home` is the first bucket of each set."""
    home = members.groupBy("key").agg(F.min("path").alias("home"), F.sort_array(F.collect_set("path")).alias("met"))
    placed = members.join(home, "key")
    open_ = placed.groupBy("path").agg(F.min("home").alias("low"), F.max("home").alias("high")).where(
        (F.col("low") != F.col("high")) | (F.col("low") == F.col("path"))).select("path")
    return placed.join(open_, "path", "left_semi")


def _pivots(crowded: DataFrame, tokens: DataFrame) -> DataFrame:
    """path and pivot (sorted hashes) of each crowded bucket: what at least half of `PIVOT` members hold.

    Any pivot gives the same links; one near the most sets leaves the smallest differences."""
    def common(rows: pa.Table) -> pa.Table:
        held, times = np.unique(np.concatenate([np.frombuffer(t, np.uint64) for t in rows.column("tokens").to_pylist()]), return_counts=True)
        return pa.table({"path": rows.column("path")[:1], "pivot": pa.array([held[2 * times >= rows.num_rows].tobytes()], pa.binary())})

    few = Window.partitionBy("path").orderBy(F.xxhash64("key"), "key")
    drawn = crowded.select("path", "key").withColumn("place", F.row_number().over(few)).where(F.col("place") <= PIVOT)
    return drawn.join(tokens.select("key", "tokens"), "key").select("path", "tokens").groupBy("path").applyInArrow(common, "path long, pivot binary")


def _differences(crowded: DataFrame, pivots: DataFrame, tokens: DataFrame, share: float) -> DataFrame:
    """The rows with p (size of the pivot), tokens (what set and pivot do not share), weight and far.

    Two sets share p - gone - gone' + (what their differences share) shingles, gone being what a set lacks of the pivot;
    they are similar if that is at least share / (1 + share) of their sizes' sum. So with weight = gone + that share of
    the own size they are if weight + weight' <= p + (what their differences share)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "tokens"):
            sizes, weights, own = [], [], []
            for pivot, held in zip(batch.column("pivot").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                pivot, held = np.frombuffer(pivot, np.uint64), np.frombuffer(held, np.uint64)
                apart = np.setxor1d(pivot, held, assume_unique=True)
                gone = (len(apart) + len(pivot) - len(held)) // 2
                sizes.append(len(pivot))
                weights.append(gone + share / (1 + share) * len(held))
                own.append(apart.tobytes())
            far = [weight - len(apart) // 8 for weight, apart in zip(weights, own, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("path", "key", "c", "home", "met")), pa.array(sizes, pa.int64()),
                 pa.array(own, pa.binary()), pa.array(weights, pa.float64()), pa.array(far, pa.float64())],
                names=["path", "key", "c", "home", "met", "p", "tokens", "weight", "far"])

    schema = T.StructType([*(crowded.schema[name] for name in ("path", "key", "c", "home", "met")), *T.StructType.fromDDL(
        "p long, tokens binary, weight double, far double").fields])
    joined = crowded.join(pivots, "path").join(tokens.select("key", "tokens"), "key")
    return joined.select("path", "key", "c", "home", "met", "pivot", "tokens").mapInArrow(run, schema)


def _close(rows: DataFrame) -> DataFrame:
    """key, root and links of the sets that are similar to others of their home for their weights alone.

    A set's partners are those whose weight is at most p less its own: a running count over the distinct weights of the
    bucket, at which each weight asks for the count at p less itself."""
    home = rows.where("home = path").select("path", "key", "weight", F.col("p") + F.lit(NEARLY) - F.col("weight"))
    home = home.toDF("path", "key", "weight", "reach")
    weights = home.groupBy("path", "weight", "reach").agg(F.count("*").alias("sets"))
    told = weights.select("path", F.col("weight").alias("at"), F.lit(0).alias("asks"), "sets", F.lit(None).cast("double").alias("own"))
    asked = weights.select("path", F.col("reach").alias("at"), F.lit(1).alias("asks"), F.lit(0).alias("sets"), F.col("weight").alias("own"))
    so_far = Window.partitionBy("path").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    counted = told.unionByName(asked).withColumn("within", F.sum("sets").over(so_far)).where("asks = 1")
    least = home.groupBy("path").agg(F.min(F.struct("weight", "key")).alias("least")).select("path", F.col("least.key").alias("root"))
    links = F.col("within") - F.when(F.col("weight") <= F.col("reach"), 1).otherwise(0)
    found = home.join(counted.select("path", F.col("own").alias("weight"), "within"), ["path", "weight"]).join(least, "path")
    return found.select("key", "root", links.alias("links")).where("links > 0")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Each row of the crowded buckets with the pairs of blocks it is compared in.

    Sets of this home lie in blocks by weight; two blocks of them are paired only if weights alone do not settle it.
    Sets of one home that is another bucket have met there; their blocks are not paired with each other. Neither are
    blocks whose sets are too far from the pivot to be similar to any of the other block."""
    weights = rows.where("home = path").groupBy("path", "weight").agg(F.count("*").alias("sets"))
    before = Window.partitionBy("path").orderBy("weight").rowsBetween(Window.unboundedPreceding, -1)
    starts = weights.withColumn("start", F.coalesce(F.sum("sets").over(before), F.lit(0)))
    own = rows.where("home = path").join(starts, ["path", "weight"])
    spread = F.pmod(F.xxhash64("key"), F.ceil(F.col("sets") / BLOCK))
    own = own.withColumn("block", F.concat_ws(":", F.lit("o"), F.floor(F.col("start") / BLOCK) + spread)).drop("sets", "start")
    guests = rows.where("home <> path")
    sizes = guests.groupBy("path", "home").agg(F.count("*").alias("sets"))
    alone = F.concat_ws(":", F.lit("h"), "home", F.pmod(F.xxhash64("key"), F.ceil(F.col("sets") / BLOCK)))
    mixed = F.concat_ws(":", F.lit("r"), F.pmod(F.xxhash64("home"), F.ceil(F.col("c") / BLOCK)))
    named = guests.join(sizes, ["path", "home"]).withColumn("block", F.when(F.col("sets") > BLOCK // 2, alone).otherwise(mixed))
    dealt = own.select(rows.columns + ["block"]).unionByName(named.select(rows.columns + ["block"]))
    blocks = dealt.groupBy("path", "block").agg(
        F.max("weight").alias("top"), F.min("weight").alias("low"), F.min("far").alias("near"), F.first("p").alias("p"))
    others = blocks.drop("p").toDF("path", "other", "top_2", "low_2", "near_2")
    both = F.col("block").startswith("o") & F.col("other").startswith("o")
    met = F.col("block").startswith("h") & (F.substring_index("block", ":", 2) == F.substring_index("other", ":", 2))
    settled = both & (F.col("top") + F.col("top_2") <= F.col("p") + NEARLY)
    apart = F.greatest(F.col("near") + F.col("low_2"), F.col("near_2") + F.col("low")) > F.col("p") + NEARLY
    wanted = blocks.join(others, "path").where(~met & ~settled & ~apart).select(
        "path", "block", F.concat_ws("/", F.least("block", "other"), F.greatest("block", "other")).alias("pair"))
    return dealt.join(wanted, ["path", "block"])


def _compare(keys: list[bytes], sets: list[np.ndarray], met: list[np.ndarray], block: list[str], path: int,
             weights: np.ndarray, pivot: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set in this group and the smallest set it is joined with (directly or not)."""
    count = len(sets)
    names, kinds = np.unique(block, return_inverse=True)
    home = np.array([name.startswith("o") for name in names], bool)[kinds]
    linked = np.zeros((count, count), bool)
    shared, earlier = _Overlaps(sets), _Overlaps([m[m < path] for m in met])
    for start in range(0, count, STRIP):
        part = slice(start, start + STRIP)
        need = weights[part, None] + weights[None, :] - pivot
        own = (shared.strip(part) >= need - NEARLY) & (earlier.strip(part) == 0)
        own &= ~(home[part, None] & home[None, :] & (need <= NEARLY))  # counted by their weights
        if len(names) > 1:  # two blocks: only pairs across
            own &= kinds[part, None] != kinds[None, :]
        linked[part] = own
    np.fill_diagonal(linked, False)
    root = np.argsort(np.argsort(np.array(keys, object)))
    while True:  # smallest rank of the joined
        near = [np.where(linked[start: start + STRIP], root[None, :], count).min(1, initial=count) for start in range(0, count, STRIP)]
        new = np.minimum(root, np.concatenate(near))
        if (new == root).all():
            return linked.sum(1), root
        root = new


STRIP, WIDE = 512, 2048


class _Overlaps:
    """Sizes of intersections, strip by strip, from the values that at least two sets hold."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.count = len(sets)
        values, owner = np.concatenate([*sets, sets[0][:0]]), np.repeat(np.arange(self.count), [len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        number = np.cumsum(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)]) - 1
        keep = np.bincount(number, minlength=1)[number] > 1
        number, self.owner = number[keep], owner[keep]
        self.number = np.cumsum(np.concatenate([[False], number[1:] != number[:-1]])[: len(number)])

    def strip(self, part: slice) -> np.ndarray:
        out = np.zeros((len(range(self.count)[part]), self.count), np.float32)
        for start in range(0, int(self.number[-1]) + 1 if len(self.number) else 0, WIDE):
            own = slice(*np.searchsorted(self.number, [start, start + WIDE]))
            held = np.zeros((self.count, WIDE), np.float32)
            held[self.owner[own], self.number[own] - start] = 1
            out += held[part] @ held.T
        return out


def _groups(batches: Iterator[pa.RecordBatch], by: tuple[str, ...], sized: str) -> Iterator[dict]:
    """The groups of rows sorted by the columns `by`, however they lie in batches."""
    rest: pa.Table | None = None
    for batch in slices(batches, sized, 4 << 20):
        own = pa.Table.from_batches([batch])
        rest = own if rest is None else pa.concat_tables([rest, own]).combine_chunks()
        edge = np.zeros(max(0, rest.num_rows - 1), bool)
        for name in by:
            values = np.array(rest.column(name).to_pylist(), object)
            edge |= values[1:] != values[:-1]
        cuts = np.flatnonzero(edge) + 1
        for start, stop in zip([0, *cuts[:-1]], cuts, strict=False):
            yield rest.slice(start, stop - start).to_pydict()
        if len(cuts):
            rest = rest.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest.to_pydict()


def _sketched(members: DataFrame, classes: DataFrame, share: float) -> DataFrame:
    """Of the rows (path, key) of small buckets those with another set in the bucket that may be similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list] = ([], [])
        for group in _groups(batches, ("path",), "sketch"):
            near = maybe_similar(np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(group["key"]), -1), share)
            np.fill_diagonal(near, False)
            stay = np.flatnonzero(near.any(1))
            out[0].extend(group["path"][n] for n in stay)
            out[1].extend(group["key"][n] for n in stay)
            if len(out[0]) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], names=["path", "key"])
                out = ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())], names=["path", "key"])

    dealt = members.select("path", "key").join(classes.select("key", "sketch"), "key").repartition("path")
    return dealt.sortWithinPartitions("path").mapInArrow(run, "path long, key binary")


def _links(rows: DataFrame) -> DataFrame:
    """key, root (a set it is joined with) and links, for the sets that have any in a group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for group in _groups(batches, ("path", "pair"), "tokens"):
            single = {key: n for n, key in enumerate(group["key"])}  # rows with equal id and text give a set twice
            keys, pick = list(single), list(single.values())
            if len(keys) < 2:
                continue
            sets = [np.frombuffer(group["tokens"][n], np.uint64) for n in pick]
            links, root = _compare(keys, sets, [np.array(group["met"][n], np.int64) for n in pick],
                                   [group["block"][n] for n in pick], group["path"][0],
                                   np.array([group["weight"][n] for n in pick]), group["p"][0])
            names = sorted(keys)
            for n in np.flatnonzero(links):
                out[0].append(keys[n])
                out[1].append(names[root[n]])
                out[2].append(int(links[n]))
            if len(out[0]) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()),
                                                  pa.array(out[2], pa.int64())], names=["key", "root", "links"])
                out = ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()),
                                          pa.array(out[2], pa.int64())], names=["key", "root", "links"])

    dealt = rows.select("path", "pair", "block", "key", "tokens", "met", "weight", "p").repartition("path", "pair")
    return dealt.sortWithinPartitions("path", "pair").mapInArrow(run, "key binary, root binary, links long")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """key and its component (the smallest key in it), by alternating large and small stars."""
    def larger(pairs: DataFrame) -> DataFrame:
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def smaller(down: DataFrame) -> DataFrame:
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low, "u").withColumn("to", F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")))
        return joined.select(F.col("to").alias("u"), F.col("m").alias("v")).distinct()

    pairs = materialize(edges.where("u > v").distinct(), "edges-0", folder)
    step, before = 0, _sum(pairs)
    while before[0]:
        step += 1
        pairs = materialize(smaller(larger(pairs)), f"edges-{step}", folder)
        delete_folder(pairs.sparkSession, f"{folder}/edges-{step - 1}")
        now = _sum(pairs)
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("key"), F.col("v").alias("component"))


def _sum(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def join(documents: DataFrame, share: float = SIMILAR) -> DataFrame:
    """For every row: class_id (smallest id of its near-duplicate group), text_id (smallest id with its shingle set),
    copies (rows with that set), n_links (different sets of similarity `share` or more)."""
    spark = documents.sparkSession
    folder = new_folder(spark, "jaccard")

    def kept(frame: DataFrame, name: str, *read: str) -> DataFrame:
        """`frame` as a written table; the tables that only it reads are deleted."""
        out = materialize(frame, name, folder)
        for table_ in read:
            delete_folder(spark, f"{folder}/{table_}")
        return out

    made = kept(cards(documents), "cards")
    rows = kept(made.select("doc_id", "seen", "key"), "rows")
    classes = kept(made.groupBy("key").agg(
        F.min(F.struct("doc_id", "seen")).alias("rep"), F.min("doc_id").alias("text_id"), F.count("*").alias("copies"),
        F.first("n").alias("n"), F.first("paths").alias("paths"), F.first("sketch").alias("sketch")), "classes", "cards")
    members = kept(_crowded(classes.where("n > 0").select(F.explode("paths").alias("path"), "key")), "members-1")
    small = kept(_sketched(members.where(F.col("c") <= BUCKET), classes, share), "small-1")
    wanted = small.select("key").unionByName(members.where(F.col("c") > BUCKET).select("key")).distinct()
    found_tokens = _tokens(documents, classes.select("key", "rep").join(wanted, "key", "left_semi"))
    tokens, listed = bucketed(found_tokens, "tokens", folder, "key")
    depth = 1
    while depth < DEPTH and not members.where(F.col("c") > BUCKET).isEmpty():
        depth += 1
        big = members.where(F.col("c") > BUCKET).select("path", "key", "m")
        members = kept(_crowded(_split(big, tokens).distinct()), f"members-{depth}", f"members-{depth - 1}")
        small = small.unionByName(kept(_sketched(members.where(F.col("c") <= BUCKET), classes, share), f"small-{depth}"))
    told = kept(classes.select("key", "text_id", "copies"), "told", "classes")
    final = _crowded(small).unionByName(members.where(F.col("c") > BUCKET)).drop("m")
    buckets = kept(_uncovered(_largest_first(final)), "buckets", f"members-{depth}", *(f"small-{n}" for n in range(1, depth + 1)))
    few = buckets.where(F.col("c") <= BUCKET).join(tokens, "key").select(
        "path", "key", "met", "tokens", F.lit("").alias("block"), F.lit("").alias("pair"), F.lit(0).cast("long").alias("p"),
        (F.col("n") * F.lit(share / (1 + share))).alias("weight"))
    found = kept(_links(few), "links-small")
    crowded = buckets.where(F.col("c") > BUCKET)
    if not crowded.isEmpty():
        pivots = kept(_pivots(crowded, tokens), "pivots")
        apart = kept(_differences(crowded, pivots, tokens, share), "differences", "pivots", "buckets")
        close = kept(_close(apart), "links-close")
        found = found.unionByName(close).unionByName(kept(_links(_in_blocks(apart)), "links-blocks", "differences"))
    spark.sql(f"DROP TABLE {listed}")
    delete_folder(spark, f"{folder}/tokens")
    links = found.groupBy("key").agg(F.sum("links").alias("n_links"))
    joined = components(found.select(F.col("key").alias("u"), F.col("root").alias("v")), folder)
    place = told.join(joined, "key", "left").join(links, "key", "left").select(
        "key", "text_id", "copies", F.coalesce("component", "key").alias("component"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    first = place.groupBy("component").agg(F.min("text_id").alias("class_id"))
    placed = kept(place.join(first, "component"), "placed")
    return rows.join(placed, "key").select(
        "doc_id", "class_id", "text_id", "copies", "n_links", "seen", "component")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group and number of links of every document."""
    return join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "text_id", "copies", "n_links")


def one_of_each(documents: DataFrame, share: float = SIMILAR) -> DataFrame:
    """`documents` with one row of each near-duplicate group: that of the smallest id, of equals the smallest text
    hash; rows equal in both count as one. Texts without words are one group."""
    told = materialize(join(documents, share), "groups")
    kept = told.groupBy("component").agg(F.min(F.struct("doc_id", "seen")).alias("k")).select("k.doc_id", "k.seen")
    twice = told.groupBy("doc_id", "seen").count().where("count > 1").select("doc_id", "seen")
    marked = documents.select(F.struct(*(F.col(f"`{name}`") for name in documents.columns)).alias("row"), "doc_id", _seen())

    single = kept.alias("k").hint("shuffle_hash")
    stay = marked.alias("m").join(single, F.expr("m.doc_id <=> k.doc_id AND m.seen = k.seen"), "left_semi")
    again = F.expr("m.doc_id <=> t.doc_id AND m.seen = t.seen")
    alone = stay.join(twice.alias("t"), again, "left_anti")
    first = stay.join(twice.alias("t"), again, "left_semi").dropDuplicates(["doc_id", "seen"])
    return alone.unionByName(first).select("row.*")
