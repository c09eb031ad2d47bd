"""Exact substring dedup with suffix arrays: bytes covered by a string of 200 that also starts elsewhere.

A document is its UTF-8 bytes. Each window of 200 bytes has an anchor, the 120 bytes in it with the smallest hash, so equal
windows have equal anchors and one shard that holds the surroundings (up to 80 bytes on either side) of all places
of an anchor holds all their equal windows. Anchors are counted over all documents; those that occur once are done. Of the
rest, places with equal surroundings are repeats as they stand and one of each goes on; these are dealt to shards by anchor,
whole anchors together. A shard's surroundings are one text with a suffix array by induced sorting and permuted common
prefixes (see suffixes.py): suffixes with 200 bytes in common with a neighbour mark the repeated windows.

An anchor in more than `CROWD` different surroundings (a common phrase of 120 to 199 bytes) does not fit a shard; the
windows of its places are compared by 128-bit hashes in a grouping instead, which spreads them and finds the same.
Anchors and equal surroundings are matched by 64-bit hashes each, 128 bits together, rows are told apart by 128 bits;
repeats found in shards are byte by byte.

Null text counts as empty. Texts shorter than 200 bytes have no repeats. Rows that are equal in id and text are copies of
each other. An empty table gives an empty result. Other columns are ignored. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.llm.common import materialize, mix, new_folder, powers, prefix_sums, slices, span_hash, table
from shelfpulse.llm.suffixes import common_prefixes, suffix_array

LEAST, ANCHOR = 200, 120
SIDE = LEAST - ANCHOR
SHARD_BYTES, CROWD = 3 << 20, 10_000
ROW = ["row", "twin"]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span:]) if width > span else values


def anchors_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text number, place, anchor hash and hash of the surroundings of every anchor."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    nothing = np.zeros(0, np.int64)
    if len(joined) < LEAST:
        return nothing, nothing, nothing, nothing
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    stop = np.cumsum([len(t) for t in texts])
    start = stop - [len(t) for t in texts]
    sums = prefix_sums(joined)
    drawn = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * powers(len(sums))[0][: len(sums) - ANCHOR])
    bits = np.uint64(len(joined).bit_length())
    least = sliding_least((drawn >> bits << bits) | np.arange(len(drawn), dtype=np.uint64), SIDE + 1)
    least = least[owner[: len(owner) - LEAST + 1] == owner[LEAST - 1:]]
    least = least[np.concatenate([[True], least[1:] != least[:-1]])] if len(least) else least
    place = np.unique((least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))
    text = owner[place]
    left, right = np.maximum(start[text], place - SIDE), np.minimum(stop[text], place + LEAST)
    around = mix(span_hash(sums, left, right) ^ (right - left).astype(np.uint64))  # lengths apart, whatever zeros they end in
    return text.astype(np.int64), place - start[text], drawn[place].view(np.int64), around.view(np.int64)


def _row() -> list[Column]:
    """The two halves of a row's 128 bits: hashes of its id and text from two seeds."""
    own = "doc_id", F.coalesce("text", F.lit(""))
    return [F.xxhash64(*own).alias("row"), F.xxhash64(F.lit(1), *own).alias("twin")]


def anchors(documents: DataFrame) -> DataFrame:
    """h (anchor), c (its surroundings), row, twin and place of every anchor of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, place, h, c = anchors_of([(t or "").encode() for t in batch.column("text").to_pylist()])
            rows = [pa.array(batch.column(name).to_numpy()[text], pa.int64()) for name in ROW]
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c), *rows, pa.array(place.astype(np.int32))],
                                             names=["h", "c", *ROW, "place"])

    return documents.select(*_row(), "text").mapInArrow(run, "h long, c long, row long, twin long, place int")


def _surroundings(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes around the wanted places: h, row, twin, start, n, crowded and data."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            for row, twin, text, places in zip(*(batch.column(name).to_pylist() for name in (*ROW, "text", "places")), strict=True):
                data = (text or "").encode()
                for p in places:
                    start = max(0, p["place"] - SIDE)
                    for column, value in zip(out, (p["h"], row, twin, start, p["n"], p["crowded"], data[start: p["place"] + LEAST]), strict=True):
                        column.append(value)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)],
                                             names=["h", *ROW, "start", "n", "crowded", "data"])

    places = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("place", "h", "n", "crowded")).alias("places"))
    joined = documents.select(*_row(), "text").join(places.hint("shuffle_hash"), ROW)
    return joined.mapInArrow(run, "h long, row long, twin long, start int, n long, crowded boolean, data binary")


def repeated_starts(data: list[bytes], row: np.ndarray, start: np.ndarray, copies: np.ndarray) -> list[np.ndarray]:
    """For the surroundings of one shard: starts (in the document) of windows that start elsewhere too."""
    sizes = np.array([len(d) for d in data])
    text = np.frombuffer(b"".join(d + b"\0" for d in data) + b"\0", np.uint8).astype(np.int16) + 2
    stop = np.cumsum(sizes + 1) - 1
    text[stop] = 1  # between two surroundings
    text[-1] = 0
    array = suffix_array(text)
    common = common_prefixes(text, array, LEAST)
    owner = np.repeat(np.arange(len(data)), sizes + 1)
    ordered = array[array < len(owner)]
    group = np.cumsum(common[ordered] < LEAST)
    own = owner[ordered]
    whole = ordered + LEAST <= stop[own]
    ordered, group, own = ordered[whole], group[whole], own[whole]
    if not len(ordered):
        return [np.zeros(0, np.int64)] * len(data)
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    place = start[own] + ordered - (stop[own] - sizes[own])
    number = np.unique(row, return_inverse=True)[1][own]
    key = number.astype(np.int64) << 40 | place  # one window may be in the surroundings of two anchors
    twice = np.minimum.reduceat(key, edge) != np.maximum.reduceat(key, edge)
    twice |= np.maximum.reduceat(copies[own], edge) > 1
    hit = np.repeat(twice, np.diff(edge, append=len(ordered)))
    order = np.lexsort((place[hit], own[hit]))
    return np.split(place[hit][order], np.cumsum(np.bincount(own[hit], minlength=len(data)))[:-1])


def as_spans(starts: np.ndarray) -> list[int]:
    """Start and stop, in turn, of the runs that windows at sorted `starts` cover."""
    if not len(starts):
        return []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + LEAST)
    return np.column_stack([starts[np.concatenate([[0], gap + 1])], starts[np.append(gap, len(starts) - 1)] + LEAST]).ravel().tolist()


def _in_shards(held: DataFrame) -> DataFrame:
    """row, twin and spans of the repeats that the suffix array of each shard shows."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        kept: list[pa.Table] = []
        size = 0
        for batch in slices(batches, "data"):
            own = pa.Table.from_batches([batch])
            kept.append(own)
            size += own.nbytes
            if size >= SHARD_BYTES:
                whole = pa.concat_tables(kept).combine_chunks()
                h = whole.column("h").to_numpy()
                cut = int(np.searchsorted(h, h[-1]))  # the last anchor may go on
                if cut:
                    yield whole.slice(0, cut)
                kept = [whole.slice(cut)]
                size = kept[0].nbytes
        if kept:
            yield pa.concat_tables(kept).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches):
            if not shard.num_rows:
                continue
            row = [shard.column(name).to_numpy() for name in ROW]
            number = np.unique(np.column_stack(row), axis=0, return_inverse=True)[1].ravel()
            starts = repeated_starts(shard.column("data").to_pylist(), number, shard.column("start").to_numpy().astype(np.int64),
                                     shard.column("n").to_numpy())
            spans = [as_spans(s) for s in starts]
            has = np.flatnonzero([bool(s) for s in spans])
            yield pa.RecordBatch.from_arrays([*(pa.array(half[has]) for half in row), pa.array([spans[n] for n in has], pa.list_(pa.int32()))],
                                             names=[*ROW, "spans"])

    dealt = held.where("not crowded").select("h", *ROW, "start", "n", "data").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "row long, twin long, spans array<int>")


def _by_window(held: DataFrame) -> DataFrame:
    """The same for crowded anchors: windows grouped by 128 bits of hash, those with two places marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            data = batch.column("data").to_pylist()
            sizes = np.array([len(d) for d in data])
            joined = np.frombuffer(b"".join(data), np.uint8)
            count = np.maximum(0, sizes - LEAST + 1)
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = offset + np.repeat(np.cumsum(sizes) - sizes, count)
            first = span_hash(prefix_sums(joined), at, at + LEAST)
            second = span_hash(prefix_sums(joined.astype(np.uint64) * joined + np.uint64(7)), at, at + LEAST)
            row, twin, start, n = (np.repeat(batch.column(name).to_numpy(), count) for name in (*ROW, "start", "n"))
            yield pa.RecordBatch.from_arrays([
                pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(row), pa.array(twin),
                pa.array((start + offset).astype(np.int32)), pa.array(n)], names=["a", "b", *ROW, "start", "n"])

    windows = held.where("crowded").select(*ROW, "start", "n", "data").mapInArrow(
        run, "a long, b long, row long, twin long, start int, n long")
    edges = [f(name).alias(f"{name}_{f.__name__}") for name in (*ROW, "start") for f in (F.min, F.max)]
    twice = windows.groupBy("a", "b").agg(*edges, F.max("n").alias("n")).where(
        "row_min <> row_max or twin_min <> twin_max or start_min <> start_max or n > 1").select("a", "b")
    return windows.join(twice, ["a", "b"], "left_semi").select(*ROW, F.array("start", F.col("start") + LEAST).alias("spans"))


def repeats(documents: DataFrame) -> DataFrame:
    """row, twin (see _row) and spans: start and stop, in turn, of repeated runs; runs may overlap and go past the text's end."""
    folder = new_folder(documents.sparkSession, "substrings")
    found = anchors(documents)
    often = found.groupBy("h").count().where("count > 1").select("h")
    places = materialize(found.join(often.hint("shuffle_hash"), "h", "left_semi"), "places", folder)
    around = materialize(places.groupBy("h", "c").agg(
        F.count("*").alias("n"), F.min("row").alias("row"), *(F.min_by(name, "row").alias(name) for name in ("twin", "place"))),
        "around", folder)
    several = around.groupBy("h").agg(F.count("*").alias("m")).where("m > 1")
    wanted = around.join(several, "h").select("h", *ROW, "place", "n", (F.col("m") > CROWD).alias("crowded"))
    held = materialize(_surroundings(documents, wanted), "surroundings", folder)
    same = places.join(around.where("n > 1").select("h", "c"), ["h", "c"], "left_semi").select(
        *ROW, F.array(F.greatest(F.col("place") - SIDE, F.lit(0)), F.col("place") + LEAST).alias("spans"))
    marked = same.unionByName(_in_shards(held))
    if not held.where("crowded").isEmpty():
        marked = marked.unionByName(_by_window(held))
    return materialize(marked.groupBy(*ROW).agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans", folder)


def union(spans: list[int], size: int) -> list[tuple[int, int]]:
    """Maximal runs of the given ones, none past `size`."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(zip(spans[::2], spans[1::2], strict=True)):
        stop = min(stop, size)
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop)
        else:
            out.append((start, stop))
    return out


def without_repeats(documents: DataFrame, kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row, with `kept` also the remaining bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: tuple[list, ...] = ([], [], [], [], [])
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = (text or "").encode()
                runs = union(spans or [], len(data))
                edges = [0, *(x for run in runs for x in run), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for column, value in zip(out, (len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest), strict=True):
                    column.append(value)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()
            columns = [pa.array(x, k) for x, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns[: 4 + kept]], names=names)

    fields = [documents.schema["doc_id"], *(T.StructField(name, T.LongType()) for name in ("n_bytes", "n_removed", "n_spans")),
              T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())][: 5 + kept]
    names = [field.name for field in fields]
    joined = documents.select("doc_id", "text", *_row()).join(repeats(documents).hint("shuffle_hash"), ROW, "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(run, T.StructType(fields))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that strings of 200 repeat anywhere in the corpus."""
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
