"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by the size of their shingle sets, in powers of two. The MinHash signature of an
item is its k smallest shingle hashes, k chosen per partition: a document that holds at least the share c
of an item of s shingles lacks at most (1-c)*s of them, so it holds one of any floor((1-c)*s)+1. The
candidate search by signature therefore loses nothing; each candidate is then verified by the exact
containment of the item's word shingles in the document.

The items go to the executors in blocks of bounded size, each block against all documents, so a
large benchmark takes several passes instead of a larger broadcast.

Items and documents without words match nothing; an item of fewer than five words is one shingle and matches
only a document of exactly these words. Null text counts as empty. Repeated rows each give their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfpulse.llm.common import slices, table
from shelfpulse.llm.shingles import SIMILAR, shingle_hashes, shingle_texts

# Bound of one broadcast block of items: rows and bytes of text.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8 << 20


def signature_size(size: int, share: float) -> int:
    """How many of the smallest hashes find every document that holds `share` of `size` shingles.

    `size` is rounded up to the partition's largest."""
    largest = 1 << (size - 1).bit_length()
    return min(size, int((1 - share) * largest + 1e-9) + 1)


class Block:
    """The signatures of some items, by hash, and their texts for the exact check."""

    def __init__(self, texts: list[str], share: float):
        hashes, offsets = shingle_hashes(texts)
        keys, items = [], []
        for number, (start, stop) in enumerate(zip(offsets, offsets[1:], strict=False)):
            own = np.unique(hashes[start:stop])
            if len(own):
                part = own[: signature_size(len(own), share)]
                keys.append(part)
                items.append(np.full(len(part), number))
        self.keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
        self.items = np.concatenate([*items, np.zeros(0, np.int64)])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.items = self.keys[order], self.items[order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.keys & np.uint64(0xFFFFF)).astype(np.int64)] = True
        self.texts, self.share = texts, share
        self.shingles = lru_cache(maxsize=4096)(lambda number: shingle_texts(texts[number]))

    def pairs(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text, item, shared shingles, shingles of the item) with at least the share, exactly checked."""
        if not len(self.keys):
            return []
        hashes, offsets = shingle_hashes(texts)
        near = np.flatnonzero(self.filter[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])
        low = np.searchsorted(self.keys, hashes[near], "left")
        count = np.searchsorted(self.keys, hashes[near], "right") - low
        hit = np.flatnonzero(count)
        owner = np.repeat(np.searchsorted(offsets, near[hit], "right") - 1, count[hit])
        place = np.arange(count[hit].sum()) + np.repeat(low[hit] - np.cumsum(count[hit]) + count[hit], count[hit])
        found = np.unique(np.stack([owner, self.items[place]], 1), axis=0)
        out, last, own = [], -1, set()
        for row, item in found.tolist():
            if row != last:
                last, own = row, shingle_texts(texts[row])
            wanted = self.shingles(item)
            shared = len(wanted & own)
            if shared >= self.share * len(wanted) - 1e-9:
                out.append((row, item, shared, len(wanted)))
        return out


def item_blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the items, in blocks dealt by a hash, each of bounded size."""
    items = benchmark.select(F.col(item).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    count = max(1, -(-rows // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for number in range(count):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == number).collect()
        block.sort(key=lambda row: (row["item"] is None, row["item"], row["text"]))
        if block:
            yield [row["item"] for row in block], [row["text"] for row in block]


@lru_cache(maxsize=2)
def _block(texts: tuple[str, ...], share: float) -> Block:
    return Block(list(texts), share)


def _shared(spark: SparkSession, texts: list[str], share: float) -> tuple[Broadcast, float]:
    return spark.sparkContext.broadcast(tuple(texts)), share


def contained(documents: DataFrame, benchmark: DataFrame, share: float = SIMILAR, item: str = "item_id") -> DataFrame:
    """doc_id, item_id, shared, shingles and containment of every pair of at least `share`."""
    spark, out = documents.sparkSession, None
    kind = benchmark.schema[item].dataType
    schema = T.StructType([
        documents.schema["doc_id"], T.StructField("item_id", kind), T.StructField("shared", T.LongType()),
        T.StructField("shingles", T.LongType()), T.StructField("containment", T.DoubleType())])

    def search(ids: list, texts: list[str]) -> DataFrame:
        shared, least = _shared(spark, texts, share)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = _block(shared.value, least)
            for batch in slices(batches, "text"):
                found = block.pairs(batch.column("text").to_pylist())
                rows = pa.array([f[0] for f in found], pa.int64())
                own = [f[2] for f in found], [f[3] for f in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(rows),
                    pa.array([ids[f[1]] for f in found]).cast(names.field("item_id").type),
                    pa.array(own[0], pa.int64()), pa.array(own[1], pa.int64()),
                    pa.array([a / b for a, b in zip(*own, strict=True)], pa.float64()),
                ], names=names.names)

        names = to_arrow_schema(schema)
        return documents.select("doc_id", "text").mapInArrow(run, schema)

    for ids, texts in item_blocks(benchmark, item, "text"):
        part = search(ids, texts)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminate(documents: DataFrame, benchmark: DataFrame, share: float = SIMILAR, item: str = "item_id") -> DataFrame:
    """`documents` without those that hold an item; other rows pass unchanged."""
    spark = documents.sparkSession

    def clean(frame: DataFrame, texts: list[str]) -> DataFrame:
        shared, least = _shared(spark, texts, share)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = _block(shared.value, least)
            for batch in slices(batches, "text"):
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in block.pairs(batch.column("text").to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        return frame.mapInArrow(run, frame.schema)

    for _, texts in item_blocks(benchmark, item, "text"):
        documents = clean(documents, texts)
    return documents


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds at least 80 % of the five-word shingles."""
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
