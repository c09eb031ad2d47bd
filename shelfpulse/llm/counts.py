"""Token counts by a unigram model over a trie of pre-tokens.

A pre-token's best segmentation is the one with the largest sum of piece scores; of equal sums the one with
fewer pieces. The distinct pre-tokens of a batch are a trie; it is walked in sorted order, and a pre-token takes the
forward scores (best sum and number of pieces up to each byte) of the prefix that it shares with the one before it, so
each is computed once per trie node. Terminal counts are kept for later batches of the same worker.

Pieces come from a vocabulary file, in its order; as no probabilities are published with it, the piece of rank r
scores -log(r + 1) (Zipf's law). Every byte is a piece, so each text has a segmentation.

Null text counts as empty and has no tokens. Repeated rows each give a row; an empty table gives an empty
result; texts and pre-tokens of any length are read whole; columns besides id and text are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import log
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.llm.bpe import PRE_SPLIT, byte_letters, vocabulary_path
from shelfpulse.llm.common import slices, spare, table

# Terminal counts that a worker keeps; beyond that it starts afresh (results do not change).
KNOWN = 700_000
# Longer pre-tokens are not kept beyond their batch.
KEPT_LENGTH = 64


def piece_scores(source: bytes) -> dict[bytes, float]:
    """Score of each piece of a byte-level vocabulary file."""
    letters = byte_letters()
    pieces = json.loads(source)["model"]["vocab"]
    return {bytes(letters[c] for c in text): -log(rank + 1) for text, rank in pieces.items()}


class Counter:
    def __init__(self, scores: dict[bytes, float]):
        self.ends: dict[bytes, float | None] = {}
        for piece in scores:
            for cut in range(1, len(piece)):
                self.ends.setdefault(piece[cut:], None)
        self.ends.update(scores)
        self.terminal: dict[str, int] = {}
        self.split = regex.compile(PRE_SPLIT).findall

    def segment(self, words: Iterable[bytes]) -> Iterator[int]:
        """Number of pieces of each word of a sorted sequence."""
        ends, last = self.ends, b""
        best, count = [0.0], [0]
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del best[shared + 1:], count[shared + 1:]
            for stop in range(shared + 1, len(word) + 1):
                top, pieces = -1e300, 0
                start = stop - 1
                piece = word[start:stop]
                while piece in ends:
                    own = ends[piece]
                    if own is not None:
                        sum_ = best[start] + own
                        if sum_ > top or sum_ == top and count[start] + 1 < pieces:
                            top, pieces = sum_, count[start] + 1
                    if not start:
                        break
                    start -= 1
                    piece = word[start:stop]
                best.append(top)
                count.append(pieces)
            last = word
            yield count[-1]

    def count(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """Pre-tokens and tokens of each text."""
        rows = [self.split(text) if text else [] for text in texts]
        terminal = self.terminal
        fresh = {word for row in rows for word in row if word not in terminal}
        if len(terminal) + len(fresh) > KNOWN and terminal:
            terminal.clear()
            fresh = {word for row in rows for word in row}
        # UTF-8 sorts as code points do
        order = sorted(fresh)
        terminal.update(zip(order, self.segment(word.encode() for word in order), strict=True))
        get = terminal.__getitem__
        counted = [len(row) for row in rows], [sum(map(get, row)) for row in rows]
        for word in order:
            if len(word) > KEPT_LENGTH:
                del terminal[word]
        return counted


@lru_cache(maxsize=2)
def _counter(source: bytes) -> Counter:
    return Counter(piece_scores(source))


def token_counts(documents: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, n_pretokens and n_tokens of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(Path(path).read_bytes())
    column = spare(keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in slices(batches, column, 4 << 20):
            words, tokens = counter.count(batch.column(column).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                names=[*keep, "n_pretokens", "n_tokens"])

    picked = documents.select(*keep, F.col(text).alias(column))
    return picked.mapInArrow(run, T.StructType([*(documents.schema[name] for name in keep),
                                                T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())]))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path())
