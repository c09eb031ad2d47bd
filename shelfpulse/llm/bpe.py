"""Byte-level BPE by a tokenization automaton: encode and decode.

The automaton reads tokens. It starts with one state whose arcs are the 256 bytes, and each merge
(u, v) -> w, in order, applies a gadget: the arc v leaves state u, every state from which u and
then v could be read gets an arc w, and its target is a copy of state v as it is at that moment. So there is
one state per token, and a sequence of tokens is a path exactly if it is the BPE encoding of its bytes.
Copies are kept by reference: an arc's presence follows from the one removed arc of each merge and the two
parts of each token, and is stored in the transition table once it has been asked for.

An encoder walks a pre-split word through the table, longest arc first, and steps back from a state without
an arc for what follows; decoding emits the arcs' labels. The vocabulary file is read on the driver from a
parameter and sent to the executors (its size does not grow with the corpus).

Null text counts as empty and gives no tokens. Repeated rows each give a row, an empty table
gives an empty result, texts of any length are read whole; columns besides id and text are carried
only where asked for.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.llm.common import give_back, slices, spare, table

VOCABULARY = "byte_bpe_50k.json"
# Fixed value: the pre-split pattern of the byte-level format.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words and transitions that a worker remembers; beyond that it starts afresh (results do not change).
WORDS, TRANSITIONS = 400_000, 1_000_000
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The format's letter for each byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Automaton:
    """States and arcs of one vocabulary; states are token ids."""

    def __init__(self, source: bytes):
        data = json.loads(source)
        letters = byte_letters()
        self.special = {entry["content"]: entry["id"] for entry in data["added_tokens"]}
        vocabulary = data["model"]["vocab"]
        size = 1 + max([*vocabulary.values(), *self.special.values()])
        self.labels: list[bytes] = [b""] * size
        for text, number in self.special.items():
            self.labels[number] = text.encode()
        self.born = [NEVER] * size
        self.first, self.second = [-1] * size, [-1] * size
        self.removed: dict[int, int] = {}
        self.table: dict[int, bool] = {}
        self.begins: dict[bytes, int] = {}
        self.shorter = [-1] * size
        for text, number in vocabulary.items():
            if len(text) == 1:
                self.labels[number] = bytes([letters[text]])
                self.born[number] = -1
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.gadget(rank, vocabulary[left], vocabulary[right], vocabulary[left + right])
        self.begins = {self.labels[number]: number for number in range(size) if self.born[number] < NEVER}
        for number, label in [(n, self.labels[n]) for n in range(size) if self.born[n] < NEVER]:
            for stop in range(len(label) - 1, 0, -1):
                if self.begins.setdefault(label[:stop], -1) >= 0:
                    self.shorter[number] = self.begins[label[:stop]]
                    break
        self.table.clear()
        self.words: dict[str, tuple[bytes, str, bytes]] = {}
        self.split = regex.compile(PRE_SPLIT).findall
        self.specials = regex.compile("|".join(f"({regex.escape(text)})" for text in self.special) or "(?!)")

    def gadget(self, rank: int, u: int, v: int, w: int) -> None:
        """Take the arc v out of state u; w gets arcs beside u's and a copy of state v."""
        if self.born[w] < NEVER:
            raise ValueError(f"token {w} is the result of two merges")
        if self.born[u] == NEVER or self.born[v] == NEVER or not self.arc(u, v):
            return  # no path reads u and then v: no encoding has this token
        self.removed[u << 32 | v] = rank
        self.first[w], self.second[w], self.born[w] = u, v, rank
        self.labels[w] = self.labels[u] + self.labels[v]

    def arc(self, state: int, token: int) -> bool:
        """Whether `token` can follow `state`, after all merges so far."""
        before, born = NEVER, self.born
        while True:
            if self.removed.get(state << 32 | token, NEVER) < before:
                return False
            if born[state] > born[token]:  # the state is a copy of its second part's, made then
                before = born[state]
                state = self.second[state]
            elif born[token] >= 0:  # the arc was put beside its first part's, which that merge may remove
                before = born[token] + 1
                token = self.first[token]
            else:
                return True

    def follows(self, state: int, token: int) -> bool:
        key = state << 32 | token
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= TRANSITIONS:
                self.table.clear()
            known = self.table[key] = self.arc(state, token)
        return known

    def encode_bytes(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word: from each state the longest arc first, back where none leads on.

        The path is unique, so a place that was left once is dead for good."""
        whole = self.begins.get(word, -1)
        if whole >= 0:
            return [whole]
        begins, labels, arcs, shorter = self.begins, self.labels, self.table, self.shorter
        out: list[int] = []
        dead: set[int] = set()
        place, size, state, token = 0, len(word), -1, -1
        while place < size:
            if token < 0:
                stop = place + 1
                known = begins.get(word[place:stop], -2)
                while known > -2:
                    if known >= 0:
                        token = known
                    stop += 1
                    if stop > size:
                        break
                    known = begins.get(word[place:stop], -2)
            while token >= 0:
                stop = place + len(labels[token])
                if stop not in dead:
                    if state < 0:
                        break
                    known = arcs.get(state << 32 | token)
                    if known or known is None and self.follows(state, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                place, state, token = stop, token, -1
            else:
                dead.add(place)
                token = out.pop()
                place -= len(labels[token])
                state = out[-1] if out else -1
        return out

    def entry(self, word: str) -> tuple[bytes, str, bytes]:
        """Ids as 4-byte numbers, as text, and the labels of a word's path."""
        ids = self.encode_bytes(word.encode())
        if len(self.words) >= WORDS:
            self.words.clear()
        made = array("i", ids).tobytes(), ",".join(map(str, ids)), self.decode_bytes(ids)
        if len(word) <= 64:
            self.words[word] = made
        return made

    def entries(self, text: str) -> list[tuple[bytes, str, bytes]]:
        """One entry per pre-split word or special token of the text."""
        out, known = [], self.words
        get = known.get
        pieces = self.specials.split(text) if any(s in text for s in self.special) else (text,)
        for piece in pieces:
            if piece in self.special:
                number = self.special[piece]
                out.append((np.array([number], "<i4").tobytes(), str(number), self.labels[number]))
            elif piece:
                out += [get(word) or self.entry(word) for word in self.split(piece)]
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.labels[number] for number in ids])

    def forget(self) -> None:
        """Drop the remembered words and transitions; they only save time."""
        self.words.clear()
        self.table.clear()


@lru_cache(maxsize=2)
def _compiled(source: bytes) -> Automaton:
    return Automaton(source)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@contextmanager
def _at_work(source: bytes) -> Iterator[Automaton]:
    """The automaton for one task. A worker outlives it and serves other operators: what the task's texts taught the
    automaton, hundreds of megabytes, must not stay there."""
    coder = _compiled(source)
    try:
        yield coder
    finally:
        coder.forget()
        give_back()


def _encoder(spark: SparkSession, path: str) -> Callable[[], AbstractContextManager[Automaton]]:
    shared = spark.sparkContext.broadcast(Path(path).read_bytes())
    return lambda: _at_work(shared.value)


def encode(documents: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` (none may be called ids) and ids array<int> of every row."""
    automaton = _encoder(documents.sparkSession, path)
    column = spare(keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with automaton() as coder:
            for batch in slices(batches, column, 4 << 20):
                flat = [b"".join([e[0] for e in coder.entries(t)]) if t else b"" for t in batch.column(column).to_pylist()]
                offsets = np.cumsum([0, *(len(ids) // 4 for ids in flat)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(flat), "<i4")))
                yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in keep), ids], names=[*keep, "ids"])

    picked = documents.select(*keep, F.col(text).alias(column))
    schema = T.StructType([*(documents.schema[name] for name in keep), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    return picked.mapInArrow(run, schema)


def round_trip(documents: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, ids, n_tokens and whether decoding the ids gives the text back (a null text: the empty one)."""
    automaton = _encoder(documents.sparkSession, path)
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType()),
             T.StructField("same", T.BooleanType())]
    column = spare(keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with automaton() as coder:
            for batch in slices(batches, column):
                texts = batch.column(column).to_pylist()
                entries = [coder.entries(t) if t else [] for t in texts]
                flat = [b"".join([e[0] for e in row]) for row in entries]
                sizes = [len(ids) // 4 for ids in flat]
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]).astype(np.int32)),
                                               pa.array(np.frombuffer(b"".join(flat), "<i4")))
                same = [b"".join([e[2] for e in row]) == (t or "").encode() for row, t in zip(entries, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name) for name in keep), ids, pa.array(sizes, pa.int64()), pa.array(same)],
                    names=[*keep, *(field.name for field in added)])

    picked = documents.select(*keep, F.col("text").alias(column))
    return picked.mapInArrow(run, T.StructType([*(documents.schema[name] for name in keep), *added]))


def decode(encoded: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` (none may be called text) and the text that each row's ids spell (null ids: empty)."""
    automaton = _encoder(encoded.sparkSession, path)
    column = spare(keep, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with automaton() as coder:
            for batch in batches:
                texts = [coder.decode_bytes(row or []).decode("utf-8", "replace") for row in batch.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    picked = encoded.select(*keep, F.col(ids).alias(column))
    schema = T.StructType([*(encoded.schema[name] for name in keep), T.StructField("text", T.StringType())])
    return picked.mapInArrow(run, schema)


def codec_digest(documents: DataFrame, path: str) -> DataFrame:
    """Each text encoded and decoded again: number of tokens and digests of the ids and the decoded text."""
    automaton = _encoder(documents.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with automaton() as coder:
            for batch in slices(batches, "text"):
                counts, ids, texts = [], [], []
                for text in batch.column("text").to_pylist():
                    entries = coder.entries(text) if text else []
                    counts.append(sum([len(e[0]) for e in entries]) // 4)
                    ids.append(hashlib.sha256(",".join([e[1] for e in entries]).encode()).hexdigest())
                    spelled = b"".join([e[2] for e in entries]).decode("utf-8", "replace")
                    texts.append(hashlib.sha256(spelled.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = T.StructType([
        documents.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of every document through the byte-level vocabulary."""
    return codec_digest(table(spark, sf_dir, "documents"), vocabulary_path())
