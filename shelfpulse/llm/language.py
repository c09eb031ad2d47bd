"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in windows of `WINDOW` bytes, forwards and backwards, and
gives every position a distribution over the learned languages. A document's probabilities are the mean over
all its positions. It is trained here in numpy by backpropagation through time, on a bounded sample: of each
language `SAMPLE_TEXTS` different texts, those of the smallest hashes, and of each `SAMPLE_WINDOWS` windows spread over
its whole length. Everything else covers all rows and whole texts.

`accepted` rejects texts whose score is little more than the chance among the learned languages (`least_score`).
Null texts and texts without a letter are `und` with score 0. Without any labelled row every text is `und`.
Repeated rows each give a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.llm.common import crc_mod, slices, spare, table

UNKNOWN = "und"
WINDOW, HIDDEN = 128, 10
SAMPLE_TEXTS, SAMPLE_WINDOWS = 400, 6
STEPS, LANES, RATE, SEED = 260, 192, 0.02, 7
MOST_LANGUAGES = 1_000
PAD = 256


def least_score(languages: int) -> float:
    """The score under which a text is rejected as no text of one of so many learned languages.

    Little more than chance: 1.4 times one in `languages`, and at most 2/15 of the way from there to certainty (0.57 of
    two languages, 0.35 of four, 0.014 of a hundred). Of a single language nothing with a letter can be told apart."""
    chance = 1 / max(1, languages)
    return min(1.4 * chance, chance + (1 - chance) * 2 / 15) if languages > 1 else 0.0


@dataclass
class Network:
    """Both directions stacked in the first axis; gates are keep, reset (hard sigmoid) and new (softsign)."""

    languages: list[str]
    gates_in: np.ndarray  # 2, 257, 2H
    new_in: np.ndarray  # 2, 257, H
    gates: np.ndarray  # 2, H, 2H
    new: np.ndarray  # 2, H, H
    out: np.ndarray  # 2, H, languages
    bias: np.ndarray  # languages

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.gates_in, self.new_in, self.gates, self.new, self.out, self.bias]


def initial(languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return Network(
        languages, draw(2, PAD + 1, 2 * hidden, scale=0.5), draw(2, PAD + 1, hidden, scale=0.5),
        draw(2, hidden, 2 * hidden, scale=hidden**-0.5), draw(2, hidden, hidden, scale=hidden**-0.5),
        draw(2, hidden, len(languages), scale=hidden**-0.5), np.zeros(len(languages), np.float32),
    )


def softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(-1, keepdims=True)
    return logits


def gradients(net: Network, codes: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over the positions of windows (steps, lanes) and the gradient of each weight array."""
    steps, lanes = codes.shape
    hidden = net.new.shape[-1]
    both = np.stack([codes, codes[::-1]])
    states = np.zeros((steps + 1, 2, lanes, hidden), np.float32)
    gate = np.empty((steps, 2, lanes, 2 * hidden), np.float32)
    inner = np.empty((steps, 2, lanes, hidden), np.float32)
    raw = np.empty_like(inner)
    side = np.arange(2)[:, None]
    for t in range(steps):
        before = states[t]
        gate[t] = np.clip(net.gates_in[side, both[:, t]] + before @ net.gates + 0.5, 0, 1)
        inner[t] = before @ net.new
        raw[t] = net.new_in[side, both[:, t]] + gate[t, ..., hidden:] * inner[t]
        fresh = raw[t] / (1 + np.abs(raw[t]))
        states[t + 1] = fresh + gate[t, ..., :hidden] * (before - fresh)
    ahead, back = states[1:, 0], states[:0:-1, 1]
    chance = softmax(ahead @ net.out[0] + back @ net.out[1] + net.bias)
    real = (codes != PAD).astype(np.float32)
    weight = real / real.sum()
    own = np.take_along_axis(chance, np.broadcast_to(label[None, :, None], (steps, lanes, 1)), 2)[..., 0]
    loss = float(-(np.log(own + 1e-9) * weight).sum())
    error = chance
    np.put_along_axis(error, np.broadcast_to(label[None, :, None], (steps, lanes, 1)), own[..., None] - 1, 2)
    error *= weight[..., None]
    grads = [np.zeros_like(w) for w in net.weights]
    flat = error.reshape(-1, error.shape[-1])
    grads[4][0] = ahead.reshape(-1, hidden).T @ flat
    grads[4][1] = back.reshape(-1, hidden).T @ flat
    grads[5][:] = flat.sum(0)
    d_out = np.stack([error @ net.out[0].T, (error @ net.out[1].T)[::-1]], 1)
    d_state = np.zeros((2, lanes, hidden), np.float32)
    d_gates = np.empty_like(gate)
    d_raws = np.empty_like(raw)
    for t in range(steps - 1, -1, -1):
        d_state += d_out[t]
        before, keep, reset = states[t], gate[t, ..., :hidden], gate[t, ..., hidden:]
        size = 1 + np.abs(raw[t])
        d_raw = d_state * (1 - keep) / (size * size)
        d_gate = d_gates[t]
        d_gate[..., :hidden] = d_state * (before - raw[t] / size)
        d_gate[..., hidden:] = d_raw * inner[t]
        d_gate *= (gate[t] > 0) & (gate[t] < 1)
        d_inner = d_raw * reset
        grads[2] += before.transpose(0, 2, 1) @ d_gate
        grads[3] += before.transpose(0, 2, 1) @ d_inner
        d_raws[t] = d_raw
        d_state = d_state * keep + d_gate @ net.gates.transpose(0, 2, 1) + d_inner @ net.new.transpose(0, 2, 1)
    for way in range(2):  # sums by byte value: one sorted pass
        order = np.argsort(both[way].ravel(), kind="stable")
        values, starts = np.unique(both[way].ravel()[order], return_index=True)
        grads[0][way, values] = np.add.reduceat(d_gates[:, way].reshape(-1, 2 * hidden)[order], starts)
        grads[1][way, values] = np.add.reduceat(d_raws[:, way].reshape(-1, hidden)[order], starts)
    return loss, grads


def train(windows: list[bytes], labels: list[str], steps: int = STEPS, hidden: int = HIDDEN) -> Network:
    """A network for the labels, by Adam on random windows with as many of each label."""
    net = initial(sorted(set(labels)), hidden)
    number = {label: n for n, label in enumerate(net.languages)}
    codes = np.full((len(windows), WINDOW), PAD, np.int16)
    for row, window in zip(codes, windows, strict=True):
        row[: len(window)] = np.frombuffer(window, np.uint8)
    label = np.array([number[x] for x in labels])
    members = [np.flatnonzero(label == n) for n in range(len(number))]
    rng = np.random.default_rng(SEED)
    first = [np.zeros_like(w) for w in net.weights]
    second = [np.zeros_like(w) for w in net.weights]
    for step in range(1, steps + 1):
        pick = np.array([rng.choice(members[n]) for n in rng.integers(0, len(members), LANES)])
        _, grads = gradients(net, np.ascontiguousarray(codes[pick].T), label[pick])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1, 5 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(net.weights, grads, first, second, strict=True):
            g = g / max(1, size)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return net


LANE_BLOCK = 3072


def label_positions(net: Network, codes: np.ndarray) -> np.ndarray:
    """Chances (steps, lanes, languages) for windows of codes (steps, lanes)."""
    steps, lanes = codes.shape
    hidden = net.new.shape[-1]
    logits = np.empty((steps, lanes, len(net.languages)), np.float32)
    gates_in = net.gates_in + np.float32(0.5)
    new_in = net.new_in
    for way in range(2):
        state = np.zeros((lanes, hidden), np.float32)
        gate, into = np.empty((lanes, 2 * hidden), np.float32), np.empty((lanes, 2 * hidden), np.float32)
        fresh, size = np.empty((lanes, hidden), np.float32), np.empty((lanes, hidden), np.float32)
        told = np.empty((steps, lanes, hidden), np.float32)
        for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
            np.matmul(state, net.gates[way], out=gate)
            np.take(gates_in[way], codes[t], axis=0, out=into, mode="clip")
            gate += into
            np.clip(gate, 0, 1, out=gate)
            np.matmul(state, net.new[way], out=fresh)
            fresh *= gate[:, hidden:]
            np.take(new_in[way], codes[t], axis=0, out=size, mode="clip")
            fresh += size
            np.abs(fresh, out=size)
            size += 1
            fresh /= size
            state -= fresh
            state *= gate[:, :hidden]
            state += fresh
            told[t] = state
        part = told.reshape(-1, hidden) @ net.out[way]
        if way == 0:
            logits[:] = part.reshape(logits.shape)
        else:
            logits += part.reshape(logits.shape)
    logits += net.bias
    return softmax(logits)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (windows, WINDOW) of all texts and the number of the text of each window."""
    counts = np.array([-(-len(text) // WINDOW) for text in texts], np.int64)
    codes = np.full((int(counts.sum()), WINDOW), PAD, np.int16)
    place = 0
    for text, count in zip(texts, counts.tolist(), strict=True):
        codes.reshape(-1)[place * WINDOW: place * WINDOW + len(text)] = np.frombuffer(text, np.uint8)
        place += count
    return codes, np.repeat(np.arange(len(texts)), counts)


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean chances over all positions of each text; zeros for an empty text."""
    codes, owner = windows_of(texts)
    totals = np.zeros((len(texts), len(net.languages)))
    for start in range(0, len(owner), LANE_BLOCK):
        block = np.ascontiguousarray(codes[start: start + LANE_BLOCK].T)
        chance = label_positions(net, block)
        chance *= (block != PAD)[..., None]
        np.add.at(totals, owner[start: start + LANE_BLOCK], chance.sum(0, dtype=np.float64))
    return totals / np.maximum(1, [len(text) for text in texts])[:, None]


def training_windows(documents: DataFrame) -> tuple[list[bytes], list[str]]:
    """A bounded sample of labelled windows, from the texts of the smallest hashes of each language.

    Copies of a text count as one. A language with at most `SAMPLE_TEXTS` different texts gives all of them. The
    `MOST_LANGUAGES` languages with the most different texts are learned; no text is taken for one of others."""
    labelled = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.octet_length("text") > 0))
    seen = F.xxhash64("text", F.lit(SEED)).alias("seen")
    counts = labelled.select("lang", seen).distinct().groupBy("lang").count().orderBy(F.desc("count"), "lang").take(MOST_LANGUAGES)
    if not counts:
        return [], []
    shares = F.create_map(*(F.lit(x) for row in counts for x in (row["lang"], min(1.0, 1.5 * SAMPLE_TEXTS / row["count"]))))
    drawn = F.pmod(seen, F.lit(1 << 40)).alias("drawn")
    data = F.col("text").cast("binary")
    spread = F.greatest(F.octet_length("text") - WINDOW, F.lit(0))
    cuts = F.array(*(
        F.substring(data, F.floor(spread * n / max(1, SAMPLE_WINDOWS - 1)).cast("int") + 1, F.lit(WINDOW))
        for n in range(SAMPLE_WINDOWS)))
    rows = labelled.select("lang", seen, drawn, cuts.alias("cuts")).where(
        F.col("drawn") < shares[F.col("lang")] * (1 << 40)).groupBy("lang", "seen", "drawn").agg(
            F.min("cuts").alias("cuts")).collect()
    taken: dict[str, int] = {}
    windows, labels = [], []
    for row in sorted(rows, key=lambda r: (r["drawn"], r["lang"], [bytes(c) for c in r["cuts"]])):
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= SAMPLE_TEXTS:
            for cut in {bytes(c): None for c in row["cuts"]}:
                windows.append(cut)
                labels.append(row["lang"])
    return windows, labels


def fit(documents: DataFrame) -> Network | None:
    """A network for the languages of `documents` (text, lang), None if no row has both."""
    windows, labels = training_windows(documents)
    return train(windows, labels) if windows else None


_letter = regex.compile(r"\p{L}").search


def identify(documents: DataFrame, net: Network | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, lang_pred and score of every row; only the text decides."""
    shared, known_languages = documents.sparkSession.sparkContext.broadcast(net), net is not None
    column = spare(keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, 4 << 20):
            texts = batch.column(column).to_pylist()
            known = [known_languages and t is not None and _letter(t) is not None for t in texts]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if any(known):
                chance = pooled(shared.value, [t.encode() if k else b"" for t, k in zip(texts, known, strict=True)])
                for row in np.flatnonzero(known):
                    best = int(chance[row].argmax())
                    names[row], scores[row] = shared.value.languages[best], min(1.0, float(chance[row, best]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"])

    picked = documents.select(*keep, F.col(text).alias(column))
    schema = T.StructType([*(documents.schema[name] for name in keep), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return picked.mapInArrow(run, schema)


def accepted(documents: DataFrame, net: Network | None, least: float | None = None, text: str = "text") -> DataFrame:
    """The rows of `documents` whose language is known with a score of at least `least` (None: `least_score` of the
    learned languages), unchanged."""
    if least is None:
        least = least_score(len(net.languages) if net else 0)
    shared, known_languages = documents.sparkSession.sparkContext.broadcast(net), net is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            keep = np.array([known_languages and t is not None and _letter(t) is not None for t in texts], bool)
            if keep.any():
                chance = pooled(shared.value, [t.encode() if k else b"" for t, k in zip(texts, keep, strict=True)])
                keep &= chance.max(1) >= least
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose crc32 modulo 3 is not 1."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = fit(documents.where(crc_mod(F.col("doc_id"), 3) != 1))
    return identify(documents, net).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
