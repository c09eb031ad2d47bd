"""Toxicity by a lexicon trie that Levenshtein automata search, with scores of the hits' surroundings.

The lexicon is learned from labelled rows: words and word beginnings (stems, for inflected terms) that mark
toxic texts. It is a trie; reading a word, a deterministic automaton tracks every trie node that is within one edit of
what was read, so one pass over the word meets all terms it may be a misspelling of. States and arcs are made
when first needed. Hits are weighed apart by their surroundings: within quotation marks, guillemets or a quoted line
(quotation), or in the open (abuse), and by other hits within `WINDOW` words. A logistic regression on these
few figures gives the score.

Fitting takes a bounded sample of the labelled rows: at most `TOXIC` and `CLEAN` rows of either label, picked by a
hash of the id. The lexicon is first learned on three quarters of it, the regression on the rest, so that
it sees terms and misspellings as unknown texts have them; then the lexicon is learned again on all of it.
Scoring covers every row and whole texts and looks at nothing but the text.

Null text counts as empty and gets the score of a text without hits. Without labels of both kinds every
score is the share of toxic labels (0 without any). Repeated rows each give a row; of a repeated id the
highest label counts. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.llm.common import crc_mod, slices, spare, table

TOXIC, CLEAN = 2_500, 5_000
STEMS, ENTRIES, WINDOW, KNOWN = range(4, 9), 2_000, 8, 600_000
# A term marks toxic texts if it is in three or more of them, is much commoner there and rarely elsewhere.
LEAST_TEXTS, LEAST_RATIO, LEAST_SHARE = 3, 20.0, 0.8
FUZZY_LENGTH = 5

_words = regex.compile(r"\w+")
_find = _words.findall


@dataclass
class Lexicon:
    """Terms with their weight (log of how much commoner they are in toxic texts); stems end in *."""

    terms: dict[str, float]
    harmless: frozenset[str] = frozenset()  # near terms, but words of clean texts
    trie: list[dict[str, int]] = field(default_factory=lambda: [{}])
    whole: dict[int, float] = field(default_factory=dict)
    stem: dict[int, float] = field(default_factory=dict)
    depth: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self) -> None:
        for term, weight in self.terms.items():
            node = 0
            for letter in term.removesuffix("*"):
                if letter not in self.trie[node]:
                    self.trie[node][letter] = len(self.trie)
                    self.trie.append({})
                    self.depth.append(self.depth[node] + 1)
                node = self.trie[node][letter]
            (self.stem if term.endswith("*") else self.whole)[node] = weight
        self.letters = {letter for node in self.trie for letter in node}
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.ends: list[tuple[float, int]] = []
        self.stems: list[tuple[float, int]] = []
        self.arcs: dict[tuple[int, str], int] = {}
        self.seen: dict[str, tuple[float, int]] = {}
        self.start = self._state({(0, 0)})

    def _state(self, places: set[tuple[int, int]]) -> int:
        """The number of the state of all (node, edits) in reach; a missing letter costs an edit."""
        reach = set(places)
        reach |= {(child, 1) for node, edits in places if not edits for child in self.trie[node].values()}
        reach = frozenset((node, edits) for node, edits in reach if not edits or (node, 0) not in reach)
        if reach not in self.states:
            self.states[reach] = len(self.sets)
            self.sets.append(reach)
            for best, held in ((self.ends, self.whole), (self.stems, self.stem)):
                hits = [(held[node], edits) for node, edits in reach
                        if node in held and (not edits or self.depth[node] >= FUZZY_LENGTH)]
                best.append(min(hits, key=lambda hit: (hit[1], -hit[0]), default=(0.0, 0)))
        return self.states[reach]

    def _step(self, state: int, letter: str) -> int:
        after = set()
        for node, edits in self.sets[state]:
            child = self.trie[node].get(letter)
            if child is not None:
                after.add((child, edits))
            if not edits:  # another letter in the place of the term's, or one too many
                after.add((node, 1))
                after |= {(other, 1) for other in self.trie[node].values()}
        return self._state(after) if after else -1

    def look_up(self, word: str) -> tuple[float, int]:
        """Weight and edits (0 or 1) of the best term for a word; weight 0: none."""
        if len(self.arcs) > KNOWN:
            self.arcs.clear()
        state, hit = self.start, (0.0, 0)
        for letter in word:
            known = letter if letter in self.letters else ""
            after = self.arcs.get((state, known))
            if after is None:
                after = self.arcs[state, known] = self._step(state, known)
            state = after
            if state < 0:
                break
            found = self.stems[state]
            if found[0] and (not hit[0] or (found[1], -found[0]) < (hit[1], -hit[0])):
                hit = found
        if state >= 0 and self.ends[state][0]:
            found = self.ends[state]
            if not hit[0] or (found[1], -found[0]) < (hit[1], -hit[0]):
                hit = found
        if hit[1] and (len(word) < FUZZY_LENGTH or word in self.harmless):
            hit = (0.0, 0)
        if len(self.seen) >= KNOWN:
            self.seen.clear()
        if len(word) <= 40:
            self.seen[word] = hit
        return hit

    def __reduce__(self):
        return Lexicon, (self.terms, self.harmless)


# Marks that open and close a quotation, and ones that do both.
OPEN, CLOSE, BOTH = "“«„‹", "”»“›", "\""


def quoted_places(text: str) -> np.ndarray:
    """For each character whether it stands in a quotation that ends on its line, or in a line quoted with >."""
    inside = np.zeros(len(text), bool)
    place = 0
    for line in text.splitlines(keepends=True):
        if line.lstrip().startswith(">"):
            inside[place: place + len(line)] = True
        opened = -1
        for at, letter in enumerate(line):
            if opened >= 0 and (letter in BOTH or letter in CLOSE):
                inside[place + opened: place + at] = True
                opened = -1
            elif letter in OPEN or letter in BOTH:
                opened = at
        place += len(line)
    return inside


FIGURES = 7


def figures(lexicon: Lexicon, text: str | None) -> np.ndarray:
    """Whether, and how much, a text has exact and misspelled terms in the open and in quotations, and how close."""
    out = np.zeros(FIGURES)
    if not text:
        return out
    lower = text.lower()
    known, look = lexicon.seen.get, lexicon.look_up
    words = _find(lower)
    hits = [n for n, word in enumerate(words) if (known(word) or look(word))[0]]
    if not hits:
        return out
    marks = [match.start() for match in _words.finditer(lower)]
    inside = quoted_places(lower)
    for n in hits:
        weight, edits = known(words[n]) or look(words[n])
        out[2 * edits + bool(inside[marks[n]])] += weight
    places = np.array(hits)
    near = np.searchsorted(places, places + WINDOW, "right") - np.searchsorted(places, places - WINDOW) - 1
    out[:4] = np.log1p(out[:4])
    out[4] = out[0] > 0
    out[5] = out[2] > 0
    out[6] = np.log1p(near.max())
    return out


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # of 1 and the figures
    spread: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + (rows / self.spread) @ self.weights[1:], -30, 30)))


def sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic and part (0 to 3) of at most TOXIC and CLEAN labelled rows, picked by a hash of the id."""
    spark = documents.sparkSession
    by_id = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    picked = [row for label, most in ((1, TOXIC), (0, CLEAN)) for row in by_id.where(F.col("toxic") == label).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(most).collect()]
    chosen = spark.createDataFrame(picked, by_id.schema)
    return documents.join(F.broadcast(chosen), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), "toxic", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)).alias("part"))


def _entries(rows: DataFrame) -> DataFrame:
    """entry, toxic and in how many texts of a part of the rows it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: dict[tuple[str, int], int] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(_find(text.lower()))
                stems = {word[:size] + "*" for word in words for size in STEMS if len(word) > size}
                for entry in words | stems:
                    counts[entry, toxic] = counts.get((entry, toxic), 0) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64())], names=["entry", "toxic", "n"])

    return rows.select("text", "toxic").mapInArrow(run, "entry string, toxic int, n long")


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Terms that mark the toxic rows, at most `ENTRIES`, the clearest first; a stem stands for the terms it begins,
    unless one word makes up nearly all of them."""
    rows = rows.dropDuplicates(["text", "toxic"])
    sizes = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return Lexicon({})
    counts = _entries(rows).groupBy("entry").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
    bad, good = (F.col("bad") + 0.5) / (sizes[1] + 1), (F.col("good") + 0.5) / (sizes[0] + 1)
    base = sizes[1] / (sizes[0] + sizes[1])
    both = F.col("bad") + F.col("good")
    gain = 2 * (F.col("bad") * F.log(F.col("bad") / (both * base)) + F.when(F.col("good") > 0, F.col("good") * F.log(
        F.col("good") / (both * (1 - base)))).otherwise(0.0))
    clear = counts.where((F.col("bad") >= LEAST_TEXTS) & (gain >= 15) & (bad / good >= LEAST_RATIO) & (
        bad / (bad + good) >= LEAST_SHARE)).select("entry", F.log(bad / good).alias("weight"), gain.alias("gain"))
    terms: dict[str, float] = {}
    best = clear.orderBy(F.desc("gain"), F.length("entry"), "entry").limit(ENTRIES).collect()
    single: dict[str, float] = {}  # the clearest single word that a stem begins
    for row in best:
        if not row["entry"].endswith("*"):
            for size in STEMS:
                stem = row["entry"][:size] + "*"
                single[stem] = max(single.get(stem, 0.0), row["gain"])
    for row in best:
        if single.get(row["entry"], 0.0) >= 0.9 * row["gain"]:
            continue  # hardly more than that word
        word = row["entry"].removesuffix("*")
        over = [word[:size] + "*" for size in STEMS if size <= len(word)]
        if not any(terms.get(stem, -9.0) >= row["weight"] - 1 for stem in over if stem != row["entry"]):
            terms[row["entry"]] = row["weight"]
    made = Lexicon(terms)
    common = counts.where((F.col("good") >= 2) & (F.col("good") > F.col("bad")) & ~F.col("entry").endswith("*")).select("entry")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([made.look_up(word)[1] == 1 for word in batch.column("entry").to_pylist()], pa.bool_()))

    # at most so many harmless words: those of a bounded sample
    return Lexicon(terms, frozenset(row["entry"] for row in common.mapInArrow(close, "entry string").collect()))


def _figures_of(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = [figures(lexicon, text).tolist() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(made, pa.list_(pa.float64()))], names=["toxic", "made"])

    told = sorted((row["toxic"], row["made"]) for row in rows.select("text", "toxic").mapInArrow(
        run, "toxic int, made array<double>").collect())
    return np.array([t[1] for t in told]).reshape(-1, FIGURES), np.array([t[0] for t in told], float)


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Lexicon and weights learned from the labelled rows of `documents`."""
    rows = sample(documents, labels).persist()
    by_label = {row["toxic"]: row["count"] for row in labels.where(F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()}
    total = sum(by_label.values())
    rate = by_label.get(1, 0) / total if total else 0.0
    weights, spread = np.zeros(FIGURES + 1), np.ones(FIGURES)
    first = learn_lexicon(rows.where("part > 0"))
    made, toxic = _figures_of(rows.where("part = 0"), first) if first.terms else (np.zeros((0, FIGURES)), np.zeros(0))
    if not first.terms or len(set(toxic)) < 2:
        whole = learn_lexicon(rows)
        rows.unpersist()
        if not whole.terms:
            weights[0] = np.log(rate / (1 - rate)) if 0 < rate < 1 else (30 if rate == 1 else -30)
            return Model(whole, weights, spread)
        return Model(whole, PRIOR.copy(), spread)
    spread = np.maximum(made.std(0), 0.25)
    held = np.column_stack([np.ones(len(made)), made / spread])
    share = np.where(toxic == 1, rate / max(toxic.mean(), 1e-9), (1 - rate) / max(1 - toxic.mean(), 1e-9))
    prior = np.concatenate([PRIOR[:1], PRIOR[1:] * spread])
    pull = np.full(FIGURES + 1, 1.0)
    pull[0] = 0.01
    weights = prior.copy()
    for _ in range(50):  # Newton's method for the regression drawn to the prior
        chance = 1 / (1 + np.exp(-np.clip(held @ weights, -30, 30)))
        slope = held.T @ (share * (chance - toxic)) + pull * (weights - prior)
        curve = (held * (share * chance * (1 - chance))[:, None]).T @ held + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    whole = learn_lexicon(rows)
    rows.unpersist()
    return Model(whole, weights, spread)


# What to expect before any data: exact terms in the open weigh most, quoted ones half, misspelled ones less.
PRIOR = np.array([-3.0, 1.5, 0.75, 1.0, 0.5, 1.0, 0.5, 0.5])


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, score and predicted (1 from a score of 0.5) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    column = spare(keep, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, column):
            rows = np.array([figures(own.lexicon, text) for text in batch.column(column).to_pylist()]).reshape(-1, FIGURES)
            scores = own.score(rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=[*keep, "score", "predicted"])

    picked = documents.select(*keep, F.col("text").alias(column))
    return picked.mapInArrow(run, T.StructType([*(documents.schema[name] for name in keep),
                                                T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of those whose crc32 modulo 5 is not 0."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = crc_mod(F.col("doc_id"), 5) != 0
    model = fit(documents.where(known).select("doc_id", "text"), labels.where(known).select("doc_id", "toxic"))
    return score(documents, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
