"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation is right if the initials of its roles read `(s?(ua)+)?`. Edits: keep a row (0), give it the role user or
assistant (1), delete it (2; blank and duplicate rows must go), insert an empty row of user or assistant (5); a truncated
row that stays costs 5 more. The cheapest edits are found by dynamic programming over four states (nothing yet, after
system, after user, after assistant), from the last row back, so that the vector of costs to go at each row also says
which edit is the least in ASCII order.

Rows are sorted by range of (conversation, turn, role, text digest), so a conversation of any size lies over many tasks,
and cut into chunks of at most `CHUNK` rows. Every chunk first runs from a speculative vector, that of an end. Then
fix-up passes run the chunks of conversations with several of them from the vectors found at other chunks' edges, each
only up to the row at which its vector differs from the speculative one by a constant. Vectors less their least entry
take few values and all of a conversation's are run in a pass, so the number of passes does not grow with that of
chunks. Stitched from the last chunk to the first, they give the true costs to go, and each chunk traces its edits
from each state it may be entered in; the walk over the rows in order takes the one that applies. Digests and audits of a
conversation need its rows in turn: they are streamed through one task, in constant memory but for the audit.

Null role and text count as one space, a null turn comes before all others, a null conv_id is a conversation of its own.
Rows of one turn are taken by role, then by digest of the text; equal rows are interchangeable. An empty role or another
one than system, user and assistant can only be renamed or deleted. Conversations without rows get zeros, an empty audit
and the hash of nothing; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfpulse.llm.common import materialize, new_folder, slices, table

CHUNK = 4096
KEEP, RENAME, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"

# States: nothing yet, after system, after user, after assistant. What may come next, by a row's initial or a given name.
START, SYSTEM, USER, ASSISTANT = range(4)
BY_INITIAL = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
BY_NAME = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}

Vector = tuple[int, ...]
END: Vector = (0, 2 * INSERT, INSERT, 0)  # costs to go after the last row: inserts up to a whole pair


def _level(costs: list[int]) -> Vector:
    """A vector less its least entry; vectors that differ by a constant become equal."""
    low = min(costs)
    return tuple(c - low for c in costs)


@cache
def _step(after: Vector, kind: str) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """Costs to go before a row of `kind`, and for each state the least edits up to the row's own and the state they lead to."""
    options: list[dict[str, tuple[int, int]]] = []
    for state in range(4):
        own = {"D": (DELETE + after[state], state)}
        if kind not in "bd":
            extra = CUT if kind.isupper() else 0
            if state in BY_INITIAL[kind.lower()]:
                to = BY_INITIAL[kind.lower()][state]
                own["K"] = (KEEP + extra + after[to], to)
            own["R"] = (RENAME + extra + after[BY_NAME[state]], BY_NAME[state])
        options.append(own)
    costs = [min(cost for cost, _ in own.values()) for own in options]
    for _ in range(2):  # at most two inserts before a row: a third would only undo them
        costs = [min(cost, INSERT + costs[BY_NAME[state]]) for state, cost in enumerate(costs)]
    edits = []
    for state in range(4):
        at, token = state, ""
        while options[at]["D"][0] != costs[at] and INSERT + costs[BY_NAME[at]] == costs[at]:
            at, token = BY_NAME[at], token + "I"
        edit = next(name for name in "DKR" if name in options[at] and options[at][name][0] == costs[at])
        edits.append((token + edit, options[at][edit][1]))
    return _level(costs), tuple(edits)


def backward(kinds: str, after: Vector) -> list[Vector]:
    """The levelled vector before each row and, last, the one given."""
    out = [after]
    for kind in reversed(kinds):
        out.append(_step(out[-1], kind)[0])
    return out[::-1]


def converged(kinds: str, after: Vector, run: list[Vector]) -> Vector:
    """The vector before the first row from `after`: as soon as it equals that of an earlier run, so does the rest."""
    vector = after
    for place in range(len(kinds) - 1, -1, -1):
        vector = _step(vector, kinds[place])[0]
        if vector == run[place]:
            return run[0]
    return vector


def traced(kinds: str, vectors: list[Vector], state: int) -> tuple[list[str], int]:
    """The least edits of each row when entered in `state`, and the state after the last one."""
    tokens = []
    for kind, after in zip(kinds, vectors[1:], strict=True):
        token, state = _step(after, kind)[1][state]
        tokens.append(token)
    return tokens, state


_packs = re.compile(r"([A-Za-z]+)(\d+)")


def packed(tokens: Iterable[str]) -> str:
    """Runs of equal tokens as token and number."""
    runs: list[list] = []
    for token in tokens:
        if runs and runs[-1][0] == token:
            runs[-1][1] += 1
        else:
            runs.append([token, 1])
    return "".join(f"{token}{count}" for token, count in runs)


def unpacked(text: str) -> deque[list]:
    return deque([token, int(count)] for token, count in _packs.findall(text))


def _text(vector: Vector) -> str:
    return ",".join(map(str, vector))


def _vector(text: str) -> Vector:
    return tuple(map(int, text.split(",")))


def damaged(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turn, role, text) after the planted faults, by crc32 of `conv_id:turn` modulo 20, and the dropped rows'
    conv_id: 0 drops a row, 1 empties its text, 2 takes out its full stops, 3 doubles it, 4 makes it the user's."""
    one = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    left = rows.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy"))
    return left.drop("copy"), rows.where("fault = 0").select("conv_id")


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with the digest that tells (conversation, role, text) apart."""
    one = F.lit(" ")
    own = rows.select("conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"))
    told = F.concat_ws("\n", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")),
                       F.length("role").cast("string"), "role", "text")
    return own.withColumn("key", F.unhex(F.sha2(told.cast("binary"), 256)))


def _kinds(rows: DataFrame, folder: str) -> DataFrame:
    """Without texts: b (blank), d (duplicate) or the role's initial, upper case for truncated rows, of each row."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    light = materialize(rows.select(
        "conv_id", "turn", "role", "key",
        F.when(trimmed == "", "b").when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), letter).otherwise(F.upper(letter)).alias("kind"),
        F.monotonically_increasing_id().alias("place")), "rows", folder)
    again = light.where("kind <> 'b'").groupBy("key").agg(
        F.min(F.struct("turn", "place")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = again.select("key", F.col("first.place").alias("first"))
    later = F.col("first").isNotNull() & (F.col("place") != F.col("first")) & (F.col("kind") != "b")
    return light.join(first, "key", "left").withColumn("kind", F.when(later, "d").otherwise(F.col("kind"))).drop("first")


def _chunks(kinds: DataFrame, chunk: int) -> DataFrame:
    """conv_id, part and block (in order), the sort keys of the first row and the kinds of all rows of each chunk."""
    order = ("conv_id", "turn", "role", "key", "place")
    dealt = kinds.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = dealt.select("conv_id", "turn", "role", "key", "kind", F.spark_partition_id().alias("part"), row.alias("row"))
    grouped = placed.withColumn("block", F.floor(F.col("row") / chunk)).groupBy("conv_id", "part", "block").agg(
        F.min(F.struct("row", "turn", "role", "key")).alias("first"), F.sort_array(F.collect_list(F.struct("row", "kind"))).alias("own"))
    return grouped.select(
        "conv_id", "part", "block", "first.turn", "first.role", "first.key",
        F.array_join(F.transform("own", lambda r: r["kind"]), "").alias("kinds"))


def _runs(chunks: DataFrame) -> DataFrame:
    """conv_id, part, block, given (a vector after the chunk) and found (the one before it); `given` is asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "kinds"):
            found = []
            for kinds, given in zip(batch.column("kinds").to_pylist(), batch.column("given").to_pylist(), strict=True):
                speculative = backward(kinds, END)
                asked = _vector(given)
                found.append(_text(speculative[0] if asked == END else converged(kinds, asked, speculative)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("conv_id", "part", "block", "given")), pa.array(found, pa.string())],
                names=["conv_id", "part", "block", "given", "found"])

    schema = T.StructType([chunks.schema[name] for name in ("conv_id", "part", "block")]
                          + [T.StructField("given", T.StringType()), T.StructField("found", T.StringType())])
    return chunks.select("conv_id", "part", "block", "given", "kinds").mapInArrow(run, schema)


def _stitched(runs: DataFrame) -> DataFrame:
    """The true vector after each chunk, found from the last chunk of a conversation to the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, conv, after = True, None, ""
        for batch in batches:
            given = []
            for own, pairs in zip(batch.column("conv_id").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                if fresh or own != conv:
                    fresh, conv, after = False, own, _text(END)
                given.append(after)
                after = next(pair["found"] for pair in pairs if pair["given"] == after)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("conv_id", "part", "block")), pa.array(given, pa.string())],
                names=["conv_id", "part", "block", "given"])

    tables = runs.groupBy("conv_id", "part", "block").agg(F.collect_list(F.struct("given", "found")).alias("runs"))
    schema = T.StructType([runs.schema[name] for name in ("conv_id", "part", "block", "given")])
    dealt = tables.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("block"))
    return dealt.mapInArrow(run, schema)


def _same(left: str, right: str, names: tuple[str, ...]) -> F.Column:
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names))


def _costed(chunks: DataFrame, folder: str) -> DataFrame:
    """Chunks with `given`, the true costs to go after their last rows, by fix-up passes until no chunk meets a new vector."""
    several = chunks.groupBy("conv_id").count().where("count > 1").select("conv_id")
    many = materialize(chunks.alias("c").join(several.alias("s"), _same("c", "s", ("conv_id",)), "left_semi").select(
        "conv_id", "part", "block", "kinds"), "many", folder)
    runs = materialize(_runs(many.withColumn("given", F.lit(_text(END)))), "runs-1", folder)
    step = 1
    while True:
        met = runs.select("conv_id", F.col("found").alias("given")).distinct()
        tried = runs.select("conv_id", "given").distinct()
        fresh = materialize(met.alias("m").join(tried.alias("t"), _same("m", "t", ("conv_id", "given")), "left_anti"),
                            f"fresh-{step}", folder)
        if fresh.isEmpty():
            break
        step += 1
        asked = many.alias("c").join(fresh.alias("f"), _same("c", "f", ("conv_id",))).select("c.*", "f.given")
        runs = runs.unionByName(materialize(_runs(asked), f"runs-{step}", folder))
    true = materialize(_stitched(runs), "stitched", folder)
    joined = chunks.alias("c").join(true.alias("t"), _same("c", "t", ("conv_id", "part", "block")), "left")
    return joined.select("c.*", F.coalesce("t.given", F.lit(_text(END))).alias("given"))


def _plans(chunks: DataFrame) -> DataFrame:
    """Each chunk's edits for each state it may be entered in, as text `state after:packed edits`, and its packed kinds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "kinds"):
            plans, told = [], []
            for kinds, given in zip(batch.column("kinds").to_pylist(), batch.column("given").to_pylist(), strict=True):
                vectors = backward(kinds, _vector(given))
                own = []
                for state in range(4):
                    tokens, after = traced(kinds, vectors, state)
                    own.append(f"{after}:{packed(tokens)}")
                plans.append(own)
                told.append(packed(kinds))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("conv_id", "turn", "role", "key", "part", "block")),
                 pa.array(plans, pa.list_(pa.string())), pa.array(told, pa.string())],
                names=["conv_id", "turn", "role", "key", "part", "block", "plans", "kinds"])

    schema = T.StructType([chunks.schema[name] for name in ("conv_id", "turn", "role", "key", "part", "block")]
                          + [T.StructField("plans", T.ArrayType(T.StringType())), T.StructField("kinds", T.StringType())])
    return chunks.mapInArrow(run, schema)


class _Walk:
    """One conversation's rows in order, with the edits of its chunks: what becomes of each, and the figures of all."""

    def __init__(self, conv: object) -> None:
        self.conv, self.state, self.entry = conv, START, START
        self.edits: deque[list] = deque()
        self.kinds: deque[list] = deque()
        self.audit: list[str] = []
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.least = self.most = self.before = None
        self.turns = 0
        self.digest, self.lines = hashlib.sha256(), 0

    def chunk(self, plans: list[str], kinds: str) -> None:
        after, _, edits = plans[self.entry].partition(":")
        self.entry = int(after)
        self.edits.extend(unpacked(edits))
        self.kinds.extend(unpacked(kinds))

    @staticmethod
    def _next(runs: deque[list]) -> str:
        runs[0][1] -= 1
        return runs[0][0] if runs[0][1] else runs.popleft()[0]

    def row(self, turn: int | None, role: str, text: str) -> list[tuple]:
        """(edit, turn, role, text) of what the row becomes, inserted rows before it included."""
        token, kind = self._next(self.edits), self._next(self.kinds)
        if turn is not None and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        if self.before is not None and (self.before, role[:1]) not in LEGAL:
            self.counts["illegal"] += 1
        self.before = role[:1]
        fault = {"b": "blank", "d": "duplicate"}.get(kind, "truncated" if kind.isupper() else None)
        if fault:
            self.counts[fault] += 1
        out = self._inserted(len(token) - 1)
        edit = token[-1]
        if edit == "D":
            self.counts["cost"] += DELETE
        else:
            self.counts["cost"] += (CUT if kind.isupper() else 0) + (RENAME if edit == "R" else KEEP)
            self.state = BY_NAME[self.state] if edit == "R" else BY_INITIAL[kind.lower()][self.state]
            self._line(role := NAMES[self.state] if edit == "R" else role, text)
        self.audit.append(token)
        return [*out, (edit, turn, role, text)]

    def _inserted(self, times: int) -> list[tuple]:
        out = []
        for _ in range(times):
            self.state = BY_NAME[self.state]
            self.counts["cost"] += INSERT
            self._line(NAMES[self.state], "")
            out.append(("I", None, NAMES[self.state], ""))
        return out

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def end(self) -> list[tuple]:
        missing = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}[self.state]
        self.audit.append("I" * missing)
        return self._inserted(missing)

    def figures(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), "".join(self.audit), self.digest.hexdigest())


NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _in_order(rows: DataFrame, listed: DataFrame | None, chunk: int) -> DataFrame:
    """The texts in order, each chunk's plans before its first row, one task a conversation."""
    keyed = _keyed(rows)
    folder = new_folder(rows.sparkSession, "conversations")
    chunks = materialize(_chunks(_kinds(keyed, folder), chunk), "chunks", folder)
    plans = materialize(_plans(_costed(chunks, folder)), "plans", folder)
    joined = plans.withColumn("text", F.lit(None).cast("string")).withColumn("tag", F.lit(0)).unionByName(
        keyed.withColumn("tag", F.lit(1)), allowMissingColumns=True)
    if listed is not None:
        joined = joined.unionByName(listed.select("conv_id", F.lit(-1).alias("tag")), allowMissingColumns=True)
    return joined.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "key", "tag", "part", "block")


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Walk, list[tuple] | None]]:
    """For each row its walk and what it becomes; None once the conversation has ended."""
    walk: _Walk | None = None
    for batch in slices(batches, "text"):
        columns = (batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "tag", "plans", "kinds"))
        for conv, turn, role, text, tag, plans, kinds in zip(*columns, strict=True):
            if walk is None or walk.conv != conv:
                if walk is not None:
                    yield walk, walk.end()
                    yield walk, None
                walk = _Walk(conv)
            if tag == 0:
                walk.chunk(plans, kinds)
            elif tag == 1:
                yield walk, walk.row(turn, role, text)
    if walk is not None:
        yield walk, walk.end()
        yield walk, None


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def repaired(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, place (from 0), edit (K, R, D or I), turn, role and text of every row, deleted and inserted ones included."""
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL("place long, edit string").fields,
                           rows.schema["turn"], *T.StructType.fromDDL("role string, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, out, size, place = to_arrow_schema(schema), [], 0, 0
        for walk, made in _walked(batches):
            if made is None:
                place = 0
                continue
            for edit, turn, role, text in made:
                out.append((walk.conv, place, edit, turn, role, text))
                place, size = place + 1, size + len(text) + 50
            if size > 1 << 20:
                yield _batch(out, told)
                out, size = [], 0
        if out:
            yield _batch(out, told)

    return _in_order(rows, None, chunk).mapInArrow(run, schema)


def figures(rows: DataFrame, listed: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Faults, cost, audit and digest of each conversation in `rows` and of the conv_id in `listed` that have no rows."""
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(FIGURES).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, out, size = to_arrow_schema(schema), [], 0
        for walk, made in _walked(batches):
            if made is None:
                out.append(walk.figures())
                size += 200 + len(out[-1][-2])
            if size > 1 << 20:
                yield _batch(out, told)
                out, size = [], 0
        if out:
            yield _batch(out, told)

    return _in_order(rows, listed, chunk).mapInArrow(run, schema)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after planted damage."""
    return figures(*damaged(table(spark, sf_dir, "conversations")))
