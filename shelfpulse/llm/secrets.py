"""Secret scans with an incremental blob ledger; DataFrame functions only.

Every historical version of a path is addressed by the SHA-256 of its content. The ledger
holds, for each blob, the rule versions it was scanned with and the findings. A run scans
only (blob, rule version) pairs that the ledger lacks, once per blob however many paths
share it, and findings are joined back to all paths.

Null text counts as empty. Rows may repeat; each gets its own result row. A null path is kept.
An empty table gives an empty result. Other columns are ignored by the scan and kept, whatever their names, by `redact`.
A text of any length may hold any number of findings: the work for n of them grows with n log n.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.llm.common import folder_exists, new_folder, table


@dataclass(frozen=True)
class Rule:
    """`pattern` in leftmost, non-overlapping matches; those whose `group` is shorter than `least` drop."""

    kind: str
    pattern: str
    group: int
    least: int

    @property
    def version(self) -> str:
        text = "\n".join((self.kind, self.pattern, str(self.group), str(self.least)))
        return hashlib.sha256(text.encode()).hexdigest()[:16]


# The three kinds in listed order. A run of a class is matched whole, so for the last
# two the least length can stand in the pattern; an assignment's short value still uses up its text.
RULES = (
    Rule("assign",
         r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12),
    Rule("access", "AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", "[0-9a-f]{16,}", 0, 16),
)

# Code points in a block of a text that is redacted: 2 to this power.
BLOCK_BITS = 9

LEDGER = "blob binary, rules array<string>, spans array<struct<start:int,kind:string,end:int,rule:string>>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def _running(structs: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Every struct of an array combined with all before it.

    A step combines places 1, 2, 4, ... apart, so an array of n is written log2(n) times and not once per place."""
    def steps(whole: Column) -> Column:
        count = F.ceil(F.log2(F.greatest(F.size(whole), F.lit(1)))).cast("int")
        reach = F.transform(F.sequence(F.lit(0), count), lambda step: F.call_function("shiftleft", F.lit(1), step))
        return F.aggregate(reach, whole, lambda done, back: F.transform(done, lambda own, place: F.when(
            place >= back, combine(F.get(done, place - back), own)).otherwise(own)))

    return _bound(structs, steps)


def _spans(text: Column, rule: Rule) -> Column:
    """Spans of one rule in code points: pieces between matches and matches give all places."""
    found = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda match: F.struct(
        F.length(match).alias("own"), F.length(F.regexp_extract(match, rule.pattern, rule.group)).alias("size")))
    steps = F.zip_with(F.transform(F.split(text, rule.pattern, -1), F.length), found, lambda gap, match: F.struct(
        (gap + F.coalesce(match["own"], F.lit(0))).alias("end"), match["own"].alias("own"), match["size"].alias("size")))
    placed = _running(steps, lambda before, own: F.struct(
        (before["end"] + own["end"]).alias("end"), own["own"].alias("own"), own["size"].alias("size")))
    spans = F.transform(F.filter(placed, lambda step: step["size"] >= rule.least), lambda step: F.struct(
        (step["end"] - step["own"]).alias("start"), F.lit(rule.kind).alias("kind"),
        step["end"].alias("end"), F.lit(rule.version).alias("rule")))
    return F.when(text.rlike(rule.pattern), spans).otherwise(
        F.array().cast("array<struct<start:int,kind:string,end:int,rule:string>>"))


def address(versions: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """path, text (null: empty) and the blob that the text is."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return versions.select(F.col(path).alias("path"), whole.alias("text"),
                           F.unhex(F.sha2(whole.cast("binary"), 256)).alias("blob"))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder)


def unseen(addressed: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One path per blob that lacks a rule version in the ledger, with the versions it lacks."""
    wanted = F.array(*(F.lit(rule.version) for rule in rules))
    blobs = addressed.groupBy("blob").agg(F.min("path").alias("path"))
    seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(
        F.collect_set("rule").alias("seen"))
    lacking = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "path", lacking.alias("lacking")).where(
        F.size("lacking") > 0)


def scan(addressed: DataFrame, todo: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for the blobs in `todo`: the text is read from one of a blob's paths."""
    left, right = addressed.alias("a"), todo.alias("t").hint("shuffle_hash")
    same = (F.col("a.blob") == F.col("t.blob")) & F.col("a.path").eqNullSafe(F.col("t.path"))
    texts = left.join(right, same).select("t.blob", "t.lacking", "a.text")
    none = F.array().cast("array<struct<start:int,kind:string,end:int,rule:string>>")
    spans = F.concat(*(
        F.when(F.array_contains("lacking", rule.version), _spans(F.col("text"), rule)).otherwise(none)
        for rule in rules
    ))
    return texts.select("blob", F.col("lacking").alias("rules"), spans.alias("spans"))


def update_ledger(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger in `folder` lacks for `versions` (path, text, blob), append it, return all.

    A repeated run finds nothing to scan. A run that dies before its commit leaves no rows."""
    spark = versions.sparkSession
    todo = unseen(versions, read_ledger(spark, folder), rules)
    scan(versions, todo, rules).write.mode("append").parquet(folder)
    return read_ledger(spark, folder)


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path and its spans by start, then kind as listed, for every row of `versions`.

    A blob may have several ledger rows (repeated paths, rules added later); equal spans count once."""
    order = {rule.kind: number for number, rule in enumerate(rules)}
    number = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    current = [rule.version for rule in rules]
    spans = ledger.where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s")).where(
        F.col("s.rule").isin(current)).select(
        "blob", F.struct(F.col("s.start").alias("start"), number[F.col("s.kind")].alias("number"),
                         F.col("s.kind").alias("kind"), F.col("s.end").alias("end")).alias("span"))
    by_blob = spans.groupBy("blob").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    none = F.array().cast("array<struct<start:int,number:int,kind:string,end:int>>")
    return versions.select("path", "blob").join(by_blob, "blob", "left").select(
        "path", "blob", F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, rule.kind))).cast("long")
              .alias(f"n_{rule.kind}") for rule in rules]
    return found.select(F.col("path").alias("doc_id"), *counts,
                        F.sha2(joined.cast("binary"), 256).alias("base_sha256"), joined.alias("spans"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the three base kinds in every document, from a ledger that starts empty."""
    versions = address(table(spark, sf_dir, "documents"))
    ledger = update_ledger(versions, new_folder(spark, "blob-ledger"))
    return digest(findings(versions, ledger))


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """`text` with `mask` for every run of touching or overlapping `spans` (by start).

    The text is cut into blocks first, so that a piece of it is found without counting from the text's start."""
    def piece(blocks: Column, start: Column, stop: Column) -> Column:
        block = F.shiftright(start, BLOCK_BITS)
        near = F.array_join(F.slice(blocks, block + 1, F.shiftright(stop, BLOCK_BITS) - block + 1), "")
        return F.substring(near, start - F.call_function("shiftleft", block, F.lit(BLOCK_BITS)) + 1, stop - start)

    def kept(reached: Column) -> Column:
        """Start and stop of what stays: between runs, and after the last."""
        between = F.transform(reached, lambda span, place: F.struct(
            F.coalesce(F.get(reached, place - 1)["end"], F.lit(-1)).alias("start"), span["start"].alias("stop")))
        return F.concat(F.filter(between, lambda gap: gap["start"] < gap["stop"]), F.array(F.struct(
            F.get(reached, F.size(reached) - 1)["end"].alias("start"), F.length(text).alias("stop"))))

    reached = _running(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))),
                       lambda before, own: F.struct(own["start"].alias("start"), F.greatest(before["end"], own["end"]).alias("end")))
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << BLOCK_BITS}}}"), F.lit(0))
    return _bound(cut, lambda blocks: F.array_join(F.transform(
        _bound(reached, kept), lambda gap: piece(blocks, F.greatest(gap["start"], F.lit(0)), gap["stop"])), mask))


def redact(documents: DataFrame, folder: str, mask: str = "[secret]") -> DataFrame:
    """`documents` with every found span replaced by `mask`; overlapping spans become one mask.

    n_chars, where there is such a column, is that of the new text. Rows without a finding pass unchanged."""
    versions = address(documents)
    found = findings(versions, update_ledger(versions, folder)).where(F.size("spans") > 0).select(
        "blob", "spans").dropDuplicates(["blob"])
    text = F.coalesce("text", F.lit(""))
    joined = documents.select(F.struct("*").alias("row"), text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("blob"))
    changed = _bound(_masked(F.col("text"), F.col("spans"), mask), lambda whole: F.struct(
        whole.alias("text"), F.length(whole).cast("long").alias("n_chars")))
    new = joined.join(found, "blob", "left").select("row", F.when(F.col("spans").isNotNull(), changed).alias("new"))
    return new.select(*(
        (F.when(F.col("new").isNull(), F.col("row")[name]).otherwise(F.col("new")[name]) if name in ("text", "n_chars")
         else F.col("row")[name]).alias(name) for name in documents.columns))
