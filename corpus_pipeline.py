"""From raw documents to token ids: the stages of the corpus pipeline, each over all its predecessor kept.

Every stage is written as Parquet to the shared folder and read again as the next one's documents. All but the
last return the columns of `documents`. An empty table passes through all of them; a null text has no known
language and goes in the first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


from shelfpulse.llm import bpe, decontamination, jaccard, language, secrets
from shelfpulse.llm.common import materialize, new_folder, shipped, small_batches, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no known language; the network learns from the given documents."""
    return language.accepted(docs, language.fit(docs.select("text", "lang")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the smallest id."""
    return jaccard.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret masked; the documents stay."""
    return secrets.redact(docs, new_folder(spark, "blob-ledger"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and whether the ids decode to the text."""
    return bpe.round_trip(docs, bpe.vocabulary_path(), ("doc_id", "lang", "source"))


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """`stage` after `ship` and `small_batches`."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return shipped(run)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", in_small_batches(known_language)),
    ("near_duplicates", in_small_batches(one_of_each_group)),
    ("decontamination", in_small_batches(no_benchmark)),
    ("secrets", in_small_batches(no_secrets)),
    ("tokens", in_small_batches(token_ids)),
]

# No SQL: a trained network decides in the first stage. tests/llm compares the rest with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
