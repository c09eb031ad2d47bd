"""What a Python worker keeps once a task is over."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa

import corpus_pipeline
from shelfpulse.llm import bpe
from shelfpulse.llm.common import BATCH, BATCH_BYTES


def test_no_word_of_a_task_stays_in_its_worker(spark):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            own = [x for x in gc.get_objects() if type(x).__name__ == "Automaton"]
            kept = sum(len(x.words) + len(x.table) for x in own)
            yield pa.RecordBatch.from_arrays([pa.array([len(own)]), pa.array([kept])], names=["coders", "kept"])

    docs = spark.range(0, 400, 1, 8).selectExpr("id AS doc_id", "concat('unlikelyish', id, ' wordlessness', id) AS text", "'en' AS lang", "'s' AS source")
    for run in (bpe.round_trip, bpe.encode):
        assert run(docs, bpe.vocabulary_path()).where("size(ids) > 1").count() == 400
        told = spark.range(0, 64, 1, 32).mapInArrow(probe, "coders long, kept long").collect()
        assert sum(row["coders"] for row in told) > 0
        assert sum(row["kept"] for row in told) == 0


def test_texts_reach_the_pipelines_workers_in_small_batches(spark):
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat('a b c d ', 50000) AS text", "'en' AS lang", "'s' AS source")
    stage = dict(corpus_pipeline.STAGES)["tokens"]
    was = spark.conf.getAll.get(BATCH)
    try:
        spark.conf.unset(BATCH)
        stage(spark, docs, "")
        told = [row["size"] for row in docs.mapInArrow(sizes, "size long").collect()]
        assert len(told) > 3 and max(told) < 2 * BATCH_BYTES
        spark.conf.set(BATCH, "1m")  # a session's own size stays
        stage(spark, docs, "")
        assert spark.conf.get(BATCH) == "1m"
    finally:
        spark.conf.unset(BATCH) if was is None else spark.conf.set(BATCH, was)
