"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.bpe import op5_bpe_codec
from shelfpulse.llm.common import shipped
from shelfpulse.llm.conversations import op11_conversation_repair
from shelfpulse.llm.counts import op10_token_counts
from shelfpulse.llm.decontamination import op6_decontamination
from shelfpulse.llm.jaccard import op9_jaccard_join
from shelfpulse.llm.language import op7_language_id
from shelfpulse.llm.neighbours import op3_hnsw_neighbours
from shelfpulse.llm.secrets import op4_secret_scan
from shelfpulse.llm.sharding import op12_virtual_slots
from shelfpulse.llm.sql import SQL
from shelfpulse.llm.substrings import op1_suffix_dedup
from shelfpulse.llm.toxicity import op2_toxicity
from shelfpulse.llm.warc import op8_warc_index
from shelfpulse.llm.whitening import op13_embedding_whitening

__all__ = ["QUERIES", "SQL"]

_PLAIN: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_hnsw_neighbours": op3_hnsw_neighbours,
    "op4_secret_scan": op4_secret_scan,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_warc_index": op8_warc_index,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_token_counts": op10_token_counts,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_virtual_slots": op12_virtual_slots,
    "op13_embedding_whitening": op13_embedding_whitening,
}

QUERIES = {name: shipped(query) for name, query in _PLAIN.items()}
