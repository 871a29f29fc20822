"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from accounthealth.llm import (
    exact_dedup,
    filter_audit,
    merkle,
    mixing,
    multi_index,
    ngram_join,
    packing,
    retrieval_packing,
    sentencepieces,
    sharding,
    substring_fm,
    toxicity,
    warc,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_sharding": sharding.op2_sharding,
    "op3_sentencepiece": sentencepieces.op3_sentencepiece,
    "op4_warc": warc.op4_warc,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_multi_index": multi_index.op6_multi_index,
    "op7_token_packing": packing.op7_token_packing,
    "op8_mixing": mixing.op8_mixing,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_substring_dedup": substring_fm.op10_substring_dedup,
    "op11_merkle": merkle.op11_merkle,
    "op12_packing": retrieval_packing.op12_packing,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

SQL = {
    "op2_sharding": sharding.OP2_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op11_merkle": merkle.OP11_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
