"""Registered queries of the package and their DuckDB oracles (where SQL can express them)."""

from __future__ import annotations

import corpus_pipeline
from labwire.llm import (
    bitpack, chat, decontaminate, hmm, jaccard, packing, quality, repair, reshard, simhash, toxicity, warczip, whitening)

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_winnowing": decontaminate.op1,
    "op2_hidden_markov": hmm.op2,
    "op3_conv_toxicity": toxicity.op3,
    "op4_risk_cutoffs": quality.op4,
    "op5_sum_of_squares_packing": packing.op5,
    "op6_count_rtree": jaccard.op6,
    "op7_flow_resharding": reshard.op7,
    "op8_prefix_targets": chat.op8,
    "op9_zip_warc": warczip.op9,
    "op10_bit_packing": bitpack.op10,
    "op11_grammar_repair": repair.op11,
    "op12_cholesky_whitening": whitening.op12,
    "op13_pivot_simhash": simhash.op13,
}

ORACLE = {
    "op1_winnowing": decontaminate.ORACLE,
    "op8_prefix_targets": chat.ORACLE,
    "op9_zip_warc": warczip.ORACLE,
    "op11_grammar_repair": repair.ORACLE,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
