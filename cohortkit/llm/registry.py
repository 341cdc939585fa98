"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from cohortkit.llm.alignment import op12_token_spans
from cohortkit.llm.bloom_lm import op9_bloom_lm_score
from cohortkit.llm.bpe import op6_bpe_merge_rounds
from cohortkit.llm.divergence import ORACLE as OP8_SQL
from cohortkit.llm.divergence import op8_js_divergence_rules
from cohortkit.llm.langid import op10_kneser_ney_langid
from cohortkit.llm.mixing import ORACLE as OP4_SQL
from cohortkit.llm.mixing import op4_hierarchical_budgets
from cohortkit.llm.neardup import ORACLE as OP3_SQL
from cohortkit.llm.neardup import op3_similarity_sketch_neardup
from cohortkit.llm.onebit import ORACLE as OP7_SQL
from cohortkit.llm.onebit import op7_one_bit_neighbours
from cohortkit.llm.rans import op2_rans_token_file
from cohortkit.llm.recompression import ORACLE as OP1_SQL
from cohortkit.llm.recompression import op1_recompression_dedup
from cohortkit.llm.rlindex import ORACLE as OP5_SQL
from cohortkit.llm.rlindex import op5_run_length_index_dedup
from cohortkit.llm.secrets import ORACLE as OP11_SQL
from cohortkit.llm.secrets import op11_markov_secrets
from cohortkit.llm.spelling import ORACLE as OP13_SQL
from cohortkit.llm.spelling import op13_bloom_neighbourhoods

QUERIES = {
    "op1_recompression_dedup": op1_recompression_dedup,
    "op2_rans_token_file": op2_rans_token_file,
    "op3_similarity_sketch_neardup": op3_similarity_sketch_neardup,
    "op4_hierarchical_budgets": op4_hierarchical_budgets,
    "op5_run_length_index_dedup": op5_run_length_index_dedup,
    "op6_bpe_merge_rounds": op6_bpe_merge_rounds,
    "op7_one_bit_neighbours": op7_one_bit_neighbours,
    "op8_js_divergence_rules": op8_js_divergence_rules,
    "op9_bloom_lm_score": op9_bloom_lm_score,
    "op10_kneser_ney_langid": op10_kneser_ney_langid,
    "op11_markov_secrets": op11_markov_secrets,
    "op12_token_spans": op12_token_spans,
    "op13_bloom_neighbourhoods": op13_bloom_neighbourhoods,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_recompression_dedup": OP1_SQL,
    "op3_similarity_sketch_neardup": OP3_SQL,
    "op4_hierarchical_budgets": OP4_SQL,
    "op5_run_length_index_dedup": OP5_SQL,
    "op7_one_bit_neighbours": OP7_SQL,
    "op8_js_divergence_rules": OP8_SQL,
    "op11_markov_secrets": OP11_SQL,
    "op13_bloom_neighbourhoods": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
