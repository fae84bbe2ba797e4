"""The queries opN_* of this subpackage, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import queries_arrays, queries_models, queries_native, queries_similar, queries_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nb_svm_quality": queries_models.op1_nb_svm_quality,
    "op2_gru_language_model": queries_models.op2_gru_language_model,
    "op3_partenum_join": queries_similar.op3_partenum_join,
    "op4_hnsw_near_duplicates": queries_similar.op4_hnsw_near_duplicates,
    "op5_hash_ring": queries_native.op5_hash_ring,
    "op6_conv_toxicity": queries_models.op6_conv_toxicity,
    "op7_source_mix": queries_native.op7_source_mix,
    "op8_warc_transactions": queries_models.op8_warc_transactions,
    "op9_ngram_bayes_language": queries_models.op9_ngram_bayes_language,
    "op10_template_decontamination": queries_models.op10_template_decontamination,
    "op11_prefix_trie": queries_arrays.op11_prefix_trie,
    "op12_jacobi_whitening": queries_arrays.op12_jacobi_whitening,
    "op13_binary_packing": queries_arrays.op13_binary_packing,
}
SQL: dict[str, str] = {
    "op3_partenum_join": queries_sql.JACCARD,
    "op4_hnsw_near_duplicates": queries_sql.VECTORS,
    "op5_hash_ring": queries_sql.RING,
    "op7_source_mix": queries_sql.MIX,
    "op8_warc_transactions": queries_sql.WARC,
    "op11_prefix_trie": queries_sql.TRIE,
}
