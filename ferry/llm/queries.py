"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from ferry.llm import ann, collocations, lines, mixing, negatives, neighbours, packing, quality, repetition, simhash, substrings, tokens, toxicity
from ferry.llm.common import read

QUERIES = {
    "op1_toxicity": lambda spark, d: toxicity.digest(read(spark, d, "documents"), read(spark, d, "labels")),
    "op2_nn_descent": lambda spark, d: neighbours.digest(read(spark, d, "embeddings")),
    "op3_multi_index": lambda spark, d: ann.digest(read(spark, d, "embeddings")),
    "op4_simhash_golay": lambda spark, d: simhash.digest(read(spark, d, "documents")),
    "op5_line_dedup": lambda spark, d: lines.digest(read(spark, d, "documents")),
    "op6_substring_dedup": lambda spark, d: substrings.digest(read(spark, d, "documents")),
    "op7_huffman_tokens": lambda spark, d: tokens.digest(read(spark, d, "documents")),
    "op8_pfair_mixing": lambda spark, d: mixing.digest(read(spark, d, "documents")),
    "op9_quality_rff": lambda spark, d: quality.digest(read(spark, d, "documents"), read(spark, d, "labels")),
    "op10_best_fit_packing": lambda spark, d: packing.digest(read(spark, d, "documents")),
    "op11_hard_negatives": lambda spark, d: negatives.digest(read(spark, d, "embeddings")),
    "op12_collocations": lambda spark, d: collocations.digest(read(spark, d, "documents")),
    "op13_suffix_rules": lambda spark, d: repetition.digest(read(spark, d, "documents")),
}

ORACLES = {
    "op2_nn_descent": neighbours.ORACLE,
    "op5_line_dedup": lines.ORACLE,
    "op6_substring_dedup": substrings.ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_suffix_rules": repetition.ORACLE,
}
