"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stakeflow.llm import ball_tree_search, best_fit_packing, bpe, hard_negatives, html_extract, kneser_ney, lang_id, lattice_dedup, line_dedup, mixing, ngram_join, quality_rules, substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_html_extract": html_extract.op3_html_extract,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_quality_classifier": kneser_ney.op5_quality_classifier,
    "op6_lattice_dedup": lattice_dedup.op6_lattice_dedup,
    "op7_mixing": mixing.op7_mixing,
    "op8_language_id": lang_id.op8_language_id,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_bpe": bpe.op10_bpe,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_best_fit_packing": best_fit_packing.op12_best_fit_packing,
    "op13_lexical_search": ball_tree_search.op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_join": ngram_join.ORACLE,
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op6_lattice_dedup": lattice_dedup.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op13_lexical_search": ball_tree_search.ORACLE,
}
