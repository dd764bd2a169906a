"""The registered queries of this package, and the DuckDB SQL of those that
SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import oracles
from cohortlens.llm.decontaminate import op12_benchmark_decontamination
from cohortlens.llm.embedding_dedup import op5_embedding_near_dedup
from cohortlens.llm.html_extract import op2_html_extraction
from cohortlens.llm.ngram_join import op9_ngram_jaccard_join
from cohortlens.llm.nn_descent import op4_nn_descent
from cohortlens.llm.periodic_runs import op13_periodic_runs
from cohortlens.llm.prefix_trie import op11_prefix_trie
from cohortlens.llm.quality_ranker import op7_quality_ranking
from cohortlens.llm.secret_scan import op10_secret_scans
from cohortlens.llm.sentencepiece_codec import op8_sentencepiece
from cohortlens.llm.source_mixing import op6_source_mixing
from cohortlens.llm.substring_dedup import op1_substring_dedup
from cohortlens.llm.suffix_dedup import op3_suffix_array_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_html_extraction, op3_suffix_array_dedup, op4_nn_descent,
                                    op5_embedding_near_dedup, op6_source_mixing, op7_quality_ranking, op8_sentencepiece, op9_ngram_jaccard_join,
                                    op10_secret_scans, op11_prefix_trie, op12_benchmark_decontamination, op13_periodic_runs)}


def oracle_sql() -> dict[str, str]:
    """The others are tested against brute force: a learned ranking, a
    tokenizer, a tree parser, hashed draws and an approximate search."""
    return {"op1_substring_dedup": oracles.OP1, "op3_suffix_array_dedup": oracles.OP3,
            "op5_embedding_near_dedup": oracles.OP5, "op9_ngram_jaccard_join": oracles.OP9,
            "op10_secret_scans": oracles.OP10, "op11_prefix_trie": oracles.OP11,
            "op12_benchmark_decontamination": oracles.OP12,
            "op13_periodic_runs": oracles.OP13}
