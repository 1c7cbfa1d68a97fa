"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stridelake.llm import ngram_join, preference_format, prefix_trie, substring_dedup, url_filter, vector_codes
from stridelake.llm.classifier import op5_byte_cnn_quality
from stridelake.llm.decontaminate import op6_template_decontamination
from stridelake.llm.ngram_join import op10_ngram_jaccard_join
from stridelake.llm.packing import op1_nnls_packing
from stridelake.llm.preference_format import op8_preference_format
from stridelake.llm.prefix_trie import op11_prefix_trie
from stridelake.llm.quality_rules import op9_robust_outliers
from stridelake.llm.sharding import op2_histogram_sort_sharding
from stridelake.llm.simhash import op13_simhash_gray_index
from stridelake.llm.substring_dedup import op3_substring_dedup
from stridelake.llm.token_files import op4_seekable_token_files
from stridelake.llm.url_filter import op7_url_rules
from stridelake.llm.vector_codes import op12_active_lloyd_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_nnls_packing": op1_nnls_packing,
        "op2_histogram_sort_sharding": op2_histogram_sort_sharding,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_seekable_token_files": op4_seekable_token_files,
        "op5_byte_cnn_quality": op5_byte_cnn_quality,
        "op6_template_decontamination": op6_template_decontamination,
        "op7_url_rules": op7_url_rules,
        "op8_preference_format": op8_preference_format,
        "op9_robust_outliers": op9_robust_outliers,
        "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_active_lloyd_codes": op12_active_lloyd_codes,
        "op13_simhash_gray_index": op13_simhash_gray_index,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_substring_dedup": substring_dedup.ORACLE_SQL,
        "op10_ngram_jaccard_join": ngram_join.ORACLE_SQL,
        "op7_url_rules": url_filter.ORACLE_SQL,
        "op8_preference_format": preference_format.ORACLE_SQL,
        "op11_prefix_trie": prefix_trie.ORACLE_SQL,
        "op12_active_lloyd_codes": vector_codes.ORACLE_SQL,
    }
