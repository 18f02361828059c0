"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagelens.llm.bpe import op2_distinct_words
from pagelens.llm.decontaminate import OP1_SQL, op1_winnowing
from pagelens.llm.filter_audit import OP12_SQL, op12_mask_folds
from pagelens.llm.language import op7_byte_convolution
from pagelens.llm.line_dedup import OP10_SQL, op10_line_chunks
from pagelens.llm.quality import op9_random_indexing
from pagelens.llm.resampling import OP13_SQL, op13_crc_matrices
from pagelens.llm.sharding import op5_weighted_hash_tree
from pagelens.llm.simhash import op6_simhash_pivots
from pagelens.llm.substring_dedup import op4_unit_hashing
from pagelens.llm.token_counts import op8_ragged_merging
from pagelens.llm.topk import OP3_SQL, op3_histogram_selection
from pagelens.llm.url_rules import OP11_SQL, op11_url_tokens


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_winnowing": op1_winnowing,
        "op2_distinct_words": op2_distinct_words,
        "op3_histogram_selection": op3_histogram_selection,
        "op4_unit_hashing": op4_unit_hashing,
        "op5_weighted_hash_tree": op5_weighted_hash_tree,
        "op6_simhash_pivots": op6_simhash_pivots,
        "op7_byte_convolution": op7_byte_convolution,
        "op8_ragged_merging": op8_ragged_merging,
        "op9_random_indexing": op9_random_indexing,
        "op10_line_chunks": op10_line_chunks,
        "op11_url_tokens": op11_url_tokens,
        "op12_mask_folds": op12_mask_folds,
        "op13_crc_matrices": op13_crc_matrices,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_winnowing": OP1_SQL,
        "op3_histogram_selection": OP3_SQL,
        "op10_line_chunks": OP10_SQL,
        "op11_url_tokens": OP11_SQL,
        "op12_mask_folds": OP12_SQL,
        "op13_crc_matrices": OP13_SQL,
    }
