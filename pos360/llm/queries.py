"""Registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pos360.llm.collocations import op13_debruijn_collocations
from pos360.llm.decontaminate import op8_suffix_array_decontamination
from pos360.llm.html_extract import op2_tag_path_extraction
from pos360.llm.license_scan import op11_license_signatures
from pos360.llm.oracle import ORACLE
from pos360.llm.quality_gbt import op3_boosted_tree_quality
from pos360.llm.quality_rules import op7_risk_controlled_rules
from pos360.llm.quote_linking import op10_quotation_threads
from pos360.llm.ranked_search import op12_bitsliced_search
from pos360.llm.sentencepiece_codec import op5_sentencepiece_unigram
from pos360.llm.sharding import op9_hypergeometric_shards
from pos360.llm.simhash import op4_simhash_byte_index
from pos360.llm.substring_automaton import op6_suffix_automata_dedup
from pos360.llm.suffix_dedup import op1_suffix_array_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_tag_path_extraction": op2_tag_path_extraction,
    "op3_boosted_tree_quality": op3_boosted_tree_quality,
    "op4_simhash_byte_index": op4_simhash_byte_index,
    "op5_sentencepiece_unigram": op5_sentencepiece_unigram,
    "op6_suffix_automata_dedup": op6_suffix_automata_dedup,
    "op7_risk_controlled_rules": op7_risk_controlled_rules,
    "op8_suffix_array_decontamination": op8_suffix_array_decontamination,
    "op9_hypergeometric_shards": op9_hypergeometric_shards,
    "op10_quotation_threads": op10_quotation_threads,
    "op11_license_signatures": op11_license_signatures,
    "op12_bitsliced_search": op12_bitsliced_search,
    "op13_debruijn_collocations": op13_debruijn_collocations,
}

__all__ = ["ORACLE", "QUERIES"]
