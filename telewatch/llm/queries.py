"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telewatch.llm import (
    bpe,
    collocations,
    decontaminate,
    html_extract,
    license_scan,
    line_dedup,
    packing,
    prefix_trie,
    quality,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
)

_QUERIES = {
    "op1_sharding": (sharding.op1_sharding, sharding.ORACLE),
    "op2_quality": (quality.op2_quality, None),
    "op5_substring_dedup": (substring_dedup.op5_substring_dedup, None),
    "op4_toxicity": (toxicity.op4_toxicity, None),
    "op3_simhash": (simhash.op3_simhash, None),
    "op7_bpe": (bpe.op7_bpe, None),
    "op10_decontamination": (decontaminate.op10_decontamination, decontaminate.ORACLE),
    "op6_license_scan": (license_scan.op6_license_scan, license_scan.ORACLE),
    "op8_html_extraction": (html_extract.op8_html_extraction, None),
    "op9_line_dedup": (line_dedup.op9_line_dedup, line_dedup.ORACLE),
    "op11_collocations": (collocations.op11_collocations, collocations.ORACLE),
    "op12_packing": (packing.op12_packing, None),
    "op13_prefix_trie": (prefix_trie.op13_prefix_trie, None),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
