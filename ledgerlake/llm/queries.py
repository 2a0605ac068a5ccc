"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import bytebpe, decontaminate, divergence, langid, licenses, lines, minhash, mixing, negatives, quality, substrings, tokens, urls

Query = Callable[[SparkSession, str], DataFrame]


def registered() -> dict[str, Query]:
    found = [
        decontaminate.op1_benchmark_decontamination,
        quality.op2_quality_rules,
        urls.op3_url_filters,
        tokens.op4_token_output,
        mixing.op5_mixing,
        lines.op6_line_dedup,
        minhash.op7_minhash_near_dedup,
        langid.op8_language_id,
        substrings.op9_substring_dedup,
        licenses.op10_license_scan,
        negatives.op11_hard_negatives,
        bytebpe.op12_byte_bpe,
        divergence.op13_source_divergence,
    ]
    return {f.__name__: f for f in found}


def statements() -> dict[str, str]:
    return {
        "op1_benchmark_decontamination": decontaminate.SQL,
        "op2_quality_rules": quality.SQL,
        "op3_url_filters": urls.SQL,
        "op6_line_dedup": lines.SQL,
        "op7_minhash_near_dedup": minhash.SQL,
        "op9_substring_dedup": substrings.SQL,
        "op11_hard_negatives": negatives.SQL,
        "op13_source_divergence": divergence.SQL,
    }
