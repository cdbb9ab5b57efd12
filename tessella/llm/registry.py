"""The queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import byte_bpe, fill_in_middle, html_text, importance, max_score, near_duplicates, pii, repeats, substrings, target_resampling, templates, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_pseudonyms": pii.op2_pseudonyms,
        "op3_repeats": repeats.op3_repeats,
        "op4_max_score": max_score.op4_max_score,
        "op5_url_filter": url_filter.op5_url_filter,
        "op6_html_text": html_text.op6_html_text,
        "op7_near_duplicates": near_duplicates.op7_near_duplicates,
        "op8_importance_resampling": importance.op8_importance_resampling,
        "op9_byte_bpe": byte_bpe.op9_byte_bpe,
        "op10_template_decontamination": templates.op10_template_decontamination,
        "op11_target_resampling": target_resampling.op11_target_resampling,
        "op12_substrings": substrings.op12_substrings,
        "op13_fill_in_middle": fill_in_middle.op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_max_score": max_score.SQL,
        "op5_url_filter": url_filter.SQL,
        "op13_fill_in_middle": fill_in_middle.SQL,
    }
