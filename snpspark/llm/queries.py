"""Queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import chat_format, decontamination, packing, quality_classifier, quality_rules, simhash, substring_dedup, suffix_tree, toxicity, url_filters


def queries() -> dict:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_quality_rules": quality_rules.op2_quality_rules,
        "op3_url_filters": url_filters.op3_url_filters,
        "op4_chat_formatting": chat_format.op4_chat_formatting,
        "op5_quality_classifier": quality_classifier.op5_quality_classifier,
        "op6_decontamination": decontamination.op6_decontamination,
        "op7_suffix_tree": suffix_tree.op7_suffix_tree,
        "op8_packing": packing.op8_packing,
        "op9_substring_dedup": substring_dedup.op9_substring_dedup,
        "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup,
    }


def oracle_sql() -> dict:
    return {
        "op2_quality_rules": quality_rules.SQL,
        "op3_url_filters": url_filters.SQL,
        "op4_chat_formatting": chat_format.SQL,
        "op6_decontamination": decontamination.SQL,
        "op9_substring_dedup": substring_dedup.SQL,
    }
