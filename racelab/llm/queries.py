"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from racelab.llm import align, bpe, chat, convnet, decontam, fim, pii, quality, secrets, simhash, tokens, toxicity, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": decontam.op1_decontamination,
        "op2_token_files": tokens.op2_token_files,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_chat_format": chat.op4_chat_format,
        "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
        "op6_bpe": bpe.op6_bpe,
        "op7_secrets": secrets.op7_secrets,
        "op8_url_filters": urls.op8_url_filters,
        "op9_quality_rules": quality.op9_quality_rules,
        "op10_pii": pii.op10_pii,
        "op11_quality_classifier": convnet.op11_quality_classifier,
        "op12_fill_in_middle": fim.op12_fill_in_middle,
        "op13_token_alignment": align.op13_token_alignment,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express a query; the others are tested against brute force in tests/llm."""
    return {
        "op1_decontamination": decontam.OP1_SQL,
        "op9_quality_rules": quality.OP9_SQL,
    }
