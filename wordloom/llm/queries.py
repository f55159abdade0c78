"""The operators' queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from wordloom.llm import oracle
from wordloom.llm.alignment import op12_alignment
from wordloom.llm.chat import op6_chat
from wordloom.llm.decontamination import op10_decontamination
from wordloom.llm.hard_negatives import op11_hard_negatives
from wordloom.llm.html_extraction import op13_html_extraction
from wordloom.llm.licenses import op2_licenses
from wordloom.llm.packing import op5_packing
from wordloom.llm.quality_classifier import op3_quality
from wordloom.llm.quality_rules import op7_quality_rules
from wordloom.llm.sharding import op4_sharding
from wordloom.llm.simhash import op8_simhash
from wordloom.llm.suffix_dedup import op9_suffix_dedup
from wordloom.llm.toxicity import op1_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_toxicity,
            op2_licenses,
            op3_quality,
            op4_sharding,
            op5_packing,
            op6_chat,
            op7_quality_rules,
            op8_simhash,
            op9_suffix_dedup,
            op10_decontamination,
            op11_hard_negatives,
            op12_alignment,
            op13_html_extraction,
        )
    } | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_chat": oracle.CHAT,
        "op9_suffix_dedup": oracle.REPEATS,
        "op10_decontamination": oracle.LEAKS,
        "op11_hard_negatives": oracle.NEGATIVES,
    }
