"""The queries of this subpackage and the SQL that some of them are checked against."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_MODULES = {
    "op1_mixing": "mixing",
    "op2_secrets": "secrets",
    "op3_minhash": "minhash",
    "op4_suffix_dedup": "repeats",
    "op5_sharding": "sharding",
    "op6_toxicity": "toxicity",
    "op7_exact_dedup": "exact_dedup",
    "op8_quality": "quality",
    "op9_language_model": "language_model",
    "op10_decontaminate": "decontaminate",
    "op11_repair": "conversations",
    "op12_bpe": "bpe",
    "op13_negatives": "negatives",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: getattr(importlib.import_module(f"wordweave.llm.{module}"), name) for name, module in _MODULES.items()}
    return {**found, "pipeline": importlib.import_module("corpus_pipeline").run}


def oracle_sql() -> dict[str, str]:
    from wordweave.llm import exact_dedup, minhash, negatives

    return {
        "op3_minhash": minhash.OP3_SQL,
        "op7_exact_dedup": exact_dedup.OP7_SQL,
        "op13_negatives": negatives.OP13_SQL,
    }
