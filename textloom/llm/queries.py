"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Query name -> module whose query(spark, sf_dir) gives its rows.
MODULES = {
    "op1_ngram_join": "ngram_join",
    "op2_packing": "packing",
    "op3_suffix_dedup": "suffix_dedup",
    "op4_html": "html_extract",
    "op5_toxicity": "toxicity",
    "op6_fingerprint": "fingerprint",
    "op7_quality": "quality_classifier",
    "op8_licenses": "license_scan",
    "op9_bpe": "bpe",
    "op10_quality_rules": "quality_rules",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: importlib.import_module(f"{__package__}.{module}").query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(importlib.import_module(f"{__package__}.{module}"), "ORACLE_SQL", None) for name, module in MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
