"""All registered queries of the library's own operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import cleaning, concepts, gates, more, reports, retrieval, sqltext, streams, structure, traces, units  # noqa: F401  they register their queries
from .plans.registry import ORACLES, QUERIES

FLAGSHIP = "cln1_normalize_text"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
