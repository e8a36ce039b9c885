"""All core queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import composition_queries, file_queries, integrity_queries, reference_queries, scoring_queries, stream_queries

MODULES = [composition_queries, integrity_queries, scoring_queries, file_queries, reference_queries, stream_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for m in MODULES:
        out.update(m.SQL)
    return out
