"""All registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from ..session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        @wraps(f)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = shipped
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def load() -> None:
    """Import the modules that register queries."""
    for name in ("lexicon_queries", "join_queries", "corpus_queries", "align_queries", "quality_queries", "model_queries", "evidence_queries"):
        import_module(f"{__package__}.{name}")
