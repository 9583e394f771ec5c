"""Registry of the named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the whole test tables.
The oracle (when the operator is expressible in SQL) recomputes the same
result in DuckDB from the same parquet files.  Doubles are rounded to 6
decimals on both sides; arrays are emitted as exploded rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _load_modules() -> None:
    # Importing the modules fills the registry.
    from tessera.plans import (  # noqa: F401
        q_features,
        q_models,
        q_neighbors,
        q_ranking,
        q_sources,
        q_splits,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_modules()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_modules()
    return dict(ORACLE)


def r6(c) -> "F.Column":
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


__all__ = ["register", "queries", "oracle_sql", "r6"]
