"""Deterministic hash positions.

``position = int(first 13 hex digits of md5(seed:id[:id...]), 16) / 2^52``, a
double in [0, 1) that holds all 52 bits exactly.  A share of ids is a plain
comparison with the fraction, however small.  The value depends only on the
key, never on partitioning or task order, so a split is reproducible across
runs, cluster sizes and task retries, and can be recomputed by any SQL engine
that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 13
SPAN = float(16**DIGITS)


def hash_unit(seed: str, *cols: str | Column) -> Column:
    parts = [F.lit(seed)] + [(c if isinstance(c, Column) else F.col(c)).cast("string") for c in cols]
    head = F.substring(F.md5(F.concat_ws(":", *parts)), 1, DIGITS)
    return F.conv(head, 16, 10).cast("bigint").cast("double") / F.lit(SPAN)


def hash_unit_sql(seed: str, *cols: str) -> str:
    """The same position as DuckDB SQL text (used by the oracle queries)."""
    key = " || ':' || ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"(CAST(CAST(('0x' || substr(md5({key}), 1, {DIGITS})) AS BIGINT) AS DOUBLE) / {SPAN!r})"
