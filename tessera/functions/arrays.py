"""Array arithmetic with higher-order functions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def dot(a: str | Column, b: str | Column) -> Column:
    """sum(a[i] * b[i]) as double; null if either side is null."""
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def squared_distance(a: str | Column, b: str | Column) -> Column:
    diffs = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def euclidean_distance(a: str | Column, b: str | Column) -> Column:
    return F.sqrt(squared_distance(a, b))
