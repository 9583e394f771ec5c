"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import remove, scratch_path

#: ASCII white space as a Java/RE2 character class body; words are runs of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage with a durable table: a lost executor never recomputes what
    stands before it, and values such as generated row numbers are fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    _made().append(path)
    return spark.read.schema(df.schema).parquet(path)


_LOCAL = threading.local()


def _made() -> list[str]:
    """Paths of the scratch tables that this driver thread has written and not dropped."""
    if not hasattr(_LOCAL, "made"):
        _LOCAL.made = []
    return _LOCAL.made


def scratch_mark() -> int:
    """How many scratch tables exist by now; for ``drop_scratch``."""
    return len(_made())


def drop_scratch(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Delete the scratch tables written after ``since`` but for the last ``keep``.

    Only once nothing that reads them is needed any more."""
    made = _made()
    gone = made[since : len(made) - keep]
    del made[since : len(made) - keep]
    for path in gone:
        remove(spark, path)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Spark keeps its Python workers, and they what they held."""
    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def free_name(taken, stem: str) -> str:
    """A column name starting with ``stem`` that clashes with none in ``taken`` (case-insensitive)."""
    low = {c.lower() for c in taken}
    name = stem
    while name.lower() in low:
        name += "_"
    return name


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
