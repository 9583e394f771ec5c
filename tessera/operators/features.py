"""Item features: id remapping and vector assembly."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.grouped import dense_positions
from tessera.sources.schemas import GENRE_COLUMNS


def remap_ids(df: DataFrame, id_map: DataFrame, external: str = "real_item_id", internal: str = "item_id") -> DataFrame:
    """Replace an external id by the internal one through the id dictionary.

    The dictionary has one row per item and is joined on equal keys; the
    planner broadcasts it only when its measured size is under the
    broadcast threshold, otherwise both sides are shuffled on the id.
    """
    return df.join(id_map.select(internal, external), external).drop(external).select(internal, *[c for c in df.columns if c != external])


def dense_ids(df: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """Dictionary (col, out): a dense int for every distinct id, in id order.

    For ids that are strings or beyond 32 bits, which ALS does not take.  Positions
    come from a distributed sort; more than 2^31 distinct ids are refused.
    """
    ids = dense_positions(df, col, out)
    fits = F.when(F.col(out) < F.lit(2**31), F.col(out)).otherwise(F.raise_error(F.lit("more than 2^31 distinct ids")).cast("long"))
    return ids.select(col, fits.cast("int").alias(out))


def reindex(df: DataFrame, dictionary: DataFrame, col: str, idx: str = "idx") -> DataFrame:
    """``col`` replaced by its dense int from the dictionary; rows with unknown or null ids go."""
    d = dictionary.select(F.col(col).alias("_known"), F.col(idx).alias("_idx"))
    joined = df.join(d, F.col(col) == F.col("_known"))
    return joined.select(*[F.col("_idx").alias(c) if c == col else F.col(c) for c in df.columns])


def genre_array(df: DataFrame, columns=GENRE_COLUMNS, out: str = "features") -> DataFrame:
    """The genre counts as one int array column, in column order."""
    return df.withColumn(out, F.array(*[F.col(c).cast("int") for c in columns]))


def assemble_vectors(df: DataFrame, columns=GENRE_COLUMNS, out: str = "features") -> DataFrame:
    """ML vector of the genre counts."""
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def features_of_rated(features: DataFrame, rows: DataFrame, item: str = "item_id") -> DataFrame:
    """Features of the items that appear in ``rows``, one row per item.

    The rated item ids are de-duplicated first (map-side partial
    aggregation), so a heavily rated item contributes one key per task
    instead of all its rating rows to the semi-join.
    """
    return features.join(rows.select(item).distinct(), item, "left_semi")
