"""Learned item factors joined to item labels, label codes, 2-D projection."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.factors import wide_factors
from tessera.operators.grouped import dense_positions, group_medians


def factor_genre_map(factors: DataFrame, id_map: DataFrame, labels: DataFrame, keep_labels: list[str] | None = None) -> DataFrame:
    """(item_id, real_item_id, genre, features) for items with a factor, an id and a label.

    Ids from string sources are cast explicitly before joining.
    """
    f = factors.select(F.col("id").cast("int").alias("item_id"), "features")
    m = id_map.select(F.col("item_id").cast("int").alias("item_id"), F.col("real_item_id").cast("bigint").alias("real_item_id"))
    lab = labels.select(F.col("real_item_id").cast("bigint").alias("real_item_id"), "genre")
    if keep_labels is not None:
        lab = lab.filter(F.col("genre").isin(list(keep_labels)))
    return f.join(m, "item_id").join(lab, "real_item_id").select("item_id", "real_item_id", "genre", "features")


def export_wide(mapped: DataFrame, rank: int, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Wide factor table (one column per component), written by the executors (K5)."""
    wide = mapped.select("item_id", "real_item_id", "genre", "features").transform(
        lambda d: d.select("item_id", "real_item_id", "genre", *[F.get(F.col("features"), i).cast("double").alias(f"f{i}") for i in range(rank)])
    ).na.drop("any")
    if path:
        w = wide.write.mode("overwrite")
        (w.option("header", "true").csv(path) if fmt == "csv" else w.parquet(path))
    return wide


def index_labels(df: DataFrame, label: str = "genre", out: str = "label") -> DataFrame:
    """Labels coded 0..n-1 in alphabetical order.

    Distinct labels are ranked by a distributed sort and joined back; neither the driver nor
    a task holds them all.  Rows with a null label have no code and go."""
    codes = dense_positions(df, label, out).select(F.col(label).alias("_label"), F.col(out).cast("int").alias(out))
    return df.join(codes, F.col(label) == F.col("_label")).drop("_label")


def project_2d(df: DataFrame, vec: str = "features") -> DataFrame:
    """Two-component PCA of the factor vectors (M11; replaces the single-machine t-SNE)."""
    v = df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))
    model = PCA(k=2, inputCol="_v", outputCol="_p").fit(v)
    p = model.transform(v).withColumn("_pa", vector_to_array("_p"))
    return p.withColumn("x", F.col("_pa")[0]).withColumn("y", F.col("_pa")[1]).drop("_v", "_p", "_pa")


def label_medians(df: DataFrame, label: str = "genre", x: str = "x", y: str = "y") -> DataFrame:
    """Per-label median position (A13), exact and without gathering a label's rows."""
    return group_medians(df, label, [x, y], suffix="")


__all__ = [
    "factor_genre_map",
    "export_wide",
    "index_labels",
    "label_mapping",
    "project_2d",
    "label_medians",
    "read_factor_export",
    "sort_by_label",
    "wide_factors",
]


def label_mapping(indexed: DataFrame, label: str = "genre", code: str = "label") -> DataFrame:
    """The reverse mapping code -> label as rows."""
    return indexed.select(code, label).distinct()


def read_factor_export(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a wide factor export back with its types.

    A CSV names its columns in the header row (one line is read for it): ids are ints, the
    genre a string, components doubles."""
    if fmt != "csv":
        return spark.read.parquet(path)
    names = spark.read.option("header", "true").csv(path).columns
    kinds = {"item_id": "int", "real_item_id": "bigint", "genre": "string"}
    schema = ", ".join(f"`{c}` {kinds.get(c, 'double')}" for c in names)
    return spark.read.option("header", "true").option("enforceSchema", "false").schema(schema).csv(path)


def sort_by_label(df: DataFrame, label: str = "label", key: str = "item_id") -> DataFrame:
    """Rows grouped label by label, then by id (O4): a range-partitioned global sort."""
    return df.orderBy(label, key)
