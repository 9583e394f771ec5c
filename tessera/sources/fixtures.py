"""Recommendation inputs derived from the shared test tables.

The test data is a TPC-H style schema; these functions turn it into the
inputs the recommendation operators read:

* interactions: one row per (customer, part) pair of orders x lineitem,
* item genre counts from part type and size,
* latent factors from the embeddings table,
* the item-id dictionary and the item labels.

Each function has a DuckDB twin in ``tessera.plans.oracle`` so results can
be checked against an independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.grouped import pieces
from tessera.sources.schemas import GENRE_COLUMNS, GENRE_KEYS

# --- Fixed values: part types that map to the first six genre columns --------
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# ------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """One row per (user, item) pair; repeated purchases are folded with max.

    The derived table is written once per application to the shared folder
    and read back, like the stored interactions table the pipelines expect;
    ``materialize=False`` returns the lazy derivation instead.
    """
    if materialize:
        from tessera.session import materialized

        return materialized(spark, f"interactions:{sf_dir}", lambda: interactions(spark, sf_dir, False))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias("user_id"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_partkey").cast("int").alias("item_id"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("is_read"),
        F.floor(F.col("l_quantity") / 10).alias("rating"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_reviewed"),
    )
    n = pieces(lines, orders)
    if n:  # both sides of the join, and then its rows by pair, in tasks of bounded size
        lines, orders = lines.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select("user_id", "item_id", "is_read", "rating", "is_reviewed")
    if n:
        joined = joined.repartition(n, "user_id", "item_id")
    return joined.groupBy("user_id", "item_id").agg(*[F.max(c).cast("int").alias(c) for c in ("is_read", "rating", "is_reviewed")])


def item_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, ten genre counts): six from the part type, four from the size class."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    type_cols = [
        F.when(F.col("p_type") == t, 1 + F.col("p_partkey") % 3).otherwise(0).cast("int").alias(c)
        for t, c in zip(PART_TYPES, GENRE_COLUMNS[:6])
    ]
    size_cols = [
        F.when(F.col("p_size") % 4 == cls, 1 + F.col("p_size") % 7).otherwise(0).cast("int").alias(c)
        for cls, c in enumerate(GENRE_COLUMNS[6:])
    ]
    return part.select(F.col("p_partkey").cast("int").alias("item_id"), *type_cols, *size_cols)


def real_item_id(item: str = "item_id"):
    return (F.col(item) * 7 + 3).cast("int")


def genre_documents(genres: DataFrame) -> DataFrame:
    """Nested JSON-shaped documents keyed by the real (external) id; zero counts are absent keys."""
    fields = [
        F.when(F.col(c) != 0, F.col(c).cast("long")).alias(k)
        for k, c in zip(GENRE_KEYS, GENRE_COLUMNS)
    ]
    return genres.select(
        real_item_id().cast("string").alias("book_id"), F.struct(*fields).alias("genres")
    )


def item_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, real_item_id) for every item."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("item_id"))
    return part.select("item_id", real_item_id().alias("real_item_id"))


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latent factors in the shape of ALS ``itemFactors``: (id int, features array<float>)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features")
    )


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table read as user factors (ids are read as user ids)."""
    return item_factors(spark, sf_dir)


def item_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(real_item_id, genre) with one label per item."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return emb.select(
        (F.col("vec_id") * 7 + 3).cast("int").alias("real_item_id"),
        F.concat(F.lit("g"), F.col("label").cast("string")).alias("genre"),
    )
