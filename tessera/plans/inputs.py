"""Composite inputs shared by several registered queries (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.operators import splits as S
from tessera.sources import fixtures as fx
from tessera.sources.readers import explicit_ratings


def genre_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, features array<int>, holdout bool) for every item."""
    g = FE.genre_array(fx.item_genres(spark, sf_dir)).select("item_id", "features")
    return g.withColumn("holdout", S.is_holdout_item("item_id"))


def holdout_and_train_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    g = genre_vectors(spark, sf_dir)
    return g.filter("holdout").drop("holdout"), g.filter(~F.col("holdout")).drop("holdout")


def learned_item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the factors a model learned on training items: embeddings of non-holdout ids."""
    return fx.item_factors(spark, sf_dir).filter(~S.is_holdout_item("id"))


def fit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explicit ratings in the 'fit' row split: (user_id, item_id, rating)."""
    rows = explicit_ratings(fx.interactions(spark, sf_dir)).select("user_id", "item_id", "rating")
    return S.split_rows(rows).filter(F.col("split") == "fit").drop("split")


def holdout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_rows(spark, sf_dir).filter(S.is_holdout_item("item_id"))


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_rows(spark, sf_dir).filter(~S.is_holdout_item("item_id"))
