"""Queries: sources, sinks, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.plans import oracle as O
from tessera.plans.catalog import register
from tessera.session import scratch_path
from tessera.sources import fixtures as fx
from tessera.sources import readers as R
from tessera.sources.schemas import GENRE_COLUMNS, GENRE_KEYS, INTERACTION_COLUMNS

COLS = ", ".join(INTERACTION_COLUMNS)


@register("interactions_load", O.with_(O.INTERACTIONS) + f"SELECT {COLS} FROM interactions")
def interactions_load(spark, sf_dir):
    return fx.interactions(spark, sf_dir)


@register(
    "interactions_clean",
    O.with_(O.INTERACTIONS)
    + "SELECT " + ", ".join(f"TRY_CAST(CAST({c} AS VARCHAR) AS {'BIGINT' if c.endswith('_id') else 'INTEGER'}) AS {c}" for c in INTERACTION_COLUMNS)
    + " FROM interactions WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL",
)
def interactions_clean(spark, sf_dir):
    raw = fx.interactions(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in INTERACTION_COLUMNS])
    return R.clean_interactions(raw)


@register("explicit_ratings", O.with_(O.INTERACTIONS, O.EXPLICIT) + f"SELECT {COLS} FROM explicit")
def explicit_ratings(spark, sf_dir):
    return R.explicit_ratings(fx.interactions(spark, sf_dir))


@register(
    "csv_headerless_load",
    O.with_(O.INTERACTIONS, O.EXPLICIT) + "SELECT user_id::BIGINT AS user_id, item_id::BIGINT AS item_id, rating FROM explicit",
)
def csv_headerless_load(spark, sf_dir):
    path = scratch_path(spark, "interactions-csv")
    R.write_csv(fx.interactions(spark, sf_dir), path, header=False)
    loaded = R.read_interactions_csv(spark, path, header=False)
    return R.explicit_ratings(R.clean_interactions(loaded)).select("user_id", "item_id", "rating")


@register(
    "csv_header_load",
    "SELECT CAST(vec_id * 7 + 3 AS INTEGER) AS real_item_id, 'g' || CAST(label AS VARCHAR) AS genre FROM embeddings",
)
def csv_header_load(spark, sf_dir):
    path = scratch_path(spark, "labels-csv")
    R.write_csv(fx.item_labels(spark, sf_dir), path, header=True)
    loaded = R.read_string_csv(spark, path, ["real_item_id", "genre"])
    return loaded.select(F.col("real_item_id").try_cast("int").alias("real_item_id"), "genre")


@register("csv_to_parquet", O.with_(O.INTERACTIONS) + f"SELECT {COLS.replace('user_id, item_id', 'user_id::BIGINT AS user_id, item_id::BIGINT AS item_id')} FROM interactions")
def csv_to_parquet(spark, sf_dir):
    csv_path = scratch_path(spark, "raw-csv")
    R.write_csv(fx.interactions(spark, sf_dir), csv_path, header=True)
    return R.csv_to_parquet(spark, csv_path, scratch_path(spark, "raw-parquet"), header=True)


#: Added to user ids: beyond 32 bits.
FAR = 10_000_000_000


@register(
    "csv_quarantine",
    O.with_(O.INTERACTIONS)
    + f"SELECT 'row' AS kind, user_id + {FAR} AS user_id, item_id::BIGINT AS item_id, rating, 1::BIGINT AS n FROM interactions WHERE item_id % 50 > 2 "
    + "UNION ALL SELECT CASE WHEN item_id % 50 = 1 THEN 'missing key' ELSE 'malformed' END AS kind, NULL, NULL, NULL, count(*) FROM interactions WHERE item_id % 50 <= 2 GROUP BY 1",
)
def csv_quarantine(spark, sf_dir):
    """Large ids survive; lines with a word for a number, without a key or with a field too many are kept apart and counted."""
    path = scratch_path(spark, "raw-lines")
    far = F.col("user_id") + F.lit(FAR)
    kind = F.col("item_id") % 50
    user = F.when(kind == 0, F.concat(F.lit("u"), far)).when(kind == 1, F.lit("")).otherwise(far.cast("string"))
    line = F.concat_ws(",", user, *[F.col(c).cast("string") for c in INTERACTION_COLUMNS[1:]], F.when(kind == 2, F.lit("more")))
    fx.interactions(spark, sf_dir).select(line.alias("value")).write.text(path)
    good, rejects = R.quarantine_csv(spark, path, scratch_path(spark, "quarantine"))
    rows = good.select(F.lit("row").alias("kind"), "user_id", "item_id", "rating", F.lit(1).cast("long").alias("n"))
    counts = R.reject_counts(rejects).select(F.col("reason").alias("kind"), F.col("n_lines").alias("n"))
    return rows.unionByName(counts, allowMissingColumns=True)


def _json_null_exprs() -> str:
    parts = []
    for c in GENRE_COLUMNS:
        parts.append(f"CAST(CASE WHEN {c} <> 0 THEN {c} END AS BIGINT) AS {c}")
    return ", ".join(parts)


@register(
    "genre_json_load",
    O.with_(O.ITEM_GENRES)
    + f"SELECT CAST(item_id * 7 + 3 AS VARCHAR) AS book_id, {_json_null_exprs()} FROM item_genres",
)
def genre_json_load(spark, sf_dir):
    path = scratch_path(spark, "genres-json")
    fx.genre_documents(fx.item_genres(spark, sf_dir)).write.mode("overwrite").json(path)
    docs = R.read_genre_json(spark, path)
    return docs.select("book_id", *[F.col("genres").getField(k).alias(c) for k, c in zip(GENRE_KEYS, GENRE_COLUMNS)])


@register("foreign_names_load", O.with_(O.INTERACTIONS) + f"SELECT {', '.join(c if c != 'item_id' else 'item_id * 7 + 3 AS real_item_id' for c in INTERACTION_COLUMNS)}, item_id FROM interactions")
def foreign_names_load(spark, sf_dir):
    """Interactions stored under other names, with a parquet dictionary under other names."""
    rows_path, map_path = scratch_path(spark, "book-rows"), scratch_path(spark, "book-map")
    fx.interactions(spark, sf_dir).withColumnRenamed("item_id", "book_id").write.parquet(rows_path)
    fx.item_id_map(spark, sf_dir).selectExpr("item_id AS book_id_csv", "CAST(real_item_id AS STRING) AS real_book_id").write.parquet(map_path)
    rows = R.read_interactions(spark, rows_path, {"item_id": "book_id"})
    id_map = R.read_id_map(spark, map_path, "parquet", {"item_id": "book_id_csv", "real_item_id": "real_book_id"})
    return rows.join(id_map.select(F.col("item_id").cast("int").alias("item_id"), F.col("real_item_id").cast("int").alias("real_item_id")), "item_id")


@register(
    "id_reindex",
    O.with_(O.INTERACTIONS)
    + "SELECT user_id, CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_id, rating FROM interactions",
)
def id_reindex(spark, sf_dir):
    """Ids beyond 32 bits cleaned without loss and made dense for ALS."""
    far = fx.interactions(spark, sf_dir).select("user_id", (F.col("item_id").cast("long") * 10_000_000_019).cast("string").alias("item_id"), "rating")
    rows = R.clean_interactions(far)
    return FE.reindex(rows, FE.dense_ids(rows, "item_id"), "item_id").withColumn("user_id", F.col("user_id").cast("int"))
