"""Queries: activity filter, sampling, splits (L1, L2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_unit_sql
from tessera.operators import splits as S
from tessera.plans import oracle as O
from tessera.plans.catalog import register
from tessera.sources import fixtures as fx
from tessera.sources.readers import explicit_ratings

COLS = "user_id, item_id, is_read, rating, is_reviewed"


@register(
    "active_users",
    O.with_(O.INTERACTIONS)
    + "SELECT user_id, count(*) AS cnt FROM interactions GROUP BY user_id HAVING count(*) >= 10",
)
def active_users(spark, sf_dir):
    return S.active_users(fx.interactions(spark, sf_dir), 10)


@register(
    "downsample_users",
    O.with_(
        O.INTERACTIONS,
        f"sampled AS (SELECT * FROM interactions WHERE {hash_unit_sql('sample', 'user_id')} < 0.1)",
    )
    + f"SELECT {COLS} FROM sampled WHERE user_id IN "
    "(SELECT user_id FROM sampled GROUP BY user_id HAVING count(*) >= 10)",
)
def downsample_users(spark, sf_dir):
    return S.sample_users(fx.interactions(spark, sf_dir), 0.10, 10)


@register(
    "split_users",
    O.with_(O.INTERACTIONS)
    + f"""SELECT user_id, CASE WHEN b < 0.6 THEN 'train' WHEN b < 0.8 THEN 'val' ELSE 'test' END AS split
FROM (SELECT user_id, {hash_unit_sql('split', 'user_id')} AS b FROM (SELECT DISTINCT user_id FROM interactions))""",
)
def split_users(spark, sf_dir):
    return S.split_users(fx.interactions(spark, sf_dir))


@register(
    "split_items",
    O.with_(O.INTERACTIONS)
    + f"""SELECT item_id, CASE WHEN {O.HOLDOUT_ITEM} THEN 'holdout' ELSE 'train' END AS split
FROM (SELECT DISTINCT item_id FROM interactions)""",
)
def split_items(spark, sf_dir):
    return S.split_items(fx.interactions(spark, sf_dir))


@register(
    "split_rows",
    O.with_(O.INTERACTIONS, O.EXPLICIT)
    + f"""SELECT user_id, item_id, rating,
  CASE WHEN {hash_unit_sql('row', 'user_id', 'item_id')} < 0.8 THEN 'fit' ELSE 'test' END AS split
FROM explicit""",
)
def split_rows(spark, sf_dir):
    rows = explicit_ratings(fx.interactions(spark, sf_dir)).select("user_id", "item_id", "rating")
    return S.split_rows(rows)


@register(
    "user_half_split",
    O.with_(O.INTERACTIONS, O.PARTS)
    + """SELECT user_id, item_id, CAST(idx AS BIGINT) AS idx,
  CAST(n AS BIGINT) AS n, CAST(CASE WHEN idx <= ceil(n / 2) THEN 1 ELSE 2 END AS INTEGER) AS half FROM held""",
)
def user_half_split(spark, sf_dir):
    rows = fx.interactions(spark, sf_dir).filter(S.user_split_col() != "train").select("user_id", "item_id")
    return S.half_split(rows).select("user_id", "item_id", "idx", "n", "half")


@register(
    "split_final_train",
    O.with_(O.INTERACTIONS, O.PARTS) + f"SELECT {COLS} FROM parts WHERE part IN ('train', 'val_train')",
)
def split_final_train(spark, sf_dir):
    return S.split_table(fx.interactions(spark, sf_dir), "final_train_val")


@register(
    "split_holdout",
    O.with_(O.INTERACTIONS, O.PARTS) + f"SELECT {COLS}, part AS split FROM parts WHERE part IN ('val', 'test')",
)
def split_holdout(spark, sf_dir):
    parts = S.assign_parts(fx.interactions(spark, sf_dir))
    return parts.filter(F.col("part").isin("val", "test")).withColumnRenamed("part", "split")


@register(
    "split_write_read",
    O.with_(O.INTERACTIONS, O.PARTS) + f"SELECT {COLS} FROM parts WHERE part IN ('train', 'test_train')",
)
def split_write_read(spark, sf_dir):
    from tessera.session import scratch_path

    path = scratch_path(spark, "parts")
    S.write_parts(S.assign_parts(fx.interactions(spark, sf_dir)), path)
    return S.read_part(spark, path, "final_train_test")
