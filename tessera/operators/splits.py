"""Activity filter, user-level sampling and the train / validation / test split.

Every random choice is the hash position of the entity id (see
``tessera.functions.hashing``), so samples and splits do not depend on the
number of partitions and survive task retries unchanged.  Assigning a split
is a column expression, not a join against a list of chosen ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_unit
from tessera.operators.grouped import rank_by_int_key

SEED_SAMPLE, SEED_SPLIT, SEED_ITEM, SEED_ROW = "sample", "split", "item", "row"


def activity_counts(df: DataFrame, user: str = "user_id") -> DataFrame:
    """Interactions per user (A1); map-side partial counts, so hot users are cheap."""
    return df.groupBy(user).agg(F.count(F.lit(1)).alias("cnt"))


def active_users(df: DataFrame, min_interactions: int = 10, user: str = "user_id") -> DataFrame:
    """Users with at least ``min_interactions`` rows, inclusive."""
    return activity_counts(df, user).filter(F.col("cnt") >= min_interactions)


def sample_users(
    df: DataFrame,
    fraction: float,
    min_interactions: int = 10,
    seed: str = SEED_SAMPLE,
    user: str = "user_id",
) -> DataFrame:
    """All rows of a reproducible ``fraction`` of the active users (L1: A1, P4, X1, J1).

    The sample predicate is evaluated per row before any shuffle, so only
    sampled users' rows are counted and joined.
    """
    if not 0.0 < fraction <= 1.0:
        raise ValueError(f"fraction must be in (0, 1], got {fraction}")
    sampled = df.filter(hash_unit(seed, user) < F.lit(float(fraction)))
    keep = active_users(sampled, min_interactions, user).select(user)
    return sampled.join(keep, user, "left_semi")


def user_split_col(user: str = "user_id", fractions=(0.6, 0.2, 0.2), seed: str = SEED_SPLIT):
    """'train' / 'val' / 'test' from the user's hash position."""
    if len(fractions) != 3 or min(fractions) < 0 or abs(sum(fractions) - 1.0) > 1e-9:
        raise ValueError(f"fractions must be three non-negative numbers summing to 1, got {fractions}")
    at = hash_unit(seed, user)
    return F.when(at < float(fractions[0]), "train").when(at < float(fractions[0] + fractions[1]), "val").otherwise("test")


def split_users(df: DataFrame, fractions=(0.6, 0.2, 0.2), seed: str = SEED_SPLIT, user: str = "user_id") -> DataFrame:
    """(user, split) for every distinct user."""
    return df.select(user).distinct().withColumn("split", user_split_col(user, fractions, seed))


def split_items(df: DataFrame, holdout_fraction: float = 0.2, seed: str = SEED_ITEM, item: str = "item_id") -> DataFrame:
    """(item, split) with 'train' / 'holdout' items."""
    return df.select(item).distinct().withColumn(
        "split", F.when(is_holdout_item(item, holdout_fraction, seed), "holdout").otherwise("train")
    )


def is_holdout_item(item: str = "item_id", holdout_fraction: float = 0.2, seed: str = SEED_ITEM):
    return hash_unit(seed, item) >= F.lit(1.0 - holdout_fraction)


def split_rows(df: DataFrame, test_fraction: float = 0.2, seed: str = SEED_ROW, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Row-level 'fit' / 'test' split keyed on the (user, item) pair."""
    return df.withColumn("split", F.when(hash_unit(seed, user, item) < F.lit(1.0 - test_fraction), "fit").otherwise("test"))


def half_split(
    df: DataFrame,
    user: str = "user_id",
    item: str = "item_id",
    bucket_width: int | None = None,
) -> DataFrame:
    """Per-user split of rows ordered by item id (X5: W1, W2, P12).

    ``idx`` is the row's position within its user, ``n`` the user's row count;
    ``half`` is 1 (back to training) when ``idx <= avg(idx)``, i.e.
    ``2 * idx <= n + 1``, else 2 (held out).  A user with n rows gives
    ceil(n / 2) rows to training.  Ranks are computed piecewise so a user
    with a huge history does not serialise into one task.
    """
    ranked = rank_by_int_key(df, user, item, bucket_width, "idx", "n")
    return ranked.withColumn(
        "half", F.when(2 * F.col("idx") <= F.col("n") + 1, F.lit(1)).otherwise(F.lit(2))
    )


def assign_parts(
    df: DataFrame,
    fractions=(0.6, 0.2, 0.2),
    seed: str = SEED_SPLIT,
    user: str = "user_id",
    item: str = "item_id",
    bucket_width: int | None = None,
) -> DataFrame:
    """Every row labelled with one ``part`` (L2).

    train        rows of training users
    val_train    first half of a validation user's rows (goes to training)
    val          second half of a validation user's rows
    test_train   first half of a test user's rows
    test         second half of a test user's rows

    Only validation and test users go through the per-user ranking.  The
    same function is applied to both held-out groups (the test half is
    not derived from the validation frame).
    """
    return _labelled(df, SPLITS, fractions, seed, user, item, bucket_width)


SPLITS = ("train", "val", "test")


def _labelled(df: DataFrame, splits, fractions, seed: str, user: str, item: str, bucket_width: int) -> DataFrame:
    """Rows of the users of ``splits`` with their ``part``; users of other splits are filtered out first."""
    out = None
    if "train" in splits:
        out = df.filter(user_split_col(user, fractions, seed) == "train").withColumn("part", F.lit("train"))
    held = [s for s in splits if s != "train"]
    if held:
        rows = df.withColumn("_us", user_split_col(user, fractions, seed)).filter(F.col("_us").isin(held))
        half = half_split(rows, user, item, bucket_width)
        part = F.when(F.col("half") == 1, F.concat(F.col("_us"), F.lit("_train"))).otherwise(F.col("_us"))
        half = half.withColumn("part", part).drop("_us", "idx", "n", "half")
        out = half if out is None else out.unionByName(half)
    return out


def split_table(
    df: DataFrame,
    name: str,
    fractions=(0.6, 0.2, 0.2),
    seed: str = SEED_SPLIT,
    user: str = "user_id",
    item: str = "item_id",
    bucket_width: int | None = None,
) -> DataFrame:
    """One final table straight from the interactions: only the users it needs are ranked."""
    splits = sorted({p.removesuffix("_train") for p in PART_SETS[name]}, key=SPLITS.index)
    return final_table(_labelled(df, splits, fractions, seed, user, item, bucket_width), name)


PART_SETS = {
    "final_train_val": ("train", "val_train"),
    "final_train_test": ("train", "test_train"),
    "final_val": ("val",),
    "final_test": ("test",),
}


def final_table(parts: DataFrame, name: str) -> DataFrame:
    """One of the four outputs of the split, as a filter on ``part``."""
    return parts.filter(F.col("part").isin(*PART_SETS[name])).drop("part")


def write_parts(parts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the labelled rows once, partitioned by ``part`` (K2).

    The four tables are read back with partition pruning instead of being
    recomputed and written four times.
    """
    parts.write.mode(mode).partitionBy("part").parquet(path)


def parts_table(spark, interactions: DataFrame, key: str, **kwargs) -> DataFrame:
    """``assign_parts`` written once (partitioned by ``part``) and read back.

    For plans that read several of the four final tables: each read prunes
    to its partitions instead of recomputing the split.  ``key`` names the
    interactions; the stored table is found again only for the same
    interactions, columns and split parameters.
    """
    from tessera.session import materialized

    name = f"parts:{key}:{interactions.schema.simpleString()}:{sorted(kwargs.items())!r}"
    return materialized(spark, name, lambda: assign_parts(interactions, **kwargs), partition_by=["part"])


def read_part(spark, path: str, name: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("part").isin(*PART_SETS[name])).drop("part")
