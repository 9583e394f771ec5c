"""Per-group ranking, top-k and medians that stay parallel on hot groups.

A plain ``Window.partitionBy(g)`` puts a whole group into one task.  When a
single key can hold a third of the rows, that task becomes the job.  The
helpers below split every group into bounded pieces, work on the pieces in
parallel and combine small per-piece summaries.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Rows of one task in steps that hash or sort rows of large tables by unique keys (about 250 bytes of memory a row).
ROWS_PER_TASK = 500_000


def pieces(df: DataFrame, *others: DataFrame) -> int | None:
    """Partitions that hold about ``ROWS_PER_TASK`` rows of the largest frame; None where the cores are enough.

    Adaptive execution deals rows by bytes and never beyond ``spark.sql.shuffle.partitions``, so
    the rows of one task grow with the table; this number grows instead.  The frames are counted: pass
    stored tables or what is cheap to derive from them.  There are never fewer than the session's
    shuffle partitions, so other sides of a join are dealt no coarser than without it.
    """
    spark = df.sparkSession
    rows = max(d.count() for d in (df, *others))
    if rows <= ROWS_PER_TASK * spark.sparkContext.defaultParallelism:
        return None
    return max(math.ceil(rows / ROWS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))


def distinct_in_pieces(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows, dealt by ``keys`` over as many tasks as their number asks for.

    Rows that seldom repeat gain nothing from being folded before the shuffle, which
    holds all distinct rows of a scan task; large frames are dealt first."""
    n = pieces(df)
    return (df.repartition(n, *keys) if n else df).distinct()


def rank_by_int_key(
    df: DataFrame,
    group: str,
    order: str,
    bucket_width: int | None = None,
    rank_col: str = "idx",
    size_col: str = "n",
) -> DataFrame:
    """1-based position of each row inside its group, ordered by an int key.

    Rows are range-sorted by (group, key) and written, so a hot group is cut into as many pieces
    as ranges hold it, whether its keys are dense or any 64-bit numbers.  A row's position is
    the number of its group's rows in earlier ranges (a running sum over one row a group and range) plus
    its place in its own.  ``bucket_width`` asks for ranges of about so many rows; without it there are as many
    as the session's shuffle partitions.

    Ties of the order key go by all other columns, so a retried task gives
    every row the same position; rows equal in every column are interchangeable.
    Rows with a null group or a null key form groups of their own
    (null keys come first) and stay in the result.
    """
    ranges = -(-df.count() // bucket_width) if bucket_width else None
    rest = [c for c in df.columns if c not in (group, order)]
    ordered = _range_sorted(df, [group, order, *rest], ranges)
    # A struct as key: null groups compare equal.
    keyed = ordered.withColumn("_key", F.struct(F.col(group).alias("g"), F.col("_pid").alias("p")))
    pieces = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    by_group = Window.partitionBy("_key.g")
    running = by_group.orderBy("_key.p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "_key",
        "_first",
        F.coalesce(F.sum("_cnt").over(running), F.lit(0)).alias("_before"),
        F.sum("_cnt").over(by_group).cast("long").alias(size_col),
    )
    placed = keyed.join(offsets, "_key").withColumn(rank_col, (F.col("_before") + F.col("_mid") - F.col("_first") + 1).cast("long"))
    return placed.select(*df.columns, size_col, rank_col)


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    salt_key: str | Column,
    salts: int | None = None,
    rank_col: str = "rank",
) -> DataFrame:
    """Exact top-k rows per group in two phases.

    Phase 1 keeps the best k rows of every (group, salt) piece, with the
    salt a deterministic hash of a row key, so a hot group is spread over
    ``salts`` tasks.  Phase 2 ranks the at most ``k * salts`` survivors of
    each group.  Without ``salts`` the size of the largest group decides: both
    phases then see about sqrt(k * size) of its rows in one task.  ``order``
    must be a total order (end with a unique key) so the result is deterministic.
    """
    if salts is None:
        # Sizes and ranks read the same rows: written once, they are not computed (and shuffled) twice.
        path = scratch_path(df.sparkSession, "top-k-rows")
        df.write.parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
        largest = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
        salts = max(1, math.ceil(math.sqrt((largest or 0) / k)))
    w2 = Window.partitionBy(*group).orderBy(*order)
    if salts == 1:  # one piece a group: phase 1 would shuffle and sort every row for nothing
        return df.withColumn(rank_col, F.row_number().over(w2).cast("long")).filter(F.col(rank_col) <= k)
    key = salt_key if isinstance(salt_key, Column) else F.col(salt_key)
    salted = df.withColumn("_salt", F.pmod(F.hash(key), F.lit(salts)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    cand = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1", "_salt")
    return cand.withColumn(rank_col, F.row_number().over(w2).cast("long")).filter(F.col(rank_col) <= k)


def _range_sorted(df: DataFrame, keys: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Rows in global order with ``_pid`` (partition) and ``_mid`` (rising row number), written once.

    Range partitioning cuts long runs of a key across tasks; the written table
    fixes both numbers for every later reader and retry."""
    path = scratch_path(df.sparkSession, "range-sorted")
    ordered = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys) if ranges else df.orderBy(*keys)
    ordered = ordered.withColumn("_mid", F.monotonically_increasing_id())
    ordered.withColumn("_pid", F.shiftright(F.col("_mid"), 33)).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dense_positions(keys: DataFrame, key: str, out: str) -> DataFrame:
    """Distinct non-null values of ``key`` with their 0-based position in ascending order.

    No value list reaches the driver or a single task: values are range-sorted, each
    partition's first position is the running total of the (few) partition counts,
    and a value's position is that plus its place in its partition.
    """
    ordered = _range_sorted(keys.select(key).distinct().filter(F.col(key).isNotNull()), [key])
    stats = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    placed = ordered.join(stats, "_pid")
    return placed.select(key, (F.col("_before") + F.col("_mid") - F.col("_first")).alias(out))


def group_medians(df: DataFrame, group: str, values: Sequence[str], suffix: str = "") -> DataFrame:
    """Exact median of each value column per group, without collecting a group.

    Equal values are first counted per (group, column, value), so a value that
    fills most of a hot group is one row.  The distinct values are globally
    sorted and written; weights of whole partitions and running weights inside a
    partition place every value, and only those that cover the one or
    two middle ranks are picked.  Even counts average the two middle values.  Null
    and NaN values take no part; a group without values has no row.
    """
    stacked = df.select(
        F.col(group),
        F.explode(F.array(*[F.struct(F.lit(v).alias("_col"), (F.col(v).cast("double") + F.lit(0.0)).alias("_v")) for v in values])).alias("_s"),
    ).select(group, "_s._col", "_s._v")
    stacked = stacked.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    keys = [group, "_col"]
    ordered = _range_sorted(stacked.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_w")), [*keys, "_v"])
    stats = ordered.groupBy(*keys, "_pid").agg(F.sum("_w").alias("_cnt"))
    by_key = Window.partitionBy(*keys)
    running = by_key.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(running), F.lit(0))).withColumn("_n", F.sum("_cnt").over(by_key))
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    # Partitions that hold a middle rank: at most two a key.  Only their rows get running weights.
    holding = stats.filter((F.col("_before") < high) & (F.col("_before") + F.col("_cnt") >= low))
    holding = holding.select(F.col(group).alias("_g"), F.col("_col").alias("_c"), F.col("_pid").alias("_p"), "_before", "_n")
    same = F.col(group).eqNullSafe(F.col("_g")) & (F.col("_col") == F.col("_c")) & (F.col("_pid") == F.col("_p"))
    inside = Window.partitionBy(*keys, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ordered.join(holding, same).withColumn("_upto", F.col("_before") + F.sum("_w").over(inside))
    covers = lambda r: ((F.col("_upto") - F.col("_w")) < r) & (F.col("_upto") >= r)
    picked = placed.filter(covers(low) | covers(high))
    # One row may cover both middle ranks.
    med = picked.groupBy(group).pivot("_col", list(values)).agg(F.avg("_v"))
    return med.select(group, *[F.col(v).alias(f"{v}{suffix}") for v in values])
