"""A user holding most rows must not end up in a single task."""

import math
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import grouped
from tessera.operators.grouped import rank_by_int_key, top_k_per_group


@pytest.fixture
def no_coalescing(spark):
    """Adaptive execution would put tiny test data back into one partition."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def _hot(spark, n_hot=6000, n_small=200):
    data = [(1, i) for i in range(n_hot)] + [(u, i) for u in range(2, n_small) for i in range(5)]
    return spark.createDataFrame(data, "user_id int, item_id int").repartition(8)


def test_piecewise_rank_spreads_hot_user(spark, no_coalescing):
    df = _hot(spark)
    ranked = rank_by_int_key(df, "user_id", "item_id", bucket_width=256)
    per_task = ranked.filter("user_id = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) >= 4
    assert max(r["count"] for r in per_task) < 6000 / 2
    # and the ranks are still the exact positions 1..n
    hot = ranked.filter("user_id = 1").agg(F.min("idx"), F.max("idx"), F.countDistinct("idx")).first()
    assert tuple(hot) == (1, 6000, 6000)


def test_top_k_salts_follow_the_largest_group(spark):
    df = _hot(spark).withColumn("score", (F.col("item_id") * 7919 % 1000).cast("double"))
    top = top_k_per_group(df, ["user_id"], [F.desc("score"), F.asc("item_id")], 10, "item_id")
    plan = top._jdf.queryExecution().analyzed().toString()
    salts = int(re.search(r"pmod\(hash\(item_id#\d+, 42\), (\d+)\)", plan)[1])
    assert salts == math.ceil(math.sqrt(6000 / 10))
    w = Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id")
    want = df.withColumn("rank", F.row_number().over(w).cast("long")).filter("rank <= 10")
    assert top.exceptAll(want).count() == 0 and want.exceptAll(top).count() == 0


def test_median_of_a_hot_label_with_one_common_value(spark):
    """70 % of a hot label are one value: it is one weighted row, wherever it is sorted to."""
    data = [("hot", 0.0)] * 7000 + [("hot", float(i)) for i in range(1, 3001)] + [("even", 1.0), ("even", 2.0), ("cold", 3.0)]
    df = spark.createDataFrame(data, "g string, x double").repartition(8)
    seen = []
    sort = grouped._range_sorted

    def spy(rows, keys):
        seen.append(rows.count())
        return sort(rows, keys)

    grouped._range_sorted = spy
    try:
        got = {r.g: r.x for r in grouped.group_medians(df, "g", ["x"]).collect()}
    finally:
        grouped._range_sorted = sort
    assert got == {"hot": 0.0, "even": 1.5, "cold": 3.0}
    assert seen == [3001 + 2 + 1]


def test_median_range_sort_cuts_a_hot_label(spark, no_coalescing):
    data = [("hot", float(i)) for i in range(40_000)] + [("b", 1.0)]
    df = spark.createDataFrame(data, "g string, x double").repartition(8)
    per_part = grouped._range_sorted(df, ["g", "x"]).groupBy("_pid").count().collect()
    assert len(per_part) >= 3 and max(r["count"] for r in per_part) < 30_000
    assert {r.g: r.x for r in grouped.group_medians(df, "g", ["x"]).collect()} == {"hot": 19_999.5, "b": 1.0}


def test_dense_positions(spark):
    df = spark.createDataFrame([(f"k{i % 500:04d}",) for i in range(3000)] + [(None,)], "k string").repartition(8)
    got = sorted((r.k, r.i) for r in grouped.dense_positions(df, "k", "i").collect())
    assert got == [(f"k{i:04d}", i) for i in range(500)]


def test_ranks_of_repeated_rows_do_not_depend_on_partitioning(spark):
    """Rows that share user and item are told apart by their other columns; nulls stay."""
    rows = [(u, i % 7, r) for u in (1, 2, None) for i in range(40) for r in (i, i + 1)] + [(1, None, 5), (1, None, 6), (None, None, 7)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating int")
    a, b = [sorted(map(str, rank_by_int_key(df.repartition(p), "user_id", "item_id", bucket_width=3).collect())) for p in (2, 7)]
    assert a == b and len(a) == len(rows)


def test_large_tables_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    """Interactions and truth pairs of tables beyond the cores: bounded rows a task, the same rows as ever."""
    from tessera.operators import ranking as RK
    from tessera.sources import fixtures as fx

    i, d = F.col("id"), str(tmp_path)
    key = lambda c, gap: F.when(i % gap != 0, c)  # noqa: E731  # some keys are null
    spark.range(4000).select(i.alias("o_orderkey"), key(i * 31 % 300, 101).alias("o_custkey")).write.parquet(f"{d}/orders.parquet")
    spark.range(16000).select(
        key(F.floor(i / 4), 97).alias("l_orderkey"),
        key(i * 7919 % 5003 % 900, 89).alias("l_partkey"),
        (i % 50 + 1).cast("double").alias("l_quantity"),
        F.when(i % 3 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.when(i % 5 == 0, "R").when(i % 5 == 1, "N").alias("l_returnflag"),
    ).write.parquet(f"{d}/lineitem.parquet")

    def run(rows_per_task):
        monkeypatch.setattr(grouped, "ROWS_PER_TASK", rows_per_task, raising=False)
        inter = fx.interactions(spark, d, materialize=False)
        truth = RK.truth_pairs(inter.unionByName(inter))  # every pair twice
        in_task = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return inter.collect(), truth.collect(), in_task(inter), in_task(truth), RK.ranking_metrics_for_list(RK.popularity_list(inter, 20), inter, 20).first()

    inter, truth, most, most_truth, metrics = run(400)
    inter_1, truth_1, most_1, most_truth_1, metrics_1 = run(10**9)
    assert max(most, most_truth) <= 800 < min(most_1, most_truth_1)
    text = lambda rows: sorted(map(str, rows))
    assert text(inter) == text(inter_1) and text(truth) == text(truth_1) and len(truth) == len(inter) > 8000
    assert metrics.asDict() == pytest.approx(metrics_1.asDict(), abs=1e-12)
