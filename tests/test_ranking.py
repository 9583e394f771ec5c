import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from tessera.operators import ranking as RK
from tessera.operators.grouped import group_medians, top_k_per_group

PREDS = {1: [1, 2, 3, 4], 2: [5, 6], 3: [7, 8, 9]}
TRUTH = {1: [1, 4, 9], 2: [6], 3: [1]}


def _tables(spark):
    preds = spark.createDataFrame(
        [(u, it, p + 1) for u, items in PREDS.items() for p, it in enumerate(items)], "user_id int, item_id int, pos int"
    )
    truth = spark.createDataFrame([(u, it) for u, items in TRUTH.items() for it in items], "user_id int, item_id int")
    return preds, truth


def test_hand_case(spark):
    preds, truth = _tables(spark)
    m = RK.ranking_metrics(preds, truth, 3).first()
    assert m.precision_at_k == pytest.approx(0.222222, abs=1e-6)
    assert m.ndcg_at_k == pytest.approx(0.366736, abs=1e-6)
    assert m.mean_average_precision == pytest.approx(0.333333, abs=1e-6)
    assert m.recall_at_k == pytest.approx(0.444444, abs=1e-6)
    assert m.n_users == 3


def test_matches_mllib_ranking_evaluator(spark):
    preds, truth = _tables(spark)
    arrays = spark.createDataFrame(
        [(float(u), [float(x) for x in PREDS[u]], [float(x) for x in TRUTH[u]]) for u in PREDS],
        "u double, prediction array<double>, label array<double>",
    )
    ours = RK.ranking_metrics(preds, truth, 3).first()
    for name, field in [("precisionAtK", "precision_at_k"), ("ndcgAtK", "ndcg_at_k"), ("meanAveragePrecision", "mean_average_precision"), ("recallAtK", "recall_at_k")]:
        ev = RankingEvaluator(metricName=name, k=3, predictionCol="prediction", labelCol="label")
        assert ours[field] == pytest.approx(ev.evaluate(arrays), abs=1e-9), name


def test_entities_without_truth_are_left_out(spark):
    preds, truth = _tables(spark)
    extra = spark.createDataFrame([(9, 1, 1)], "user_id int, item_id int, pos int")
    m = RK.ranking_metrics(preds.unionByName(extra), truth, 3).first()
    assert m.n_users == 3


def test_shared_list_equals_per_user_lists(spark):
    _, truth = _tables(spark)
    shared = [(1, 1), (6, 2), (4, 3), (9, 4)]
    ranked = spark.createDataFrame(shared, "item_id int, pos int")
    per_user = spark.createDataFrame([(u, i, p) for u in TRUTH for i, p in shared], "user_id int, item_id int, pos int")
    a = RK.ranking_metrics_for_list(ranked, truth, 3).first()
    b = RK.ranking_metrics(per_user, truth, 3).first()
    for f in ["precision_at_k", "ndcg_at_k", "mean_average_precision", "recall_at_k"]:
        assert a[f] == pytest.approx(b[f], abs=1e-12)


def test_popularity_metrics_sf001(spark):
    from tests.conftest import SF01
    from tessera.sources import fixtures as fx

    inter = fx.interactions(spark, SF01)
    m = RK.ranking_metrics_for_list(RK.popularity_list(inter, 20), inter, 20).first()
    assert m.precision_at_k == pytest.approx(0.03036667, abs=1e-8)
    assert m.ndcg_at_k == pytest.approx(0.03088328, abs=1e-8)
    assert m.mean_average_precision == pytest.approx(0.00322693, abs=1e-8)


def test_rmse_ignores_nan(spark):
    df = spark.createDataFrame([(3.0, 2.0), (1.0, 1.0), (2.0, float("nan"))], "rating double, prediction double")
    r = RK.rmse(df).first()
    assert r.n == 2 and r.rmse == pytest.approx((0.5) ** 0.5)


def test_top_k_matches_window(spark):
    data = [(1, i, float((i * 37) % 101)) for i in range(500)] + [(u, i, float(i % 5)) for u in range(2, 20) for i in range(u)]
    df = spark.createDataFrame(data, "user_id int, item_id int, score double")
    got = top_k_per_group(df, ["user_id"], [F.desc("score"), F.asc("item_id")], 7, "item_id", salts=8)
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy(F.desc("score"), F.asc("item_id"))
    want = df.withColumn("rank", F.row_number().over(w).cast("long")).filter("rank <= 7")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_group_medians_match_exact_median(spark):
    data = [("a", float(i % 97), float(-i)) for i in range(1001)] + [("b", 1.0, 2.0), ("b", 3.0, 5.0)] + [("c", 7.0, None)]
    df = spark.createDataFrame(data, "g string, x double, y double").repartition(5)
    got = {r.g: (r.x, r.y) for r in group_medians(df, "g", ["x", "y"]).collect()}
    want = {r.g: (r.x, r.y) for r in df.groupBy("g").agg(F.median("x").alias("x"), F.median("y").alias("y")).collect()}
    assert got == want


def test_grouped_metrics_equal_separate_runs(spark):
    preds, truth = _tables(spark)
    t2 = truth.withColumn("split", F.when(F.col("user_id") == 2, "b").otherwise("a"))
    got = {r.split: r for r in RK.ranking_metrics(preds, t2, 3, by=["split"]).collect()}
    for name in ["a", "b"]:
        one = RK.ranking_metrics(preds, t2.filter(F.col("split") == name).drop("split"), 3).first()
        for f in ["precision_at_k", "ndcg_at_k", "mean_average_precision", "recall_at_k", "n_users"]:
            assert got[name][f] == pytest.approx(one[f], abs=1e-12)


def test_top_k_of_small_groups_shuffles_once(spark):
    """Groups of at most k rows need no pieces: one shuffle, as many rows as there are, ranks as ever."""
    from pyspark.sql import functions as F

    from tessera.operators.grouped import top_k_per_group

    runs = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def slow(i):
        runs.add(1)
        return float(i * 7919 % 601)

    df = spark.range(600).select((F.col("id") % 20).alias("g"), F.col("id").alias("i"), slow.asNondeterministic()("id").alias("s"))
    order = [F.desc("s"), F.asc("i")]
    one = top_k_per_group(df, ["g"], order, 30, "i")
    assert one._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = sorted(one.collect())
    assert runs.value == 600  # sizes and ranks come from one pass over the rows
    assert got == sorted(top_k_per_group(df, ["g"], order, 30, "i", salts=3).collect())
