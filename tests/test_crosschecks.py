"""Cross-checks for operators without a SQL oracle."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from tessera.operators import models as M
from tessera.operators import splits as S
from tessera.plans import factor_map as FM
from tessera.sources import fixtures as fx
from tests.conftest import SF001, SF01


def test_pca_matches_numpy_svd(spark):
    factors = fx.item_factors(spark, SF01)
    proj = FM.project_2d(factors).select("id", "x", "y").orderBy("id").collect()
    rows = factors.orderBy("id").collect()
    X = np.array([r.features for r in rows], dtype=np.float64)
    Xc = X - X.mean(axis=0)
    _, _, vt = np.linalg.svd(Xc, full_matrices=False)
    want = X @ vt[:2].T  # MLlib's PCA projects the raw (uncentred) vectors
    got = np.array([[r.x, r.y] for r in proj])
    for j in range(2):
        sign = np.sign(np.dot(got[:, j], want[:, j]))
        assert np.allclose(got[:, j], sign * want[:, j], atol=1e-6)


def test_relational_metrics_match_ranking_evaluator_on_als(spark):
    parts = S.assign_parts(fx.interactions(spark, SF001))
    model = M.fit_als(S.final_table(parts, "final_train_val"), rank=5, max_iter=5, seed=1)
    val = S.final_table(parts, "final_val")
    k = 20
    ours = M.evaluate_topk(model, val, k).first()
    users = val.select("user_id").distinct()
    recs = model.recommendForUserSubset(users, k).select(
        "user_id", F.col("recommendations.item_id").cast("array<double>").alias("prediction")
    )
    truth = val.groupBy("user_id").agg(F.collect_set(F.col("item_id").cast("double")).alias("label"))
    joined = recs.join(truth, "user_id")
    for name, field in [("precisionAtK", "precision_at_k"), ("ndcgAtK", "ndcg_at_k"), ("meanAveragePrecision", "mean_average_precision")]:
        ev = RankingEvaluator(metricName=name, k=k, predictionCol="prediction", labelCol="label")
        assert ours[field] == pytest.approx(ev.evaluate(joined), abs=1e-9), name


def test_cold_start_result_is_finite(spark):
    from tessera.operators.features import genre_array
    from tessera.plans.coldstart import cold_start

    feats = genre_array(fx.item_genres(spark, SF001)).select("item_id", "features")
    r = cold_start(fx.interactions(spark, SF001), feats, radius=1.5, rank=4, max_iter=4, seed=1, dim=10).first()
    assert math.isfinite(r.rmse_coldstart) and math.isfinite(r.rmse_full)
    assert r.n_test > 0 and r.n_holdout_items > 0
    assert 0 < r.n_imputed <= r.n_holdout_items
    assert r.n_pseudo > 0
