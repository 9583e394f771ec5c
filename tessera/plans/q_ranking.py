"""Queries: truth sets and ranking metrics on a popularity list."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import factors as FA
from tessera.operators import products as PR
from tessera.operators import ranking as RK
from tessera.operators import splits as S
from tessera.plans import oracle as O
from tessera.plans.catalog import r6, register
from tessera.plans.evaluate import store_metrics
from tessera.session import scratch_path
from tessera.sources import fixtures as fx

K = 500

POP_METRICS = f"""cnt AS (SELECT item_id, count(*) AS c FROM interactions GROUP BY 1),
pop AS (SELECT item_id, pos FROM (SELECT item_id, row_number() OVER (ORDER BY c DESC, item_id) AS pos FROM cnt) WHERE pos <= {K}),
truth AS (SELECT DISTINCT user_id, item_id FROM interactions),
nt AS (SELECT user_id, count(*) AS n_truth FROM truth GROUP BY 1),
hits AS (SELECT t.user_id, p.pos, row_number() OVER (PARTITION BY t.user_id ORDER BY p.pos) AS hr
         FROM truth t JOIN pop p ON t.item_id = p.item_id),
agg AS (SELECT user_id, sum(CASE WHEN pos <= {K} THEN 1 ELSE 0 END) AS hk,
               sum(CASE WHEN pos <= {K} THEN 1.0 / log2(pos + 1) ELSE 0 END) AS dcg,
               sum(CAST(hr AS DOUBLE) / pos) AS ap FROM hits GROUP BY 1),
ideal AS (SELECT i AS m, sum(1.0 / log2(i + 1)) OVER (ORDER BY i) AS idcg FROM range(1, {K + 1}) r(i)),
per_user AS (SELECT nt.user_id, nt.n_truth, coalesce(hk, 0) AS hk, coalesce(dcg, 0) AS dcg, coalesce(ap, 0) AS ap, idcg
             FROM nt LEFT JOIN agg USING (user_id) JOIN ideal ON ideal.m = least(nt.n_truth, {K}))"""


#: The metrics of POP_METRICS-shaped per-user rows, all at once.
ALL_METRICS = (
    f"SELECT round(avg(hk / {float(K)}), 6) AS precision_at_k, round(avg(dcg / idcg), 6) AS ndcg_at_k, "
    "round(avg(ap / n_truth), 6) AS mean_average_precision, round(avg(CAST(hk AS DOUBLE) / n_truth), 6) AS recall_at_k, "
    "count(*) AS n_users FROM per_user"
)
METRIC_NAMES = ["precision_at_k", "ndcg_at_k", "mean_average_precision", "recall_at_k"]


def _rounded(df):
    return df.select(*[r6(c).alias(c) for c in METRIC_NAMES], "n_users")


def _metrics(spark, sf_dir):
    inter = fx.interactions(spark, sf_dir)
    return RK.ranking_metrics_for_list(RK.popularity_list(inter, K), inter, K)


@register(
    "precision_at_k",
    O.with_(O.INTERACTIONS, POP_METRICS) + f"SELECT round(avg(hk / {float(K)}), 6) AS precision_at_k FROM per_user",
)
def precision_at_k(spark, sf_dir):
    return _metrics(spark, sf_dir).select(r6("precision_at_k").alias("precision_at_k"))


@register(
    "ndcg_at_k",
    O.with_(O.INTERACTIONS, POP_METRICS) + "SELECT round(avg(dcg / idcg), 6) AS ndcg_at_k FROM per_user",
)
def ndcg_at_k(spark, sf_dir):
    return _metrics(spark, sf_dir).select(r6("ndcg_at_k").alias("ndcg_at_k"))


@register(
    "mean_average_precision",
    O.with_(O.INTERACTIONS, POP_METRICS) + "SELECT round(avg(ap / n_truth), 6) AS mean_average_precision FROM per_user",
)
def mean_average_precision(spark, sf_dir):
    return _metrics(spark, sf_dir).select(r6("mean_average_precision").alias("mean_average_precision"))


@register(
    "truth_sets",
    O.with_(O.INTERACTIONS, O.PARTS) + "SELECT DISTINCT user_id, item_id FROM parts WHERE part = 'val'",
)
def truth_sets(spark, sf_dir):
    return RK.truth_pairs(S.split_table(fx.interactions(spark, sf_dir), "final_val"))


@register("metrics_store", O.with_(O.INTERACTIONS, POP_METRICS) + ALL_METRICS.replace("SELECT ", "SELECT 'popularity' AS split, ", 1))
def metrics_store(spark, sf_dir):
    """Metric rows of a run stored, stored again and read back (K6)."""
    path = scratch_path(spark, "metrics-store")
    rows = _rounded(_metrics(spark, sf_dir)).select(F.lit("popularity").alias("split"), "*")
    for _ in range(2):  # the second time as a retried job would
        store_metrics(rows, path, "popularity")
    return spark.read.parquet(path).drop("run")


#: Per-user lists: a user's items by score of the table factors; truth: those the user has read.
LIST_METRICS = f"""preds AS (SELECT user_id, item_id, pos FROM (SELECT user_id, item_id,
           row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS pos FROM scores) WHERE pos <= {K}),
truth AS (SELECT DISTINCT user_id, item_id FROM interactions WHERE is_read = 1),
nt AS (SELECT user_id, count(*) AS n_truth FROM truth WHERE user_id IN (SELECT user_id FROM preds) GROUP BY 1),
hits AS (SELECT t.user_id, p.pos, row_number() OVER (PARTITION BY t.user_id ORDER BY p.pos) AS hr
         FROM truth t JOIN preds p USING (user_id, item_id)),
agg AS (SELECT user_id, count(*) AS hk, sum(1.0 / log2(pos + 1)) AS dcg, sum(CAST(hr AS DOUBLE) / pos) AS ap FROM hits GROUP BY 1),
ideal AS (SELECT i AS m, sum(1.0 / log2(i + 1)) OVER (ORDER BY i) AS idcg FROM range(1, {K + 1}) r(i)),
per_user AS (SELECT nt.user_id, nt.n_truth, coalesce(hk, 0) AS hk, coalesce(dcg, 0) AS dcg, coalesce(ap, 0) AS ap, idcg
             FROM nt LEFT JOIN agg USING (user_id) JOIN ideal ON ideal.m = least(nt.n_truth, {K}))"""


@register("ranking_metrics_lists", O.with_(O.INTERACTIONS, O.PAIR_SCORES, LIST_METRICS) + ALL_METRICS)
def ranking_metrics_lists(spark, sf_dir):
    """Metrics of per-user lists against held truth rows."""
    inter = fx.interactions(spark, sf_dir)
    scored = PR.score_pairs(inter.select("user_id", "item_id"), fx.item_factors(spark, sf_dir), fx.user_factors(spark, sf_dir))
    preds = FA.top_k_scores(scored, K).withColumnRenamed("rank", "pos")
    return _rounded(RK.ranking_metrics(preds, inter.filter("is_read = 1"), K))
