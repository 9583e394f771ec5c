"""Block products: pruned top-k and pair scoring against plain loops, and hot keys over many tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import products as PR
from tessera.operators.grouped import rank_by_int_key

FACTORS = "id long, features array<double>"


def whole(rng, n, rank=4, spread=9, first=0):
    """Whole-numbered factors, so every way of summing gives the same product and ties are ties."""
    return [(first + k, rng.integers(-spread, spread + 1, rank).astype(float).tolist()) for k in range(n)]


def brute(sources, targets, k):
    out = []
    for s, x in sources:
        best = sorted(((-float(np.dot(x, y)), t) for t, y in targets))[:k]
        out += [(s, t, -v, p + 1) for p, (v, t) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("source_block,target_block", [(None, None), (7, 11), (1000, 5)])
def test_skipped_blocks_change_nothing(spark, source_block, target_block):
    rng = np.random.default_rng(1)
    sources, targets = whole(rng, 40) + [(99, [0.0] * 4)], whole(rng, 90, first=500)
    got = PR.top_k_products(spark.createDataFrame(sources, FACTORS), spark.createDataFrame(targets, FACTORS), 6, "a", "b", source_block, target_block)
    assert sorted(map(tuple, got.collect())) == brute(sources, targets, 6)


def test_lists_leave_a_task_in_frames(spark, monkeypatch):
    """One block of sources, several of targets: a task gives its lists out in pieces, with ties cut by id and each list in order."""
    rng = np.random.default_rng(6)
    sources, targets = whole(rng, 60, spread=2) + [(98, [0.0] * 4)], whole(rng, 80, spread=2, first=500)
    monkeypatch.setattr(PR, "LIST_ROWS", 20)
    monkeypatch.setattr(PR, "SCORES", 200)
    lists = PR.Lists(3, 2, "i4")
    lists.put(np.array([0, 0, 2]), np.array([8, 5, 4]), np.array([1.0, 1.0, -3.0]))
    lists.put(np.array([0, 2]), np.array([6, 3]), np.array([1.0, -3.0]))
    frames = list(lists.rows(np.array([10, 20, 30])))
    assert [tuple(r) for f in frames for r in f.itertuples(index=False)] == [(10, 5, 1.0, 1), (10, 6, 1.0, 2), (30, 3, -3.0, 1), (30, 4, -3.0, 2)]
    for size in (None, 9):
        got = PR.top_k_products(spark.createDataFrame(sources, FACTORS), spark.createDataFrame(targets, FACTORS), 7, "a", "b", 100, size)
        assert "FlatMapCoGroups" not in got._jdf.queryExecution().toString() and "Window" not in got._jdf.queryExecution().toString()
        assert sorted(map(tuple, got.collect())) == brute(sources, targets, 7)


def test_pair_scores_gather_few_factors_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(7)
    items, users = whole(rng, 30), whole(rng, 30)
    pairs = [(int(a), int(b)) for a, b in zip(rng.integers(0, 30, 500), rng.integers(0, 30, 500))]
    monkeypatch.setattr(PR, "PAIR_ROWS", 16)
    got = PR.score_pairs(spark.createDataFrame(pairs, "user_id int, item_id int"), spark.createDataFrame(items, FACTORS), spark.createDataFrame(users, FACTORS))
    assert sorted((r.user_id, r.item_id, r.score) for r in got.collect()) == _scored(pairs, items, users)


def test_small_norms_are_never_sent(spark, monkeypatch):
    """Targets far shorter than the best ones: no block of them meets a source, and each target travels once a source block."""
    rng = np.random.default_rng(2)
    targets = [(k, (rng.random(4) * (100 if k < 20 else 0.01) + 0.001).tolist()) for k in range(200)]
    sources = [(k, (rng.random(4) + 0.1).tolist()) for k in range(60)]
    stored, seen = PR._stored, {}

    def spy(df, name):
        seen[name] = stored(df, name)
        return seen[name]

    monkeypatch.setattr(PR, "_stored", spy)
    got = PR.top_k_products(spark.createDataFrame(sources, FACTORS), spark.createDataFrame(targets, FACTORS), 5, "a", "b", 30, 20)
    rows = sorted(map(tuple, got.collect()))
    want = brute(sources, targets, 5)
    assert [r[:2] + r[3:] for r in rows] == [w[:2] + w[3:] for w in want]
    assert seen["targets-by-norm"].count() >= 8
    # Of ten target blocks at most the two that hold long targets are needed.
    assert seen["floors"].agg(F.max("reach")).first()[0] <= 2


def _scored(pairs, items, users):
    i, u = dict(items), dict(users)
    return sorted((a, b, float(np.dot(u[a], i[b]))) for a, b in pairs if a in u and b in i)


@pytest.mark.parametrize("block_bytes,cell_pairs", [(1 << 25, 1 << 20), (400, 50)])
def test_pairs_brute_force(spark, block_bytes, cell_pairs):
    rng = np.random.default_rng(3)
    items, users = whole(rng, 50), whole(rng, 40)
    pairs = [(int(a), int(b)) for a, b in zip(rng.integers(0, 45, 900), rng.integers(0, 55, 900))]
    df = spark.createDataFrame(pairs + [(None, 1), (1, None)], "user_id int, item_id long").withColumn("_u2", F.lit("kept"))
    got = PR.score_pairs(df, spark.createDataFrame(items, FACTORS), spark.createDataFrame(users, FACTORS), block_bytes=block_bytes, cell_pairs=cell_pairs)
    assert got.columns == ["user_id", "item_id", "_u2", "score"] and dict(got.dtypes)["user_id"] == "int"
    assert sorted((r.user_id, r.item_id, r.score) for r in got.collect()) == _scored(pairs, items, users)
    none = PR.score_pairs(df.limit(0), spark.createDataFrame(items, FACTORS), spark.createDataFrame([], FACTORS))
    assert none.collect() == []


def test_hot_user_is_scored_by_many_tasks(spark):
    """A user on a third of the pairs: its cells are cut into parts, each a group of its own."""
    rng = np.random.default_rng(4)
    items, users = whole(rng, 300), whole(rng, 200)
    pairs = [(7, k) for k in range(300)] + [(int(a), int(b)) for a, b in zip(rng.integers(0, 200, 600), rng.integers(0, 300, 600))]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.createDataFrame(pairs, "user_id int, item_id int")
        got = PR.score_pairs(df, spark.createDataFrame(items, FACTORS), spark.createDataFrame(users, FACTORS), block_bytes=2000, cell_pairs=20)
        where = got.filter("user_id = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(key, before)
    assert len(where) >= 3 and max(r["count"] for r in where) <= 200
    assert sorted((r.user_id, r.item_id, r.score) for r in got.collect()) == _scored(pairs, items, users)


def test_sparse_ids_of_one_user_give_few_pieces(spark):
    rng = np.random.default_rng(5)
    ids = np.unique(rng.integers(-(1 << 62), 1 << 62, 200_000))
    df = spark.createDataFrame([(1, int(i)) for i in rng.permutation(ids)], "user_id int, item_id long").repartition(8)
    ranked = rank_by_int_key(df, "user_id", "item_id", bucket_width=20_000)
    plan = ranked._jdf.queryExecution().analyzed().toString()
    assert "_pid" in plan
    hot = ranked.agg(F.min("idx"), F.max("idx"), F.countDistinct("idx"), F.min("n"), F.max("n")).first()
    assert tuple(hot) == (1, len(ids), len(ids), len(ids), len(ids))
    wrong = ranked.toPandas().sort_values("idx")["item_id"].to_numpy()
    assert (wrong == ids).all()
    pieces = spark.read.parquet(ranked.inputFiles()[0].rsplit("/", 1)[0]).select("_pid").distinct().count()
    assert pieces <= 12
