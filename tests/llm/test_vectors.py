"""Nearest-neighbour operators on awkward rows and against brute force."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from tessera.llm import ann, exact_topk, vectors

VEC = "vec_id long, embedding array<float>, label int"


def awkward(spark):
    rng = np.random.default_rng(7)
    rows = [(k, rng.normal(size=6).astype("f4").tolist(), 0) for k in range(120)]
    hot = rng.normal(size=6).astype("f4").tolist()
    rows += [(1000 + k, hot, 1) for k in range(60)]  # one very common vector
    rows += [(20, None, 0), (40, [], 0), (60, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (80, [float("nan")] * 6, 0), (-20, [float("inf")] * 6, 0)]
    rows += [(300, [0.0] * 6, 0), (-40, [1.0, 2.0], 0), (401, [2.0, 2.0], 0), (None, hot, 0), (40, hot, 0), (40, hot, 0)]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], VEC + ", q long, score long")


def usable(rows, zero):
    ok = [(i, np.array(v, "f4").astype(float)) for i, v, _ in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    return [(i, v) for i, v in ok if zero or np.any(v != 0)]


def brute(vectors, k, score):
    """Per query row its sorted list; repeated query ids give repeated lists."""
    out = {}
    for i, q in vectors:
        if i % 20 == 0:
            found = sorted((-score(q, v), j) for j, v in vectors if j != i and len(v) == len(q))
            out.setdefault(i, []).append([(j, -s) for s, j in found[:k]])
    return out


def lists(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(x) for q, x in out.items()}


def test_exact_top_k_equals_brute_force(spark):
    rows, df = awkward(spark)
    vectors = [(i, np.floor(64 * v).astype(np.int64)) for i, v in usable(rows, True)]
    want = brute(vectors, 20, lambda a, b: int(a @ b))
    got = lists(exact_topk.exact_top_k(df))
    assert set(got) == {q for q, x in want.items() if any(x)}
    for q, answers in want.items():
        flat = sorted((n + 1, j, s) for a in answers for n, (j, s) in enumerate(a))
        assert got.get(q, []) == flat


@pytest.mark.parametrize("dim,scale", [(3, 1), (64, 1), (8, 2**27)])
def test_elimination_is_exact_over_blocks(dim, scale):
    """Also with integers whose products are beyond double precision."""
    rng = np.random.default_rng(dim)
    x = rng.integers(-9, 10, (700, dim)) * scale
    x[300:400] = x[0]
    ids, q = np.arange(700), x[::20]
    pivots = exact_topk.choose_pivots(x[:200].astype(float), 8)
    best, best_id = np.full((len(q), 20), exact_topk._NONE), np.zeros((len(q), 20), np.int64)
    qd = exact_topk.pivot_distances(q.astype(float), pivots)
    for a in range(0, 700, 128):
        b = x[a : a + 128]
        best, best_id = exact_topk.search_block(q, ids[::20], b, ids[a : a + 128], qd, exact_topk.pivot_distances(b.astype(float), pivots), best, best_id, 20)
    for k, i in enumerate(range(0, 700, 20)):
        want = sorted((-int(s), j) for j, s in enumerate(x @ q[k]) if j != i)[:20]
        assert [(-s, j) for s, j in zip(best[k].tolist(), best_id[k].tolist())] == want


def test_elimination_saves_work_where_bounds_are_tight():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 4)) * 400
    x = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 4))).astype(np.int64)
    q, ids = x[:100], np.arange(4000)
    pivots, evaluated = exact_topk.choose_pivots(x[:500].astype(float), 16), []
    d = lambda v: exact_topk.pivot_distances(v.astype(float), pivots)
    best = np.full((100, 20), exact_topk._NONE)
    exact_topk.search_block(q, ids[:100], x, ids, d(q), d(x), best, best * 0, 20, evaluated)
    assert sum(evaluated) < 0.5 * 100 * 4000


def test_nearest_recall_and_form(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in df.collect()]
    want = brute(rows, 20, lambda a, b: float(a @ b))
    hits = 0
    for shard_rows in (500, 8192):
        got = lists(ann.nearest(df, shard_rows=shard_rows))
        assert set(got) == set(want)
        x = dict(rows)
        for q, found in got.items():
            assert [r for r, _, _ in found] == list(range(1, 21))
            assert all(abs(s - x[q] @ x[j]) < 1e-12 for _, j, s in found)
            assert [(-s, j) for _, j, s in found] == sorted((-s, j) for _, j, s in found)
        hits = sum(len({j for _, j, _ in got[q]} & {j for j, _ in want[q][0]}) for q in want)
        assert hits >= 0.9 * 20 * len(want)


def test_nearest_awkward(spark):
    rows, df = awkward(spark)
    vectors = usable(rows, False)
    want = brute(vectors, 20, lambda a, b: float(a @ b))
    got = lists(ann.nearest(df, shard_rows=40))
    assert set(got) == {q for q, x in want.items() if any(x)}
    hit = total = 0
    for q, answers in want.items():
        for n, a in enumerate(answers):
            mine = [(j, s) for _, j, s in got.get(q, [])]
            hit += sum(any(j == i and abs(s - t) < 1e-9 for i, t in mine) for j, s in a)
            total += len(a)
    assert hit >= 0.95 * total


def test_ties_of_a_common_vector_go_to_the_smaller_ids(spark):
    rows = [(k, [1.0, 1.0], 0) for k in range(200)]
    df = spark.createDataFrame(rows, VEC)
    for got in (lists(ann.nearest(df, shard_rows=64)), lists(exact_topk.exact_top_k(df))):
        for q, found in got.items():
            assert [j for _, j, _ in found] == [j for j in range(21) if j != q][:20]


@pytest.mark.parametrize("parts", [1, 64])
def test_many_query_blocks_in_a_group(spark, monkeypatch, parts):
    """Every query keeps its k answers where several query blocks and candidate blocks share a group."""
    monkeypatch.setattr(vectors, "PARTS", parts)
    monkeypatch.setattr(ann, "QUERY_ROWS", 8)
    monkeypatch.setattr(exact_topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(exact_topk, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(3)
    data = [(k, rng.normal(size=5).astype("f4").tolist(), 0) for k in range(1000)]
    df = spark.createDataFrame(data, VEC)
    x = {i: np.array(v, "f4").astype(float) for i, v, _ in data}
    want = brute(list(x.items()), 20, lambda a, b: float(a @ b))
    got = lists(ann.nearest(df, shard_rows=150))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert sum(len({j for _, j, _ in got[q]} & {j for j, _ in want[q][0]}) for q in want) >= 0.98 * 20 * len(want)
    whole = {i: np.floor(64 * v).astype(np.int64) for i, v in x.items()}
    exact = brute(list(whole.items()), 20, lambda a, b: int(a @ b))
    assert lists(exact_topk.exact_top_k(df)) == {q: [(n + 1, j, s) for n, (j, s) in enumerate(a[0])] for q, a in exact.items()}


def test_repeated_rows_are_spread_over_blocks(spark):
    """A third of all rows equal in id and vector: no block is far above its size."""
    rows = spark.range(0, 6000, 1, 4).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("vec_id"), F.array(F.lit(1.0), (F.col("id") % 3).cast("double")).alias("x"))
    cut = vectors.blocks(vectors.numbered(rows, "test-vectors"), 500, "<f8")
    sizes = [len(r["ids"]) // 8 for r in cut.select("ids").collect()]
    assert len(sizes) == 12 and sum(sizes) == 6000 and max(sizes) < 650


@pytest.mark.parametrize("query_bytes, candidate_bytes, parts", [(16 << 20, 32 << 20, 64), (1, 1, 64), (2 * 8 * 6 * 4, 3 * 8 * 6 * 10, 1)])
def test_every_query_block_meets_every_candidate_block_once(spark, monkeypatch, query_bytes, candidate_bytes, parts):
    for name, value in (("QUERY_BYTES", query_bytes), ("CANDIDATE_BYTES", candidate_bytes), ("PARTS", parts)):
        monkeypatch.setattr(vectors, name, value)
    side = lambda n: spark.createDataFrame([(6, k) for k in range(n)] + [(2, 0)], "dim int, block int")
    q, c = vectors.met(side(5), side(13), 4, 10)
    pairs = [tuple(r) for r in q.join(c, ["dim", "batch", "part"]).select("dim", "qblock", "block").collect()]
    assert sorted(pairs) == sorted([(6, a, b) for a in range(5) for b in range(13)] + [(2, 0, 0)])


def test_empty_tables_and_few_candidates(spark):
    none = spark.createDataFrame([], VEC)
    assert ann.nearest(none).count() == 0 and exact_topk.exact_top_k(none).count() == 0
    two = spark.createDataFrame([(20, [1.0], 0), (21, [2.0], 0)], VEC)
    assert lists(ann.nearest(two)) == {20: [(1, 21, 2.0)]}
    assert lists(exact_topk.exact_top_k(two)) == {20: [(1, 21, 64 * 128)]}
    one = spark.createDataFrame([(20, [1.0], 0)], VEC)
    assert ann.nearest(one).count() == 0 and exact_topk.exact_top_k(one).count() == 0
