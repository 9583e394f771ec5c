import hashlib
import itertools
import math
import random

import pytest

from tessera.operators import factors as FA
from tessera.operators import products as PR
from tessera.operators import neighbors as N


def _vecs(spark, rows):
    return spark.createDataFrame(rows, "item_id int, features array<int>")


def test_lattice_offset_counts():
    assert len(N.lattice_offsets(10, 0.8)) == 1
    assert len(N.lattice_offsets(10, 1.5)) == 1 + 20 + 180
    assert all(sum(v * v for v in d) < 1.5 * 1.5 for d in N.lattice_offsets(3, 1.5))
    assert N.lattice_offsets(10, 3.5, most=2000) is None


def test_radius_edge_real_valued(spark):
    left = spark.createDataFrame([(1, [0.0, 0.0])], "item_id int, features array<double>")
    right = spark.createDataFrame([(2, [1.5, 0.0]), (3, [1.0, 1.0]), (4, [0.3, 0.2])], "item_id int, features array<double>")
    got = {r.right_id for r in N.exact_radius_join(left, right, 1.5, integral=False).collect()}
    assert got == {3, 4}
    auto = {r.right_id for r in N.exact_radius_join(left, right, 1.5, integral=None).collect()}
    assert auto == {3, 4}


def test_radius_edge_integer(spark):
    left = _vecs(spark, [(1, [0, 0, 0])])
    right = _vecs(spark, [(2, [1, 1, 0]), (3, [1, 1, 1]), (4, [0, 0, 0]), (5, [2, 0, 0])])
    got = {r.right_id: r.distance for r in N.exact_radius_join(left, right, 1.5).collect()}
    assert set(got) == {2, 4} and got[2] == pytest.approx(math.sqrt(2))


def test_repeated_rows_give_one_pair(spark):
    left = _vecs(spark, [(1, [1, 2, 3])] * 3)
    right = _vecs(spark, [(10, [1, 2, 3])] * 4)
    assert N.exact_radius_join(left, right, 1.5).count() == 1


def _brute(left, right, r):
    out = set()
    for (a, va), (b, vb) in itertools.product(left, right):
        if math.dist(va, vb) < r:
            out.add((a, b))
    return out


@pytest.mark.parametrize("radius", [0.8, 1.5, 2.3])
def test_exact_join_matches_brute_force(spark, radius):
    rnd = random.Random(7)
    left = [(i, [rnd.randint(0, 2) for _ in range(4)]) for i in range(60)]
    right = [(100 + i, [rnd.randint(0, 2) for _ in range(4)]) for i in range(80)]
    got = {(r.left_id, r.right_id) for r in N.exact_radius_join(_vecs(spark, left), _vecs(spark, right), radius).collect()}
    assert got == _brute(left, right, radius)


def test_grid_join_matches_brute_force(spark):
    rnd = random.Random(3)
    left = [(i, [rnd.uniform(0, 3) for _ in range(3)]) for i in range(50)]
    right = [(100 + i, [rnd.uniform(0, 3) for _ in range(3)]) for i in range(50)]
    schema = "item_id int, features array<double>"
    got = N.exact_radius_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), 1.0, integral=False)
    assert {(r.left_id, r.right_id) for r in got.collect()} == _brute(left, right, 1.0)


def test_lsh_subset_of_exact(spark):
    rnd = random.Random(11)
    left = _vecs(spark, [(i, [rnd.randint(0, 3) for _ in range(5)]) for i in range(80)])
    right = _vecs(spark, [(100 + i, [rnd.randint(0, 3) for _ in range(5)]) for i in range(120)])
    exact = N.exact_radius_join(left, right, 1.5).select("left_id", "right_id")
    approx = N.approximate_radius_join(left, right, 1.5).select("left_id", "right_id")
    assert approx.exceptAll(exact).count() == 0


def test_counts_and_extremes(spark):
    pairs = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "left_id int, right_id int")
    c = N.neighbor_counts(pairs)
    e = N.neighbor_count_extremes(c).first()
    assert (e.min_count, e.max_count) == (1, 2)


def test_signature_imputation_equals_pairwise_mean(spark):
    rnd = random.Random(5)
    cold = _vecs(spark, [(i, [rnd.randint(0, 2) for _ in range(3)]) for i in range(40)])
    warm = _vecs(spark, [(100 + i, [rnd.randint(0, 2) for _ in range(3)]) for i in range(60)])
    factors = spark.createDataFrame(
        [(100 + i, [rnd.uniform(0, 1) for _ in range(4)]) for i in range(0, 60, 2)], "id int, features array<float>"
    )
    by_sig = FA.impute_by_signature(cold, warm, factors, 1.5)
    pairs = N.exact_radius_join(cold, warm, 1.5)
    by_pair = FA.mean_of_neighbors(pairs, factors)
    a = {r.id: r.features for r in by_sig.collect()}
    b = {r.id: r.features for r in by_pair.collect()}
    assert a.keys() == b.keys() and len(a) > 0
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-9)


def test_extend_and_score(spark):
    learned = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<float>")
    imputed = spark.createDataFrame([(1, [9.0, 9.0]), (2, [0.5, 0.5])], "id int, features array<double>")
    ext = {r.id: r.features for r in FA.extend_factors(learned, imputed).collect()}
    assert ext == {1: [1.0, 2.0], 2: [0.5, 0.5]}
    users = spark.createDataFrame([(7, [2.0, 1.0])], "id int, features array<float>")
    pairs = spark.createDataFrame([(7, 1), (7, 2), (8, 1), (7, 3)], "user_id int, item_id int")
    scored = {(r.user_id, r.item_id): r.score for r in PR.score_pairs(pairs, FA.extend_factors(learned, imputed), users).collect()}
    assert scored == {(7, 1): 4.0, (7, 2): 1.5}


def test_wide_factors_drop_short_rows(spark):
    f = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0])], "id int, features array<float>")
    rows = FA.wide_factors(f, 2).collect()
    assert [(r.id, r.f0, r.f1) for r in rows] == [(1, 1.0, 2.0)]


def test_imputed_only_for_items_with_factored_neighbours(spark):
    cold = _vecs(spark, [(1, [0, 0]), (2, [5, 5]), (3, [9, 9])])
    warm = _vecs(spark, [(10, [0, 1]), (11, [5, 5]), (12, [9, 9])])
    factors = spark.createDataFrame([(10, [1.0, 3.0]), (11, [2.0, 2.0])], "id int, features array<float>")
    got = {r.id: r.features for r in FA.impute_by_signature(cold, warm, factors, 1.5).collect()}
    assert got == {1: [1.0, 3.0], 2: [2.0, 2.0]}


DOUBLES = "item_id int, features array<double>"


def test_whole_numbers_as_doubles_negative_zero_and_mixed_types(spark):
    left = spark.createDataFrame([(1, [1.0, 0.0, 2.0]), (2, [-0.0, 0.0, 0.0]), (3, [5.0, 5.0, 5.0])], DOUBLES)
    right = _vecs(spark, [(10, [1, 0, 2]), (11, [0, 0, 0]), (12, [1, 1, 2])])
    got = {(r.left_id, r.right_id) for r in N.exact_radius_join(left, right, 1.5).collect()}
    assert got == {(1, 10), (1, 12), (2, 11)}
    a = spark.createDataFrame([(1, [-0.0, 0.25])], DOUBLES)
    b = spark.createDataFrame([(2, [0.0, 0.25]), (3, [0.0, float("nan")]), (4, [None, 0.25]), (5, None), (6, [0.0])], DOUBLES)
    assert {r.right_id for r in N.exact_radius_join(a, b, 1.0).collect()} == {2}
    factors = spark.createDataFrame([(2, [1.0, 3.0])], "id int, features array<float>")
    assert [tuple(r) for r in FA.impute_by_signature(a, b, factors, 1.0).collect()] == [(1, [1.0, 3.0])]


@pytest.mark.parametrize("dim,radius", [(10, 3.5), (14, 1.2), (1, 0.5)])
def test_wide_vectors_and_large_radii_match_brute_force(spark, dim, radius):
    rnd = random.Random(dim)
    make = lambda at, n, f: [(at + i, [f() for _ in range(dim)]) for i in range(n)]
    for f in (lambda: float(rnd.randint(0, 2)), lambda: rnd.uniform(0, 1.5)):
        left, right = make(0, 40, f), make(100, 50, f)
        got = N.exact_radius_join(spark.createDataFrame(left, DOUBLES), spark.createDataFrame(right, DOUBLES), radius)
        assert {(r.left_id, r.right_id) for r in got.collect()} == _brute(left, right, radius)


def test_counts_without_pairs_equal_counted_pairs(spark):
    rnd = random.Random(9)
    left = _vecs(spark, [(i % 50, [rnd.randint(0, 1) for _ in range(3)]) for i in range(60)])
    right = _vecs(spark, [(100 + i, [rnd.randint(0, 1) for _ in range(3)]) for i in range(80)])
    counts = N.count_neighbors(left, right, 1.2)
    pairs = N.exact_radius_join(left, right, 1.2)
    # an id with two vectors counts a neighbour once for each of them, as pairs with two distances
    want = N.neighbor_counts(pairs.select("left_id", "right_id"))
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in want.collect()}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "right_ids" not in plan and "right_id#" not in plan


def test_a_vector_shared_by_a_third_is_written_by_many_tasks(spark):
    from pyspark.sql import functions as F

    n = 6000
    rows = [(i, [1, 1] if i % 3 == 0 else [i, -i]) for i in range(n)]
    df = _vecs(spark, rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        lv = N._vectors(df, "item_id", "features")
        pairs = N._expanded(N.vector_pairs(lv, lv, 0.5), lv, lv, "a", "b", chunk_ids=250)
        per_task = pairs.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    total = sum(r["count"] for r in per_task)
    assert total == (n // 3) ** 2 + (n - n // 3)
    assert len(per_task) >= 16 and max(r["count"] for r in per_task) < total / 4


def test_lsh_imputation_equals_exact_for_equal_vectors(spark):
    rnd = random.Random(6)
    cold = _vecs(spark, [(i, [rnd.randint(0, 2) for _ in range(3)]) for i in range(30)])
    warm = _vecs(spark, [(100 + i, [rnd.randint(0, 2) for _ in range(3)]) for i in range(40)])
    factors = spark.createDataFrame([(100 + i, [float(i), 1.0]) for i in range(40)], "id int, features array<float>")
    find = lambda a, b: N.approximate_vector_pairs(a, b, 0.8, num_hash_tables=5)
    a = {r.id: r.features for r in FA.impute_by_signature(cold, warm, factors, 0.8).collect()}
    b = {r.id: r.features for r in FA.impute_by_signature(cold, warm, factors, 0.8, find_pairs=find).collect()}
    assert a == b and a


def test_lsh_recall_and_truth(spark):
    rnd = random.Random(11)
    left = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    right = [(1000 + i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(200)]
    dl, dr = (spark.createDataFrame(x, "item_id int, features array<double>") for x in (left, right))
    want = _brute(left, right, 1.2)
    wide = N.approximate_radius_join(dl, dr, 1.2, bucket_length=1.2).select("left_id", "right_id").collect()
    assert sorted(map(tuple, wide)) == sorted(want)
    narrow = [tuple(r) for r in N.approximate_radius_join(dl, dr, 1.2, bucket_length=0.5, num_hash_tables=4).select("left_id", "right_id").collect()]
    assert len(narrow) == len(set(narrow)) and set(narrow) <= want and len(narrow) >= 0.9 * len(want)


def test_crowded_keys_are_cut(spark, monkeypatch):
    """Half of all vectors in one grid cell and one bucket: the same pairs, from many tasks."""
    from pyspark.sql import functions as F

    rnd = random.Random(12)
    make = lambda first, n: [(first + i, [rnd.random() * (0.4 if i % 2 else 9.0) + 0.01 for _ in range(3)]) for i in range(n)]
    left, right = make(0, 120), make(1000, 160)
    dl, dr = (spark.createDataFrame(x, "item_id int, features array<double>") for x in (left, right))
    want = _brute(left, right, 0.5)
    monkeypatch.setattr(N, "CROWD", 10)
    join = N._crowded_join
    seen = []

    def spy(a, b, key, x, y, crowd=10):
        out = join(a, b, key, x, y, 10)
        plain = a.join(b, key)
        seen.append((plain.groupBy(F.col(key)).count().agg(F.max("count")).first()[0], out.count() == plain.count()))
        return out

    monkeypatch.setattr(N, "_crowded_join", spy)
    grid = {(r.left_id, r.right_id) for r in N.exact_radius_join(dl, dr, 0.5, integral=False).collect()}
    lsh = {(r.left_id, r.right_id) for r in N.approximate_radius_join(dl, dr, 0.5, bucket_length=0.5).collect()}
    assert grid == lsh == want and all(n > 1000 and same for n, same in seen)
    key = spark.createDataFrame([(1, k) for k in range(300)], "k int, a int")
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        spread = join(key, key.withColumnRenamed("a", "b"), "k", "a", "b", 20).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["count"] for r in spread) == 300 * 300 and len(spread) >= 3 and max(r["count"] for r in spread) < 0.6 * 300 * 300


def test_class_pairs_count_every_pair_of_ids(spark):
    """Copies stay folded: as many pairs as the joins list, from as many rows as there are pairs of vectors."""
    rows = [(k, [k % 3, k % 2]) for k in range(60)]
    df = spark.createDataFrame(rows + rows[:5] + [(99, None)], "item_id int, features array<int>")
    left, right = df.filter("item_id < 30"), df.filter("item_id >= 30")
    for find, join in ((N.vector_pairs, N.exact_radius_join), (N.approximate_vector_pairs, N.approximate_radius_join)):
        folded = N.class_pairs(left, right, 1.2, find=find)
        pairs = join(left, right, 1.2)
        assert sum(r.n_pairs for r in folded.collect()) == pairs.count() > folded.count() == folded.select("left_vec", "right_vec").distinct().count()


def test_class_join_folds_copies_and_loses_no_pair(spark):
    """Rows grow with ids, not with pairs; links and members spread out again are the pairs of the full join."""
    rows = [(k, [k % 3, k % 2]) for k in range(60)]
    df = spark.createDataFrame(rows + rows[:5] + [(99, None), (None, [9, 9])], "item_id int, features array<int>")
    left, right = df.filter("item_id < 30 OR item_id IS NULL"), df.filter("item_id >= 30")
    for find, join in ((N.vector_pairs, N.exact_radius_join), (N.approximate_vector_pairs, N.approximate_radius_join)):
        got = N.class_join(left, right, 1.2, left_name="l", right_name="r", find=find).collect()
        want = sorted((p.left_id, p.right_id, round(p.distance, 6)) for p in join(left, right, 1.2).collect())
        of = {s: {} for s in "lr"}
        for m in got:
            if m.kind != "link":
                assert m.distance == 0 and m.other_class is None
                of[m.kind].setdefault(m.class_id, []).append(m.id)
        links = [m for m in got if m.kind == "link"]
        assert sorted((a, b, round(m.distance, 6)) for m in links for a in of["l"][m.class_id] for b in of["r"][m.other_class]) == want
        assert sum(m.n_links for m in links) == len(want) and len(got) == len(links) + 61 and len(links) < 36
        for side, at in (("l", 0), ("r", 1)):
            assert all(m.n_links == sum(p[at] == m.id for p in want) for m in got if m.kind == side)


def test_radius_queries_grow_with_items(spark, tmp_path):
    """Twice the items (keys shifted, profiles kept) are about twice the rows, where pairs of items are four times as many."""
    from pyspark.sql import functions as F

    from tessera.plans import catalog

    part = spark.range(1, 401).select(F.col("id").cast("int").alias("p_partkey"), F.lit("PROMO").alias("p_type"), (F.col("id") % 5).cast("int").alias("p_size"))
    n = {}
    for times in (1, 2):
        more = part.unionByName(part.withColumn("p_partkey", (F.col("p_partkey") + 3000).cast("int"))) if times == 2 else part
        more.write.parquet(f"{tmp_path}/{times}/part.parquet")
        for name in ("lsh",):
            n[name, times] = catalog.queries()[f"radius_neighbors_{name}"](spark, f"{tmp_path}/{times}").count()
    assert all(n[k, 2] <= 2 * n[k, 1] <= 2 * (400 + 15 * 15) for k, _ in n), n


#: Query, radius and what its features are divided by.
LISTING = [("exact", 1.5, 1), ("exact_double", 1.5, 1), ("grid", 1.5, 3), ("lsh_identical", 0.8, 1)]


def _listed(part, radius, unit):
    """(holdout, train, distance) of every pair of items by brute force: genres as in ``fixtures.item_genres``, ids dealt as in ``splits``."""
    from tessera.sources.fixtures import PART_TYPES

    held = lambda k: int(hashlib.md5(f"item:{k}".encode()).hexdigest()[:13], 16) / 16.0**13 >= 0.8
    vec = {k: [(1 + k % 3) * (t == x) for x in PART_TYPES] + [(1 + s % 7) * (s % 4 == c) for c in range(4)] for k, t, s in part}
    pairs = ((a, b, math.dist(vec[a], vec[b])) for a in vec if held(a) for b in vec if not held(b))
    return sorted((a, b, round(d / unit, 6)) for a, b, d in pairs if d < radius)


def test_radius_queries_list_every_pair(spark, tmp_path):
    """One row a pair of items, copies of a vector included, with its distance."""
    from tessera.plans import catalog

    part = [(k, ("PROMO", "LARGE", None)[k % 3], k % 5) for k in range(1, 121)]
    spark.createDataFrame(part, "p_partkey int, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    for name, radius, unit in LISTING:
        got = catalog.queries()[f"radius_neighbors_{name}"](spark, str(tmp_path))
        assert got.columns == ["holdout_id", "train_id", "distance"]
        want = _listed(part, radius, unit)
        assert len(want) > 120 and sorted(map(tuple, got.collect())) == want, name
