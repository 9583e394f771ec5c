import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.functions.arrays import dot, euclidean_distance
from tessera.functions.hashing import hash_unit, hash_unit_sql


@pytest.mark.parametrize("seed", ["sample", "split", "item", "row"])
def test_hash_position_matches_duckdb(spark, seed):
    rnd = random.Random(seed)
    ids = [rnd.randint(-(2**31), 2**31 - 1) for _ in range(300)] + [0, 1, 7, 123456]
    pairs = [(i, rnd.randint(0, 10**6)) for i in ids]
    df = spark.createDataFrame(pairs, "a int, b int")
    got1 = {(r.a, r.b): r.h for r in df.select("a", "b", hash_unit(seed, "a").alias("h")).collect()}
    got2 = {(r.a, r.b): r.h for r in df.select("a", "b", hash_unit(seed, "a", "b").alias("h")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(a INTEGER, b INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    rows = con.execute(f"SELECT a, b, {hash_unit_sql(seed, 'a')}, {hash_unit_sql(seed, 'a', 'b')} FROM t").fetchall()
    for a, b, h1, h2 in rows:
        assert got1[(a, b)] == h1 and got2[(a, b)] == h2
    assert all(0 <= v < 1 for v in got1.values()) and len(set(got1.values())) == len(set(ids))


def test_small_fractions_are_not_rounded_away(spark):
    from tessera.operators import splits as S

    users = spark.range(2_000_000).withColumnRenamed("id", "user_id")
    for fraction in (1e-5, 4e-5, 1.5e-4):
        n = S.sample_users(users, fraction, min_interactions=1).count()
        assert abs(n - 2_000_000 * fraction) < 5 * (2_000_000 * fraction) ** 0.5


def test_array_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "a array<float>, b array<float>")
    r = df.select(dot("a", "b").alias("d"), euclidean_distance("a", "b").alias("e")).first()
    assert r.d == pytest.approx(32.0) and r.e == pytest.approx(27 ** 0.5)


def test_item_side_evaluation(spark):
    from tessera.operators import models as M
    from tessera.operators import splits as S
    from tessera.sources import fixtures as fx
    from tests.conftest import SF001

    parts = S.assign_parts(fx.interactions(spark, SF001))
    model = M.fit_als(S.final_table(parts, "final_train_val"), rank=4, max_iter=3, seed=1)
    val = S.final_table(parts, "final_val")
    m = M.evaluate_topk(model, val, 10, for_="items").first()
    assert m.n_users > 0 and 0.0 <= m.precision_at_k <= 1.0
    recs = M.recommend(model, 10, val.select("item_id").distinct(), "items")
    assert recs.agg(F.max("pos")).first()[0] == 10


def test_input_validation(spark):
    from tessera.operators import neighbors as N
    from tessera.operators import ranking as RK
    from tessera.operators import splits as S

    df = spark.createDataFrame([(1, 2)], "user_id int, item_id int")
    with pytest.raises(ValueError):
        S.sample_users(df, 0.0)
    with pytest.raises(ValueError):
        S.user_split_col(fractions=(0.5, 0.2, 0.2))
    with pytest.raises(ValueError):
        N.lattice_offsets(3, 0)
    preds = spark.createDataFrame([(1, 2, 1)], "user_id int, item_id int, pos int")
    with pytest.raises(ValueError):
        RK.ranking_metrics(preds, df, 0)
