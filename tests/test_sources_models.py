import math

from pyspark.sql import functions as F

from tessera.operators import models as M
from tessera.operators.ranking import explode_recommendations
from tessera.operators import splits as S
from tessera.session import scratch_path
from tessera.sources import fixtures as fx
from tessera.sources import readers as R
from tests.conftest import SF001


def test_genre_json_absent_and_null_keys(spark):
    path = scratch_path(spark, "genre-test")
    lines = [
        '{"book_id": "10", "genres": {"children": 3, "young-adult": 1}}',
        '{"book_id": "17", "genres": {"fiction": null}}',
        '{"book_id": "24", "genres": {}}',
    ]
    spark.sparkContext.parallelize(lines, 1).saveAsTextFile(path)
    flat = {r.real_item_id: r for r in R.flatten_genres(R.read_genre_json(spark, path)).collect()}
    assert flat[10].children == 3 and flat[10].young_adult == 1 and flat[10].fiction == 0
    assert flat[17].fiction == 0
    assert sum(flat[24][c] for c in flat[24].asDict() if c != "real_item_id") == 0


def test_csv_roundtrip_with_declared_schema(spark):
    inter = fx.interactions(spark, SF001)
    path = scratch_path(spark, "csv-test")
    R.write_csv(inter, path, header=False)
    back = R.read_interactions_csv(spark, path, header=False)
    assert dict(back.dtypes) == {c: "bigint" if c.endswith("_id") else "int" for c in back.columns}
    assert back.exceptAll(inter).count() == 0 and inter.exceptAll(back).count() == 0


def test_parts_write_read_with_pruning(spark):
    parts = S.assign_parts(fx.interactions(spark, SF001))
    path = scratch_path(spark, "parts-test")
    S.write_parts(parts, path)
    for name in S.PART_SETS:
        a = S.read_part(spark, path, name)
        b = S.final_table(parts, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_als_fit_properties(spark):
    parts = S.assign_parts(fx.interactions(spark, SF001)).cache()
    train = S.final_table(parts, "final_train_val")
    model = M.fit_als(train, rank=5, max_iter=5, reg_param=0.1, seed=1)
    f = model.itemFactors.select(F.explode("features").alias("v"))
    assert f.filter((F.col("v") < 0) | F.isnan("v")).count() == 0
    train_rmse = M.rmse_of(model, train)
    mean = train.agg(F.avg("rating")).first()[0]
    base = math.sqrt(train.agg(F.avg((F.col("rating") - F.lit(mean)) ** 2)).first()[0])
    assert train_rmse < base
    # unseen item -> row dropped, RMSE finite
    val = S.final_table(parts, "final_val")
    unseen = val.limit(3).withColumn("item_id", F.lit(10_000_000))
    assert M.predict(model, unseen).count() == 0
    assert math.isfinite(M.rmse_of(model, val.unionByName(unseen)))


def test_model_save_load(spark):
    parts = S.assign_parts(fx.interactions(spark, SF001))
    train = S.final_table(parts, "final_train_val")
    model = M.fit_als(train, rank=4, max_iter=3, seed=3)
    path = scratch_path(spark, "model-test")
    M.save_model(model, path)
    loaded = M.load_model(path)
    a = M.predict(model, train).select("user_id", "item_id", "prediction")
    b = M.predict(loaded, train).select("user_id", "item_id", "prediction")
    assert a.exceptAll(b).count() == 0


def test_recommend_shapes(spark):
    parts = S.assign_parts(fx.interactions(spark, SF001))
    train = S.final_table(parts, "final_train_val")
    model = M.fit_als(train, rank=4, max_iter=3, seed=3)
    users = S.final_table(parts, "final_val").select("user_id").distinct()
    recs = M.recommend(model, 7, users, "users")
    per_user = recs.groupBy("user_id").agg(F.max("pos").alias("m"), F.count(F.lit(1)).alias("c")).collect()
    assert per_user and all(r.m == 7 and r.c == 7 for r in per_user)
    items = M.recommend(model, 5, None, "items")
    assert set(items.columns) == {"item_id", "user_id", "score", "pos"}


def test_tuning_picks_minimum_and_ranking_metric(spark):
    from tessera.plans.tune import tune_als

    parts = S.assign_parts(fx.interactions(spark, SF001))
    train, val = S.final_table(parts, "final_train_val"), S.final_table(parts, "final_val")
    report, best, idx = tune_als(train, val, ranks=(2, 4), max_iters=(3,), reg_params=(0.1, 0.3), parallelism=2)
    rows = report.collect()
    assert len(rows) == 4 and sum(r.is_best for r in rows) == 1
    assert min(rows, key=lambda r: (r.rmse, r.idx)).idx == idx
    report2, _, idx2 = tune_als(train, val, ranks=(2,), max_iters=(3,), reg_params=(0.1, 0.3), parallelism=2, metric="ndcg_at_k", top_k=20)
    rows2 = report2.collect()
    assert max(rows2, key=lambda r: (r.ndcg_at_k, -r.idx)).idx == idx2


def test_block_counts_follow_the_data_not_the_cluster():
    assert [M.block_count(n) for n in (0, 1, 100_000, 600_000, 10_000_000)] == [1, 1, 1, 6, 32]
    assert M.block_count(10**9) == 200 and M.block_count(10**12) == M.MOST_BLOCKS


def test_a_fit_ships_factors_to_few_blocks(spark, monkeypatch):
    """What MLlib writes grows with blocks x ids: few blocks of bounded size, fewer where fits run at a time, checkpoints often."""
    assert [M.fit_blocks(n) for n in (0, 100_000, 600_000, 30_000_000, 10**9)] == [1, 1, 6, 6, 34]
    assert [M.fit_blocks(n, 8) for n in (0, 10_000_000, 10**9)] == [1, 2, 34] and M.fit_blocks(10**12) == M.MOST_BLOCKS
    seen, make = [], M.make_als
    monkeypatch.setattr(M, "make_als", lambda **p: seen.append(make(**p)) or seen[-1])
    monkeypatch.setattr(M, "SMALL_BLOCK", 10)
    M.fit_als(spark.createDataFrame([(u, i, 1) for u in range(30) for i in range(12)], "user_id int, item_id int, rating int"), rank=2, max_iter=1, fits=2)
    assert seen[0].getNumUserBlocks() == seen[0].getNumItemBlocks() == 3 and seen[0].getCheckpointInterval() < 5


def test_top_k_products_equal_mllib(spark, monkeypatch):
    from tessera.operators import products as PR

    parts = S.assign_parts(fx.interactions(spark, SF001))
    model = M.fit_als(S.final_table(parts, "final_train_val"), rank=4, max_iter=3, seed=3)
    want: dict = {}
    for r in sorted(explode_recommendations(model.recommendForAllUsers(9), "user_id", "item_id").collect(), key=lambda r: (r.user_id, r.pos)):
        want.setdefault(r.user_id, []).append(r.score)
    for source, target in ((1024, 1 << 17), (10, 64)):  # also with several blocks on both sides
        monkeypatch.setattr(PR, "SOURCE_BLOCK", source)
        monkeypatch.setattr(PR, "TARGET_BLOCK", target)
        got: dict = {}
        for r in sorted(M.recommend(model, 9).collect(), key=lambda r: (r.user_id, r.pos)):
            got.setdefault(r.user_id, []).append((r.pos, r.score))
        assert got.keys() == want.keys()
        for u in want:
            assert [p for p, _ in got[u]] == list(range(1, 10))
            assert all(abs(a - b) < 1e-4 for (_, a), b in zip(got[u], want[u]))


def test_top_k_products_ties_and_odd_rows(spark):
    from tessera.operators import products as PR

    left = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, -1.0]), (None, [1.0, 1.0]), (3, None)], "id int, features array<float>")
    right = spark.createDataFrame([(9, [1.0, 1.0]), (7, [1.0, 2.0]), (8, [0.5, 0.0]), (None, [9.0, 9.0])], "id int, features array<float>")
    got = [tuple(r) for r in PR.top_k_products(left, right, 2, "a", "b").orderBy("a", "pos").collect()]
    assert got == [(1, 7, 1.0, 1), (1, 9, 1.0, 2), (2, 8, 0.0, 1), (2, 9, -1.0, 2)]
    assert PR.top_k_products(left, right.limit(0), 2).count() == PR.top_k_products(left.limit(0), right, 2).count() == 0
    assert PR.top_k_products(left, right, 50).count() == 6


def test_readers_take_foreign_names(spark):
    path, ids = scratch_path(spark, "books"), scratch_path(spark, "book-ids")
    fx.interactions(spark, SF001).withColumnRenamed("item_id", "book_id").write.parquet(path)
    assert "item_id" in R.read_interactions(spark, path, {"item_id": "book_id"}).columns
    spark.createDataFrame([("1", "x"), ("2", "4000000000")], "book_id_csv string, book_id string").write.option("header", "true").csv(ids)
    got = R.read_id_map(spark, ids, "csv", {"item_id": "book_id_csv", "real_item_id": "book_id"})
    assert [tuple(r) for r in got.collect()] == [(2, 4000000000)]


def test_quarantine_keeps_every_line(spark):
    path = scratch_path(spark, "lines")
    lines = ["9999999999,4,1,5,0", "1,2,1,5,0", "x,2,1,5,0", "1,,1,5,0", "1,2,1", "1,2,1,5,0,9", "1,2,1,,0", "92233720368547758079,2,1,5,0"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, rejects = R.quarantine_csv(spark, path, scratch_path(spark, "kept"))
    assert sorted((r.user_id, r.item_id) for r in good.collect()) == [(1, 2), (9999999999, 4)]
    got = {r["line"]: r["reason"] for r in rejects.collect()}
    assert {k for k, v in got.items() if v == "malformed"} == {"x,2,1,5,0", "1,2,1", "1,2,1,5,0,9", "92233720368547758079,2,1,5,0"}
    assert sorted(got.values()).count("missing key") == 2
    assert {r["reason"]: r["n_lines"] for r in R.reject_counts(rejects).collect()} == {"malformed": 4, "missing key": 2}


def test_json_quarantine(spark):
    path = scratch_path(spark, "json-lines")
    lines = ['{"book_id": "10", "genres": {"children": 3}}', '{"book_id": "11", "genres": ', '{"genres": {"fiction": 1}}', '{"book_id": "z"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    good, rejects = R.quarantine_genre_json(spark, path, scratch_path(spark, "kept-json"))
    assert [(r.book_id, r.children) for r in good.collect()] == [("10", 3)]
    assert {r["reason"]: r["n_lines"] for r in R.reject_counts(rejects).collect()} == {"malformed": 1, "missing key": 2}


def test_a_run_written_twice_replaces_its_rows(spark):
    from tessera.plans.evaluate import run_name, store_metrics

    path = scratch_path(spark, "metrics-runs")
    rows = spark.createDataFrame([("val", 0.5), ("test", 0.25)], "split string, x double")
    store_metrics(rows, path, run_name("a", 1))
    store_metrics(rows, path, run_name("b", 1))
    store_metrics(rows.withColumn("x", rows["x"] * 2), path, run_name("a", 1))
    got = sorted((r.run == run_name("a", 1), r.split, r.x) for r in spark.read.parquet(path).collect())
    assert got == [(False, "test", 0.25), (False, "val", 0.5), (True, "test", 0.5), (True, "val", 1.0)]


def test_large_fits_of_a_job_run_in_turn_in_small_blocks(spark, monkeypatch):
    """Two fits at a time hold twice the blocks: beyond ``TOGETHER`` ratings one waits for the other, and blocks stay small."""
    import threading
    import time

    from tessera.plans.coldstart import cold_start
    from tessera.plans.evaluate import holdout_report

    assert M.fits_together(40_000_000, 2) == {"fits": 2}
    large = M.fits_together(150_000_000, 2)
    assert M.fit_blocks(150_000_000, **large) == 12 and M.fit_blocks(150_000_000, 2) == M.fit_blocks(150_000_000, 1) - 1 == 5

    rows = spark.createDataFrame([(u, i, 1 + (u * i) % 5) for u in range(40) for i in range(20)], "user_id int, item_id int, rating int").cache()
    genres = spark.createDataFrame([(i, [i % 2, 1]) for i in range(20)], "item_id int, features array<int>")
    lock, now, most, blocks, fit = threading.Lock(), [0], [0], [], M.make_als

    def spy(**params):
        als, blocks_of = fit(**params), params["num_blocks"]

        class Counted:
            def fit(self, train):
                with lock:
                    now[0] += 1
                    most[0] = max(most[0], now[0])
                    blocks.append((blocks_of, train.count()))
                time.sleep(1)
                try:
                    return als.fit(train)
                finally:
                    with lock:
                        now[0] -= 1

        return Counted()

    monkeypatch.setattr(M, "make_als", spy)
    monkeypatch.setattr(M, "SMALL_BLOCK", 100)
    jobs = [
        lambda: cold_start(rows, genres, integral=True, dim=2, rank=2, max_iter=1).first(),
        lambda: holdout_report(S.assign_parts(rows).cache(), dict(rank=2, max_iter=1), 3).collect(),
    ]
    for job in jobs:
        job()
        assert most == [2]
        most[0] = 0
    monkeypatch.setattr(M, "TOGETHER", 300)
    monkeypatch.setattr(M, "TURN_BLOCK", 60)
    for job in jobs:
        blocks.clear()
        job()
        assert most == [1] and len(blocks) >= 2 and all(b == min(M.block_count(n), -(-n // 60)) > 3 for b, n in blocks), blocks
        most[0] = 0
