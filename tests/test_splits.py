from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import splits as S
from tessera.operators.grouped import rank_by_int_key
from tessera.sources.readers import clean_interactions


def _rows(spark, counts):
    data = [(u, i, 1, 3, 0) for u, n in counts.items() for i in range(1, n + 1)]
    return spark.createDataFrame(data, "user_id int, item_id int, is_read int, rating int, is_reviewed int")


def test_activity_threshold_inclusive(spark):
    df = _rows(spark, {1: 9, 2: 10, 3: 11})
    kept = {r.user_id for r in S.active_users(df, 10).collect()}
    assert kept == {2, 3}


def test_half_split_counts(spark):
    df = _rows(spark, {1: 1, 2: 2, 3: 3, 4: 4})
    out = S.half_split(df).groupBy("user_id").agg(
        F.sum(F.when(F.col("half") == 1, 1).otherwise(0)).alias("train"),
        F.sum(F.when(F.col("half") == 2, 1).otherwise(0)).alias("held"),
    )
    got = {r.user_id: (r.train, r.held) for r in out.collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (2, 1), 4: (2, 2)}


def test_half_split_keeps_lowest_items_in_train(spark):
    df = spark.createDataFrame([(1, 30), (1, 10), (1, 20), (1, 40), (1, 50)], "user_id int, item_id int")
    got = {r.item_id: r.half for r in S.half_split(df).collect()}
    assert got == {10: 1, 20: 1, 30: 1, 40: 2, 50: 2}


def test_piecewise_rank_equals_plain_window(spark):
    # a hot user spread over many pieces, plus small users
    data = [(1, i * 3 + 1) for i in range(700)] + [(u, i) for u in range(2, 40) for i in range(1, u)]
    df = spark.createDataFrame(data, "user_id int, item_id int")
    piecewise = rank_by_int_key(df, "user_id", "item_id", bucket_width=16).select("user_id", "item_id", "idx", "n")
    w = Window.partitionBy("user_id").orderBy("item_id")
    plain = df.select(
        "user_id",
        "item_id",
        F.row_number().over(w).cast("long").alias("idx"),
        F.count(F.lit(1)).over(Window.partitionBy("user_id")).cast("long").alias("n"),
    )
    assert piecewise.exceptAll(plain).count() == 0 and plain.exceptAll(piecewise).count() == 0


def test_split_independent_of_partitioning(spark):
    df = _rows(spark, {u: 5 + u % 7 for u in range(1, 300)})
    a = S.assign_parts(df.repartition(2))
    b = S.assign_parts(df.repartition(7))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_user_splits_disjoint_and_complete(spark):
    df = _rows(spark, {u: 3 for u in range(1, 500)})
    users = S.split_users(df)
    assert users.count() == 499
    assert users.groupBy("user_id").count().filter("count > 1").count() == 0
    parts = S.assign_parts(df)
    assert parts.count() == df.count()
    per_user = parts.groupBy("user_id").agg(F.collect_set(F.regexp_replace("part", "_train", "")).alias("s"))
    assert per_user.filter(F.size("s") != 1).count() == 0


def test_sample_is_whole_users(spark):
    df = _rows(spark, {u: 12 for u in range(1, 400)})
    sampled = S.sample_users(df, 0.25)
    sizes = {r["count"] for r in sampled.groupBy("user_id").count().collect()}
    assert sizes == {12}
    assert 0 < sampled.select("user_id").distinct().count() < 399


def test_clean_drops_malformed_and_null(spark):
    df = spark.createDataFrame(
        [("1", "2", "1", "4", "0"), ("x", "2", "1", "4", "0"), ("1", None, "1", "4", "0"), ("3", "4", "1", "bad", "0")],
        "user_id string, item_id string, is_read string, rating string, is_reviewed string",
    )
    out = clean_interactions(df).collect()
    assert [(r.user_id, r.item_id, r.rating) for r in out] == [(1, 2, 4)]
    kinds = dict(clean_interactions(df).dtypes)
    assert (kinds["user_id"], kinds["rating"]) == ("bigint", "int")


def test_union_by_name_does_not_swap(spark):
    a = spark.createDataFrame([(1, 100, 3.0)], "user_id int, item_id int, rating double")
    b = spark.createDataFrame([(200, 2, 4.0)], "item_id int, user_id int, rating double")
    rows = {(r.user_id, r.item_id) for r in a.unionByName(b).collect()}
    assert rows == {(1, 100), (2, 200)}


def test_parts_union_is_input(spark):
    df = _rows(spark, {u: 1 + u % 9 for u in range(1, 200)})
    parts = S.assign_parts(df).drop("part")
    assert parts.exceptAll(df).count() == 0 and df.exceptAll(parts).count() == 0
    tv = S.final_table(S.assign_parts(df), "final_train_val")
    v = S.final_table(S.assign_parts(df), "final_val")
    assert tv.join(v, ["user_id", "item_id"]).count() == 0


def test_split_table_equals_filtered_parts(spark):
    df = _rows(spark, {u: 1 + u % 9 for u in range(1, 200)})
    parts = S.assign_parts(df)
    for name in S.PART_SETS:
        a, b = S.split_table(df, name), S.final_table(parts, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stored_parts_are_found_by_all_their_parameters(spark):
    df = _rows(spark, {u: 2 for u in range(1, 200)})
    a = S.parts_table(spark, df, "same-key").groupBy("part").count().collect()
    b = S.parts_table(spark, df, "same-key", fractions=(0.0, 0.5, 0.5)).groupBy("part").count().collect()
    assert {r.part for r in a} == {"train", "val", "val_train", "test", "test_train"}
    assert {r.part for r in b} == {"val", "val_train", "test", "test_train"}


def test_clean_keeps_large_ids(spark):
    raw = spark.createDataFrame([("3000000000", "9223372036854775807", "4"), ("1", "99999999999999999999", "4")], "user_id string, item_id string, rating string")
    rows = clean_interactions(raw).collect()
    assert [(r.user_id, r.item_id, r.rating) for r in rows] == [(3000000000, 9223372036854775807, 4)]


def test_dense_ids_for_strings_and_large_numbers(spark):
    from tessera.operators.features import dense_ids, reindex

    df = spark.createDataFrame([("u9", 2**40, 1), ("u1", 2**40, 2), ("u1", -5, 3), (None, 7, 4)], "user_id string, item_id long, rating int")
    users = dense_ids(df, "user_id")
    assert {(r.user_id, r.idx) for r in users.collect()} == {("u1", 0), ("u9", 1)} and dict(users.dtypes)["idx"] == "int"
    out = reindex(reindex(df, users, "user_id"), dense_ids(df, "item_id"), "item_id")
    assert {tuple(r) for r in out.collect()} == {(1, 2, 1), (0, 2, 2), (0, 0, 3)} and out.columns == df.columns
