"""Property tests: skew-safe operators equal their plain Spark formulations."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import splits as S
from tessera.operators.grouped import group_medians

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.integers(1, 6), st.integers(0, 5000)), min_size=1, max_size=300
).map(lambda rs: sorted(set(rs)))


@SETTINGS
@given(rows=rows_strategy, width=st.sampled_from([1, 3, 64, 1 << 20]))
def test_half_split_gives_the_first_half_to_training(spark, rows, width):
    """Of a user's n rows the (n + 1) // 2 with the smallest item ids train."""
    df = spark.createDataFrame(rows, "user_id int, item_id int")
    got = {(r.user_id, r.item_id): r.half for r in S.half_split(df, bucket_width=width).collect()}
    items: dict = {}
    for u, i in sorted(rows):
        items.setdefault(u, []).append(i)
    want = {(u, i): 1 if k < (len(own) + 1) // 2 else 2 for u, own in items.items() for k, i in enumerate(own)}
    assert got == want


@SETTINGS
@given(
    values=st.lists(
        st.tuples(st.sampled_from(["a", "b", "c"]), st.floats(-1e3, 1e3, allow_nan=False, width=32)),
        min_size=1,
        max_size=200,
    ),
    parts=st.integers(1, 6),
)
def test_group_medians_equal_median(spark, values, parts):
    df = spark.createDataFrame(values, "g string, x double").repartition(parts)
    got = {r.g: r.x for r in group_medians(df, "g", ["x"]).collect()}
    want = {r.g: r.x for r in df.groupBy("g").agg(F.median("x").alias("x")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert abs(got[k] - want[k]) <= 1e-9 * max(1.0, abs(want[k]))
