"""Driver contract: entry() runs; every SQL-backed query matches DuckDB at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import catalog
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 5)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 2
    assert {"precision_at_k", "ndcg_at_k", "mean_average_precision"} <= set(df.columns)


def test_every_query_has_a_callable():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 65


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, srows) == _rows(dcols, drows)


def _finite(rows, *cols):
    return all(math.isfinite(r[c]) for r in rows for c in cols)


#: What every rows-only query must return at sf0.001, where SQL cannot say it.
ROWS_ONLY = {
    "als_predict": lambda r: 0 < len(r) <= 700 and _finite(r, "prediction"),
    "als_item_factors": lambda r: len({x.id for x in r}) == len(r) and all(len(x.features) == 10 for x in r),
    "als_topk_users": lambda r: {x.pos for x in r} == set(range(1, max(x.pos for x in r) + 1)) and _finite(r, "score"),
    "als_topk_items": lambda r: {x.pos for x in r} == set(range(1, max(x.pos for x in r) + 1)) and _finite(r, "score"),
    "als_tune_report": lambda r: len(r) == 27 and sum(x.is_best for x in r) == 1 and min(r, key=lambda x: x.rmse).is_best,
    "als_tune_best": lambda r: len(r) == 1 and abs(r[0].rmse - r[0].refit_rmse) < 1e-3,
    "ranking_report": lambda r: {x.split for x in r} == {"val", "test"} and all(0 < x.ndcg_at_k < 1 and x.k == 500 for x in r),
    "coldstart_rmse": lambda r: len(r) == 1 and _finite(r, "rmse_coldstart", "rmse_full") and r[0].n_pseudo > 0,
    "coldstart_rmse_lsh": lambda r: len(r) == 1 and _finite(r, "rmse_coldstart", "rmse_full"),
    "model_roundtrip": lambda r: 0 < len(r) <= 700 and _finite(r, "prediction"),
    "factor_pca2d": lambda r: len(r) == 200 and _finite(r, "x", "y") and abs(sum(x.x for x in r)) < 1e3,
    "label_median_2d": lambda r: len(r) == 10 and _finite(r, "x", "y"),
    "radius_neighbors_lsh": lambda r: r and all(0 <= x.distance < 1.5 for x in r),
}


def test_every_rows_only_query_has_an_assertion():
    assert set(ROWS_ONLY) == set(catalog.queries()) - set(catalog.oracle_sql())


@pytest.mark.parametrize("key", sorted(ROWS_ONLY))
def test_rows_only_query(spark, key):
    assert ROWS_ONLY[key](E.queries()[key](spark, SF001).collect())
