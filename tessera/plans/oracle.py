"""DuckDB SQL fragments that rebuild the fixture inputs independently of Spark.

Each fragment is a CTE body; the catalog composes them into complete
queries over the pre-registered test tables.
"""

from __future__ import annotations

from tessera.functions.hashing import hash_unit_sql
from tessera.sources.fixtures import PART_TYPES
from tessera.sources.schemas import GENRE_COLUMNS

INTERACTIONS = """interactions AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_id,
         CAST(l_partkey AS INTEGER) AS item_id,
         CAST(max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS INTEGER) AS is_read,
         CAST(max(floor(l_quantity / 10)) AS INTEGER) AS rating,
         CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS is_reviewed
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY 1, 2)"""

EXPLICIT = "explicit AS (SELECT * FROM interactions WHERE rating <> 0)"


def _genre_exprs() -> list[str]:
    out = [
        f"CAST(CASE WHEN p_type = '{t}' THEN 1 + p_partkey % 3 ELSE 0 END AS INTEGER) AS {c}"
        for t, c in zip(PART_TYPES, GENRE_COLUMNS[:6])
    ]
    out += [
        f"CAST(CASE WHEN p_size % 4 = {cls} THEN 1 + p_size % 7 ELSE 0 END AS INTEGER) AS {c}"
        for cls, c in enumerate(GENRE_COLUMNS[6:])
    ]
    return out


ITEM_GENRES = "item_genres AS (SELECT CAST(p_partkey AS INTEGER) AS item_id, " + ", ".join(_genre_exprs()) + " FROM part)"

# Users fall into three splits by hash position (X2).  A held-out user's rows, by item
# id, stay in training up to the rounded-up middle (rule R6: ceil(n / 2) of n rows).
PARTS = f"""placed AS (
  SELECT *, {hash_unit_sql('split', 'user_id')} AS place FROM interactions),
held AS (
  SELECT user_id, item_id, is_read, rating, is_reviewed, CASE WHEN place < 0.8 THEN 'val' ELSE 'test' END AS us,
         count(*) OVER u AS n, row_number() OVER (u ORDER BY item_id) AS idx
  FROM placed WHERE place >= 0.6 WINDOW u AS (PARTITION BY user_id)),
parts AS (
  SELECT user_id, item_id, is_read, rating, is_reviewed, 'train' AS part FROM placed WHERE place < 0.6
  UNION ALL
  SELECT user_id, item_id, is_read, rating, is_reviewed, us || CASE WHEN idx <= ceil(n / 2) THEN '_train' ELSE '' END AS part
  FROM held)"""

HOLDOUT_ITEM = hash_unit_sql("item", "item_id") + " >= 0.8"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


GENRE_VEC = (
    "genre_vec AS (SELECT item_id, [" + ", ".join(GENRE_COLUMNS) + "] AS v, "
    + HOLDOUT_ITEM + " AS holdout, " + ", ".join(GENRE_COLUMNS) + " FROM item_genres)"
)


def distance_sql(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in GENRE_COLUMNS) + ")"


def radius_pairs(radius: float, name: str = "pairs") -> str:
    """Brute-force holdout x train pairs with distance < radius (oracle only)."""
    return (
        f"{name} AS (SELECT h.item_id AS holdout_id, t.item_id AS train_id, {distance_sql('h', 't')} AS distance "
        "FROM genre_vec h JOIN genre_vec t ON h.holdout AND NOT t.holdout "
        f"WHERE {distance_sql('h', 't')} < {radius})"
    )


FACTOR_ROWS = (
    "factor_rows AS (SELECT CAST(vec_id AS INTEGER) AS id, unnest(range(len(embedding))) AS pos, "
    "CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"
)

SPLIT_ROWS = (
    "fit AS (SELECT user_id, item_id, rating FROM explicit WHERE "
    + hash_unit_sql("row", "user_id", "item_id") + " < 0.8)"
)


def dot_sql(a: str, b: str) -> str:
    return f"list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


PAIR_SCORES = (
    f"scores AS (SELECT i.user_id, i.item_id, i.rating, {dot_sql('a.embedding', 'b.embedding')} AS score "
    "FROM interactions i JOIN embeddings a ON a.vec_id = i.item_id JOIN embeddings b ON b.vec_id = i.user_id)"
)
