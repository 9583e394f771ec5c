"""Vectors in blocks: the shared layout of the two nearest-neighbour operators.

A block is one row with up to a few thousand vectors of one dimension as flat
arrays.  Blocks are cut by a hash of the row's number, so equal rows, however many, are
spread over blocks.  Queries are a stated set: they are cut into blocks too and every query block
meets every candidate block exactly once.  They meet in groups of many query blocks and a few candidate
blocks, both bounded by bytes, so a candidate block is copied once for tens of thousands of queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written

#: Bytes of query vectors and of candidate vectors in one group.
QUERY_BYTES, CANDIDATE_BYTES = 16 << 20, 32 << 20
#: Groups wanted along the candidates before several candidate blocks share one.
PARTS = 64
#: Partitions beyond which there are no more than groups.
SPREAD = 2048
#: Dimensions up to which a table of one row a dimension is broadcast; with more the planner chooses.
DIMENSIONS = 10_000

BLOCK = "dim int, block int, ids binary, vectors binary"


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id long, x array<double>) of the vectors that take part: not null, no null and no
    non-finite component.  Rows with a null id take no part either: they can be neither
    named in a result nor told apart."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), fine.alias("fine")).filter("vec_id IS NOT NULL AND x IS NOT NULL AND fine").select("vec_id", "x")


def numbered(vectors: DataFrame, name: str) -> DataFrame:
    """The vectors, written to the shared folder with a fixed number a row (``row_no``)."""
    return written(vectors.withColumn("row_no", F.monotonically_increasing_id()), name)


def spread(rows: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Deal groups of ``keys`` over tasks by their number; adaptive coalescing would go by bytes and put dear groups together."""
    return rows.repartition(max(1, min(4 * groups, max(SPREAD, groups))), *keys)


def by_dimension(rows: DataFrame, table: DataFrame, dimensions: int) -> DataFrame:
    """Join with a table of one row a dimension, without shuffling the vectors of the one common dimension to one task."""
    return rows.join(F.broadcast(table) if dimensions <= DIMENSIONS else table, "dim")


def blocks(rows: DataFrame, size: int, kind: str) -> DataFrame:
    """(vec_id, row_no, x) -> BLOCK rows of about ``size`` vectors each, ids ascending."""
    count = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))  # one row a dimension
    parts = count.select("dim", F.ceil(F.col("n") / size).cast("long").alias("parts"))
    groups, dims = parts.agg(F.coalesce(F.sum("parts"), F.lit(0)), F.count(F.lit(1))).first()

    def flat(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id", kind="stable")
        data = np.array([np.asarray(v, kind) for v in group["x"]]).reshape(len(group), -1)
        return pd.DataFrame({"dim": [int(group["dim"].iloc[0])], "block": [int(group["block"].iloc[0])], "ids": [group["vec_id"].to_numpy(np.int64).tobytes()], "vectors": [data.tobytes()]})

    dealt = by_dimension(rows.withColumn("dim", F.size("x")), parts, dims).withColumn("block", F.pmod(F.xxhash64("vec_id", "row_no"), F.col("parts")).cast("int"))
    return spread(dealt.select("dim", "block", "vec_id", "x"), groups, "dim", "block").groupBy("dim", "block").applyInPandas(flat, BLOCK)


def met(queries: DataFrame, candidates: DataFrame, query_rows: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides keyed by (dim, batch, part): QUERY_BYTES of query blocks and up to CANDIDATE_BYTES of candidate blocks a group.

    ``query_rows`` and ``block_rows`` are the rows of one block.  The query block's number is ``qblock``.
    """

    def fit(limit: int, rows: int):
        return F.greatest(F.lit(1), F.floor(F.lit(limit) / (F.greatest("dim", F.lit(1)) * 8 * rows)))

    n_q = queries.groupBy("dim").agg((F.max("block") + 1).alias("n_q"))
    n_c = candidates.groupBy("dim").agg((F.max("block") + 1).alias("n_c"))
    layout = n_q.join(n_c, "dim").withColumn("q_each", fit(QUERY_BYTES, query_rows))
    layout = layout.withColumn("c_each", F.least(fit(CANDIDATE_BYTES, block_rows), F.greatest(F.lit(1), F.floor(F.col("n_c") / PARTS))))
    layout = layout.select("dim", "q_each", "c_each", F.ceil(F.col("n_q") / F.col("q_each")).alias("batches"), F.ceil(F.col("n_c") / F.col("c_each")).alias("parts"))
    groups, dims = layout.agg(F.coalesce(F.sum(F.col("batches") * F.col("parts")), F.lit(0)), F.count(F.lit(1))).first()
    rest = ("q_each", "c_each", "batches", "parts")
    q = by_dimension(queries, layout, dims).withColumnRenamed("block", "qblock").withColumn("batch", F.floor(F.col("qblock") / F.col("q_each")))
    q = q.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop(*rest)
    c = by_dimension(candidates, layout, dims).withColumn("part", F.floor(F.col("block") / F.col("c_each")))
    c = c.withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("batches") - 1))).drop(*rest)
    keys = ("dim", "batch", "part")
    return spread(q, groups, *keys), spread(c, groups, *keys)
