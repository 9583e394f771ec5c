"""Exact top-k inner products by pivot-table elimination.

Pivots are chosen once from a bounded sample, far from each other.  Every vector's
distances to all pivots are stored with it.  For a query q and a candidate x the largest
|d(q, p) - d(x, p)| over the pivots bounds their distance from below, and

    <q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2

turns that into an upper bound of the inner product.  Candidates are evaluated in the order of
their bounds; as soon as the next bound is below the k-th best score so far, the rest is
eliminated.  The k-th best score is carried from block to block.  Scores are integers and exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.vectors import blocks, met, numbered, whole_vectors

K = 20
PIVOTS = 32
#: Vectors that pivots are chosen from.
SAMPLE = 1024
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Candidates evaluated before the first elimination, in bound order.
FIRST = 64
#: Queries whose bounds are computed at a time.
ROWS = 16
#: Products of integers below this are exact in double precision.
EXACT = 2.0**53

_NONE = np.iinfo(np.int64).min
#: Scores below this over the candidates of a block leave room for a place beside them.
TIED = 1 << 62


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first pivots of a sample; the origin is the first one."""
    pivots = [np.zeros(sample.shape[1])]
    away = ((sample - pivots[0]) ** 2).sum(1)
    for _ in range(min(count - 1, len(sample))):
        far = int(away.argmax())
        if away[far] <= 0:
            break
        pivots.append(sample[far])
        away = np.minimum(away, ((sample - sample[far]) ** 2).sum(1))
    return np.stack(pivots)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def upper_bounds(qd: np.ndarray, xd: np.ndarray, qq: np.ndarray, xx: np.ndarray) -> np.ndarray:
    """Upper bounds of all inner products, widened by more than rounding can take away.

    Distance differences are taken in single precision, a few queries at a time, so that they stay in the
    processor's cache; what single precision may be off is taken from the lower bound."""
    off = 1e-6 * max(qd.max(initial=0), xd.max(initial=0))
    q, x = qd.astype("f4"), np.ascontiguousarray(xd.T.astype("f4"))
    least = np.zeros((len(qd), len(xd)), "f4")
    gap = np.empty((ROWS, len(xd)), "f4")
    for at in range(0, len(q), ROWS):
        rows = least[at : at + ROWS]
        part = gap[: len(rows)]
        for p in range(len(x)):
            np.subtract(q[at : at + ROWS, p, None], x[p], out=part)
            np.abs(part, out=part)
            np.maximum(rows, part, out=rows)
    bound = least.astype(float)
    bound -= off
    np.maximum(bound, 0, out=bound)
    np.square(bound, out=bound)
    both = qq[:, None] + xx[None]
    np.subtract(both, bound, out=bound)
    bound *= 0.5
    both *= 1e-9
    bound += both
    bound += 1e-6
    return bound


def search_block(q, qid, x, xid, qd, xd, best, best_id, k: int, count=None) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each query after this block, whose ids ascend.  ``best``/``best_id``: those before it."""
    qq, xx = (q.astype(float) ** 2).sum(1), (x.astype(float) ** 2).sum(1)
    bound = upper_bounds(qd, xd, qq, xx)
    bound[qid[:, None] == xid[None]] = -np.inf  # a query is no candidate of its own
    small = max(1.0, float(np.abs(q).max(initial=0))) * max(1.0, float(np.abs(x).max(initial=0))) * q.shape[1] < EXACT
    fq, fx = (q.astype(float), x.astype(float)) if small else (q, x)
    head = min(FIRST, len(x))
    at = np.argpartition(-bound, head - 1, axis=1)[:, :head] if head < len(x) else np.broadcast_to(np.arange(len(x)), bound.shape)
    top = np.einsum("qd,qcd->qc", fq, fx[at]).astype(np.int64)
    seen = np.take_along_axis(bound, at, 1)
    ids = xid[at].copy()
    top[seen == -np.inf] = _NONE
    best, best_id = merge_best_int(np.concatenate((best, top), 1), np.concatenate((best_id, ids), 1), k)
    np.put_along_axis(bound, at, -np.inf, 1)
    # Bounds in falling order, in growing steps, until the next one is below the k-th best score.
    step = 4 * FIRST
    while True:
        alive = (bound >= best[:, -1:]) & (bound > -np.inf)
        left = alive.sum(1)
        if count is not None:
            count.append(int(left.sum()))
        rows = np.flatnonzero(left)
        if not len(rows):
            return best, best_id
        take = min(step, int(left.max()))
        if left[rows].sum() * 4 > len(rows) * len(x):  # most stay alive: their products in one go
            take = len(x)
            cols = np.flatnonzero(alive[rows].any(0))
            top = (fq[rows] @ fx[cols].T).astype(np.int64)
            ok = alive[np.ix_(rows, cols)]
            top[~ok] = _NONE
            keep = min(k, len(cols))
            if np.abs(top[ok]).max(initial=0) < TIED // len(cols):
                # One key for score and place: ids ascend in a block, so equal scores go by id.
                key = top * len(cols) - np.arange(len(cols))
                key[~ok] = -TIED
                near = np.argpartition(-key, keep - 1, axis=1)[:, :keep]
            else:
                near = np.argsort(np.where(ok, -top, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :keep]
            found = np.concatenate((best[rows], np.take_along_axis(top, near, 1)), 1)
            best[rows], best_id[rows] = merge_best_int(found, np.concatenate((best_id[rows], xid[cols][near]), 1), k)
            bound[rows] = -np.inf
        else:
            part = np.where(alive[rows], bound[rows], -np.inf)
            at = np.argpartition(-part, take - 1, axis=1)[:, :take] if take < len(x) else np.broadcast_to(np.arange(len(x)), part.shape)
            for a in range(0, len(rows), 64):
                r, c = rows[a : a + 64], at[a : a + 64]
                top = np.einsum("qd,qcd->qc", fq[r], fx[c]).astype(np.int64)
                top[np.take_along_axis(part[a : a + 64], c, 1) == -np.inf] = _NONE
                best[r], best_id[r] = merge_best_int(np.concatenate((best[r], top), 1), np.concatenate((best_id[r], xid[c]), 1), k)
                seen = bound[r]
                np.put_along_axis(seen, c, -np.inf, 1)
                bound[r] = seen
            bound[rows] = np.where(alive[rows], bound[rows], -np.inf)
            step *= 4


def merge_best_int(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise the k best by score, then smaller id; the smallest integer marks none."""
    order = np.lexsort((ids, np.where(scores == _NONE, np.iinfo(np.int64).max, -np.maximum(scores, _NONE + 1))), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def exact_top_k(rows: DataFrame, k: int = K, every: int = 20, scale: float = 64.0, pivots: int = PIVOTS) -> DataFrame:
    """embeddings -> query_id, rank, vec_id, score: the exact k largest integer inner products.

    Components become floor(scale * x), x as double.  Queries are the rows whose vec_id is
    divisible by ``every``; candidates are all rows with another vec_id, of the same dimension.
    Vectors that are null or hold null or non-finite components take no part, nor do rows
    without vec_id.  Rows repeating a vec_id are candidates of their own and, as queries, are
    answered once each.  Ties go to the smaller vec_id.  No rows in, no rows out.
    """
    whole = numbered(whole_vectors(rows).select("vec_id", F.transform("x", lambda v: F.floor(v * F.lit(scale)).cast("long")).alias("x")), "topk-vectors")
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    chosen: dict[int, np.ndarray] = {}
    for d in {len(r["x"]) for r in sample}:
        chosen[d] = choose_pivots(np.array([r["x"] for r in sample if len(r["x"]) == d], float), pivots)
    table = "dim int, block int, ids binary, vectors binary, pivots binary"

    def with_pivots(batches):
        for batch in batches:
            out = []
            for dim, ids, raw in zip(batch["dim"], batch["ids"], batch["vectors"]):
                x = np.frombuffer(raw, np.int64).reshape(len(ids) // 8, dim).astype(float)
                out.append(pivot_distances(x, chosen.get(dim, np.zeros((1, dim)))).tobytes())
            yield batch.assign(pivots=out)[["dim", "block", "ids", "vectors", "pivots"]]

    def indexed(part: DataFrame, size: int, name: str) -> DataFrame:
        return written(blocks(part, size, "<i8").mapInPandas(with_pivots, table), name)

    candidates = indexed(whole, BLOCK_ROWS, "topk-blocks")
    queries = indexed(whole.filter(F.col("vec_id") % every == 0), QUERY_ROWS, "topk-queries")
    q, c = met(queries, candidates, QUERY_ROWS, BLOCK_ROWS)

    def matrix(raw: bytes, n: int, kind) -> np.ndarray:
        return np.frombuffer(raw, kind).reshape(n, len(raw) // (8 * n))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, a in left.iterrows():
            qid = np.frombuffer(a["ids"], np.int64)
            qx, qd = matrix(a["vectors"], len(qid), np.int64), matrix(a["pivots"], len(qid), float)
            best, best_id = np.full((len(qid), k), _NONE), np.zeros((len(qid), k), np.int64)
            for _, b in right.sort_values("block").iterrows():
                xid = np.frombuffer(b["ids"], np.int64)
                xx, xd = matrix(b["vectors"], len(xid), np.int64), matrix(b["pivots"], len(xid), float)
                best, best_id = search_block(qx, qid, xx, xid, qd, xd, best, best_id, k)
            got = best != _NONE
            row = np.repeat(np.arange(len(qid)), got.sum(1))
            out.append(pd.DataFrame({"q": row, "query_id": qid[row], "vec_id": best_id[got], "score": best[got], "qblock": a["qblock"], "dim": a["dim"]}))
        return pd.concat(out) if out else pd.DataFrame({}, columns=["q", "query_id", "vec_id", "score", "qblock", "dim"])

    found = q.groupBy("dim", "batch", "part").cogroup(c.groupBy("dim", "batch", "part")).applyInPandas(search, "q long, query_id long, vec_id long, score long, qblock int, dim int")
    best = Window.partitionBy("dim", "qblock", "q").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
