"""Approximate nearest neighbours: one hierarchical small-world graph per shard.

Vectors are dealt to shards of a few thousand by hash.  Inside a shard equal vectors
become one node with a list of ids, nodes draw a level from a geometric distribution, and every level
holds a graph in a flat array of neighbours (``-1`` pads).  A node's neighbours are
chosen from its nearest nodes on that level, a node only if it is nearer to the
centre than to any neighbour chosen before (so links point in all directions), then
filled up with links back.  Inner products become distances by one added component
(sqrt(M^2 - |x|^2), M the largest norm of the shard).

A search runs a block of queries through one shard at a time: greedily down the levels, then a
beam on the lowest.  The best of each shard are scored in double precision and merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.vectors import blocks, met, numbered, whole_vectors

K = 20
SHARD_ROWS = 8192
QUERY_ROWS = 512
#: Neighbours of a node: chosen, and at most with links back.
LINKS, WIDTH = 16, 32
#: Nearest nodes that neighbours are chosen from.
POOL = 48
#: Beam on the lowest level, beam on the levels above, entries expanded at a time.
BEAM, UPPER_BEAM, EXPAND = 160, 8, 4


def _nearest(a: np.ndarray, pool: int) -> np.ndarray:
    """For every row its ``pool`` nearest other rows, nearest first; blockwise."""
    n = len(a)
    pool = min(pool, n - 1)
    square = (a * a).sum(1)
    out = np.empty((n, pool), np.int64)
    for at in range(0, n, 512):
        d = square[None] - 2 * a[at : at + 512] @ a.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        near = np.argpartition(d, pool - 1, axis=1)[:, :pool]
        order = np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable")
        out[at : at + 512] = np.take_along_axis(near, order, 1)
    return out


def _choose(a: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Diverse neighbours from the nearest, then the nearest of the others; -1 pads."""
    n, pool = near.shape
    out = np.full((n, links), -1, np.int64)
    for at in range(0, n, 256):
        cand = near[at : at + 256]
        x = a[cand]
        to_centre = ((x - a[at : at + 256, None]) ** 2).sum(2)
        square = (x * x).sum(2)
        among = square[:, :, None] + square[:, None] - 2 * x @ x.transpose(0, 2, 1)
        chosen = np.zeros(cand.shape, bool)
        for j in range(pool):
            hidden = (chosen & (among[:, j] < to_centre[:, j, None])).any(1)
            chosen[:, j] = ~hidden & (chosen.sum(1) < links)
        rank = np.argsort(~chosen, axis=1, kind="stable")[:, :links]
        out[at : at + 256, : rank.shape[1]] = np.take_along_axis(cand, rank, 1)
    return out


def _graph(a: np.ndarray, links: int, width: int) -> np.ndarray:
    """Neighbour array of one level: chosen links, then links back while there is room, nearest first."""
    n = len(a)
    if n < 2:
        return np.full((n, width), -1, np.int32)
    there = _choose(a, _nearest(a, POOL), links)
    out = np.full((n, width), -1, np.int32)
    out[:, : there.shape[1]] = there
    src, slot = np.nonzero(there >= 0)
    dst = there[src, slot]
    mutual = np.zeros(len(src), bool)
    pairs = dst * np.int64(n) + src
    mutual = np.isin(pairs, src * np.int64(n) + dst)
    src, dst = src[~mutual], dst[~mutual]  # each (dst -> src) is new
    away = ((a[src] - a[dst]) ** 2).sum(1)
    order = np.lexsort((away, dst))
    src, dst = src[order], dst[order]
    have = (there >= 0).sum(1)
    place = np.arange(len(dst)) - np.searchsorted(dst, dst) + have[dst]
    room = place < width
    out[dst[room], place[room]] = src[room]
    return out


class ShardGraph:
    """Levels as (nodes, neighbours): ``nodes`` are positions in ``vectors``, neighbours positions in ``nodes``."""

    def __init__(self, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.vectors, self.levels = vectors, levels

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int, links: int = LINKS, width: int = WIDTH) -> ShardGraph:
        x = vectors.astype(np.float64)
        square = (x * x).sum(1)
        a = np.concatenate((x, np.sqrt(np.maximum(square.max(initial=0) - square, 0))[:, None]), 1)
        a = (a / max(1e-300, np.sqrt(square.max(initial=0)))).astype(np.float32)
        level = (-np.log(1 - np.random.default_rng(seed).random(len(x))) / np.log(links)).astype(int)
        levels, height = [], 0
        while True:
            nodes = np.flatnonzero(level >= height)
            if height and len(nodes) < 2 * links:
                break
            levels.append((nodes.astype(np.int32), _graph(a[nodes], links, width if height == 0 else links)))
            height += 1
        return cls(vectors, levels)

    def search(self, q: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Node positions of up to ``beam`` near nodes for every query; -1 pads."""
        x, q = self.vectors.astype(np.float32), q.astype(np.float32)
        top = self.levels[-1][0]
        if len(self.levels) == 1 or len(top) <= 4 * UPPER_BEAM:
            start = np.broadcast_to(np.arange(min(len(top), 4 * UPPER_BEAM)), (len(q), min(len(top), 4 * UPPER_BEAM)))
        else:
            spread = np.linspace(0, len(top) - 1, 4 * UPPER_BEAM).astype(int)
            start = np.broadcast_to(spread, (len(q), len(spread)))
        for height in range(len(self.levels) - 1, -1, -1):
            nodes, near = self.levels[height]
            found = _beam(x[nodes], near, q, start, beam if height == 0 else UPPER_BEAM)
            if height:
                held = np.where(found >= 0, nodes[found], -1)
                below = self.levels[height - 1][0]
                start = np.where(held >= 0, np.searchsorted(below, held), -1)
            else:
                return np.where(found >= 0, nodes[found], -1)


def _beam(x: np.ndarray, near: np.ndarray, q: np.ndarray, start: np.ndarray, beam: int) -> np.ndarray:
    """Best-first search of all queries in step; (queries, beam) positions, -1 pads."""
    m, n = len(q), len(x)
    beam = min(beam, n)
    seen = np.zeros((m, n + 1), bool)  # the last column takes the pads
    rows = np.arange(m)[:, None]

    def fresh(of: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions not seen before (others -1) and their scores."""
        at = np.sort(np.where(at < 0, n, at), axis=1)
        old = seen[of[:, None], at]
        old[:, 1:] |= at[:, 1:] == at[:, :-1]
        old |= at == n
        seen[of[:, None], at] = True
        score = np.einsum("qd,qcd->qc", q[of], x[np.minimum(at, n - 1)])
        return np.where(old, -1, at), np.where(old, -np.inf, score)

    pos, score = fresh(np.arange(m), start)
    done = np.zeros(pos.shape, bool)
    if pos.shape[1] < beam:
        pad = beam - pos.shape[1]
        pos, score, done = np.pad(pos, ((0, 0), (0, pad)), constant_values=-1), np.pad(score, ((0, 0), (0, pad)), constant_values=-np.inf), np.pad(done, ((0, 0), (0, pad)))
    keep = np.argsort(-score, axis=1, kind="stable")[:, :beam]
    pos, score, done = pos[rows, keep], score[rows, keep], done[rows, keep]
    live = np.arange(m)
    while len(live):
        open_ = np.where(done[live] | (pos[live] < 0), -np.inf, score[live])
        step = min(EXPAND, beam)
        at = np.argpartition(-open_, step - 1, axis=1)[:, :step]
        good = np.take_along_axis(open_, at, 1) > -np.inf
        some = good.any(1)
        live, at, good = live[some], at[some], good[some]
        if not len(live):
            break
        chosen = np.where(good, pos[live[:, None], at], 0)
        mark = done[live]
        np.put_along_axis(mark, at, True, 1)
        done[live] = mark
        around = np.where(good[:, :, None], near[chosen], -1).reshape(len(live), -1)
        new, new_score = fresh(live, around)
        pos2, score2 = np.concatenate((pos[live], new), 1), np.concatenate((score[live], new_score), 1)
        done2 = np.concatenate((done[live], np.zeros(new.shape, bool)), 1)
        keep = np.argpartition(-score2, beam - 1, axis=1)[:, :beam]
        pos[live], score[live], done[live] = np.take_along_axis(pos2, keep, 1), np.take_along_axis(score2, keep, 1), np.take_along_axis(done2, keep, 1)
    return pos


INDEX = "dim int, block int, ids binary, firsts binary, vectors binary, sizes binary, nodes binary, near binary"


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, row_no, x) -> one row a shard with its graph as flat arrays; every row is indexed."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, b in batch.iterrows():
                ids = np.frombuffer(b["ids"], np.int64)
                x = np.frombuffer(b["vectors"], np.float64).reshape(len(ids), -1)
                distinct, member = np.unique(x, axis=0, return_inverse=True)
                member = member.reshape(-1)
                order = np.lexsort((ids, member))
                firsts = np.searchsorted(member[order], np.arange(len(distinct) + 1))
                g = ShardGraph.build(distinct, seed=int(b["block"]))
                yield pd.DataFrame(
                    {
                        "dim": [b["dim"]],
                        "block": [b["block"]],
                        "ids": [ids[order].tobytes()],
                        "firsts": [firsts.astype(np.int64).tobytes()],
                        "vectors": [distinct.tobytes()],
                        "sizes": [np.array([(len(n), w.shape[1]) for n, w in g.levels], np.int64).tobytes()],
                        "nodes": [b"".join(n.tobytes() for n, _ in g.levels)],
                        "near": [b"".join(w.tobytes() for _, w in g.levels)],
                    }
                )

    return written(blocks(rows, shard_rows, "<f8").mapInPandas(build, INDEX), "ann-index", "zstd")


def load_graph(row) -> tuple[ShardGraph, np.ndarray, np.ndarray]:
    """A stored shard -> graph, ids, and where each node's ids begin."""
    firsts = np.frombuffer(row["firsts"], np.int64)
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(len(firsts) - 1, -1)
    nodes, near, levels = np.frombuffer(row["nodes"], np.int32), np.frombuffer(row["near"], np.int32), []
    a = b = 0
    for size, width in np.frombuffer(row["sizes"], np.int64).reshape(-1, 2).tolist():
        levels.append((nodes[a : a + size], near[b : b + size * width].reshape(size, width)))
        a, b = a + size, b + size * width
    return ShardGraph(vectors, levels), np.frombuffer(row["ids"], np.int64), firsts


def search_shard(row, qid: np.ndarray, q: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, vec_id, score) of up to k rows a query from one shard."""
    graph, ids, firsts = load_graph(row)
    found = graph.search(q, max(beam, k + 1))
    score = np.einsum("qd,qcd->qc", q, graph.vectors[np.maximum(found, 0)])
    score[found < 0] = -np.inf
    near = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
    found, score = np.take_along_axis(found, near, 1), np.take_along_axis(score, near, 1)
    # A node stands for all its ids; no more than k + 1 of them can matter (its own included).
    size = np.where(found >= 0, np.minimum(firsts[np.maximum(found, 0) + 1] - firsts[np.maximum(found, 0)], k + 1), 0)
    flat = size.reshape(-1)
    first = np.repeat(firsts[np.maximum(found, 0)].reshape(-1), flat)
    vec = ids[first + np.arange(len(first)) - np.repeat(np.cumsum(flat) - flat, flat)]
    who = np.repeat(np.repeat(np.arange(len(q)), found.shape[1]), flat)
    what = np.repeat(score.reshape(-1), flat)
    other = vec != qid[who]
    who, vec, what = who[other], vec[other], what[other]
    order = np.lexsort((vec, -what, who))
    who, vec, what = who[order], vec[order], what[order]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    top = place < k
    return who[top], vec[top], what[top]


def nearest(rows: DataFrame, k: int = K, every: int = 20, beam: int = BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """embeddings -> query_id, rank, vec_id, score (inner product in double precision).

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows with another
    vec_id and the same dimension.  Vectors that are null, zero (or empty), or hold null or
    non-finite components take no part.  Ties go to the smaller vec_id.  Rows repeating a
    vec_id are candidates of their own and, as queries, are answered once each.
    """
    whole = whole_vectors(rows).filter(F.exists("x", lambda v: v != 0))
    whole = numbered(whole, "ann-vectors")
    index = build_index(whole, shard_rows)
    queries = written(blocks(whole.filter(F.col("vec_id") % every == 0), QUERY_ROWS, "<f8"), "ann-queries")
    q, c = met(queries, index, QUERY_ROWS, shard_rows)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, a in left.iterrows():
            qid = np.frombuffer(a["ids"], np.int64)
            x = np.frombuffer(a["vectors"], np.float64).reshape(len(qid), -1)
            for _, b in right.iterrows():
                who, vec, score = search_shard(b, qid, x, k, beam)
                out.append(pd.DataFrame({"dim": a["dim"], "qblock": a["qblock"], "q": who, "query_id": qid[who], "vec_id": vec, "score": score}))
        if not out:
            return pd.DataFrame({}, columns=["dim", "qblock", "q", "query_id", "vec_id", "score"])
        every = pd.concat(out).sort_values(["qblock", "q", "score", "vec_id"], ascending=[True, True, False, True], kind="stable")
        return every[every.groupby(["qblock", "q"]).cumcount() < k]

    keys = ["dim", "batch", "part"]
    found = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(search, "dim int, qblock int, q long, query_id long, vec_id long, score double")
    best = Window.partitionBy("dim", "qblock", "q").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
