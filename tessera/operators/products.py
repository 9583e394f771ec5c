"""Dot products of two factor tables ``(id, features)``, block by block.

Factors are packed into blocks of bounded size (ids and one matrix a row), so a factor
travels once a block and never with a (user, item) row.

Given pairs
    Every pair belongs to the cell of its user's and its item's block.  A cell gets both
    matrices and its pairs in one cogroup.  Cells with many pairs are cut into parts, so a user or an
    item that holds a third of the pairs is scored by many tasks.

Top-k
    Target blocks stand in order of their largest norm.  A block of sources first meets the
    block of the largest norms; the k-th score that each source has then is a floor.  By the
    Cauchy-Schwarz inequality a target block whose largest norm times the source's norm lies below the floor cannot change
    the source's list, so only blocks that can still matter are sent, and that is known before anything is shuffled.
    Blocks of sources are large (``SOURCE_BLOCK``), so the targets travel once for very many sources.  One task takes a
    block of sources and its target blocks one after the other; only the k best of each source stay, and they leave in frames.

One factor an id; factors of one length; null ids and null factors take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Bytes of a packed block of factors when pairs are scored; pairs of one part of a cell.
BLOCK_BYTES, CELL_PAIRS = 1 << 25, 1 << 20
#: Sources of a block (fewer if there would be too few blocks for the cluster) and targets of one.
SOURCE_BLOCK, LEAST_SOURCES, TARGET_BLOCK = 1 << 16, 1 << 10, 1 << 17
#: Scores that a task holds at a time; rows of lists that it gives out at a time; pairs that it scores at a time.
SCORES, LIST_ROWS, PAIR_ROWS = 1 << 23, 1 << 17, 1 << 14
#: Single-precision products may lie above the bound by rounding.
SLACK = 1 + 1e-4


def _known(factors: DataFrame) -> DataFrame:
    return factors.select(F.col("id").cast("long").alias("id"), "features").filter("id IS NOT NULL AND features IS NOT NULL")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what later steps count on is fixed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def block_of(id_col, blocks: int):
    """The block of an id."""
    return F.pmod(F.xxhash64(id_col.cast("long")), F.lit(blocks)).cast("int")


def packed(factors: DataFrame, blocks: int, kind: str) -> DataFrame:
    """(id, features) -> (block, ids, matrix), ids ascending, numbers of type ``kind``."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        matrix = np.stack([np.asarray(f, kind) for f in group["features"]])
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "ids": [group["id"].to_numpy("i8").tobytes()], "matrix": [matrix.tobytes()]})

    return factors.withColumn("block", block_of(F.col("id"), blocks)).groupBy("block").applyInPandas(pack, "block int, ids binary, matrix binary")


def _blocks(factors: DataFrame, block_bytes: int) -> int:
    size = factors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("rank")).first()
    return max(1, math.ceil(size["n"] * 8 * (1 + (size["rank"] or 0)) / block_bytes))


def score_pairs(
    pairs: DataFrame,
    item_factors: DataFrame,
    user_factors: DataFrame,
    user: str = "user_id",
    item: str = "item_id",
    out: str = "score",
    block_bytes: int = BLOCK_BYTES,
    cell_pairs: int = CELL_PAIRS,
) -> DataFrame:
    """dot(item factor, user factor) for the given (user, item) rows only (R-1, J10, F1).

    Rows keep all their columns; those whose user or item is null or has no factor are dropped,
    repeated rows are scored as often as they stand.
    """
    items, users = _known(item_factors), _known(user_factors)
    n_items, n_users = _blocks(items, block_bytes), _blocks(users, block_bytes)
    rows = pairs.filter(F.col(user).isNotNull() & F.col(item).isNotNull())
    place = F.struct(block_of(F.col(user), n_users).alias("u"), block_of(F.col(item), n_items).alias("i"))
    rows = rows.withColumns({"_cell": place, "_u": F.col(user).cast("long"), "_i": F.col(item).cast("long")})
    if n_items == n_users == 1:
        total = rows.count()
        cells = pairs.sparkSession.createDataFrame([((0, 0), max(1, -(-total // cell_pairs)))], "_cell struct<u: int, i: int>, _parts long")
        rows = rows.withColumn("_parts", F.lit(max(1, -(-total // cell_pairs))))
    else:
        cells = _stored(rows.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / cell_pairs).cast("long").alias("_parts")), "pair-cells")
        rows = rows.join(cells, "_cell")
    # Every column takes part in the hash: only rows equal in all of them must share a part.
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in pairs.columns]), F.col("_parts"))).drop("_parts")
    parts = cells.select("_cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"))
    sides = [parts.join(packed(f, n, "f8").withColumnRenamed("block", "_b"), F.col(f"_cell.{c}") == F.col("_b")).select("_cell", "_part", F.lit(c).alias("_side"), "ids", "matrix") for f, n, c in ((users, n_users, "u"), (items, n_items, "i"))]
    schema = rows.drop("_cell", "_part", "_u", "_i").withColumn(out, F.lit(0.0)).schema

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = {s: (np.frombuffer(k, "i8"), np.frombuffer(m, "f8")) for s, k, m in zip(*(right.column(c).to_pylist() for c in ("_side", "ids", "matrix")))}
        keep, found = np.full(left.num_rows, len(blocks) == 2), []
        for side in blocks:
            ids, matrix = blocks[side]
            wanted = left.column(f"_{side}").to_numpy()
            at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
            keep &= ids[at] == wanted
            found.append((matrix.reshape(len(ids), -1), at))
        rest = left.drop_columns(["_cell", "_part", "_u", "_i"]).filter(pa.array(keep))
        value = np.zeros(int(keep.sum()))
        found = [(m, at[keep]) for m, at in found]
        for a in range(0, len(value), PAIR_ROWS):  # the factors of all pairs at once would be many times the blocks
            value[a : a + PAIR_ROWS] = np.einsum("ij,ij->i", *[m[at[a : a + PAIR_ROWS]] for m, at in found])
        return rest.drop_columns([out] if out in rest.column_names else []).append_column(out, pa.array(value))

    keys = ["_cell", "_part"]
    return rows.groupBy(*keys).cogroup(sides[0].unionByName(sides[1]).groupBy(*keys)).applyInArrow(score, schema)


def best_of(sx: np.ndarray, tx: np.ndarray, keep: int, floor: np.ndarray | None = None):
    """Products of rows, in slices -> (source row, target row, score) arrays: the ``keep`` best of each
    source that reach its floor, best first, ties to the smaller target row."""
    slice_ = max(1, SCORES // max(1, len(tx)))
    for at in range(0, len(sx), slice_):
        scores = sx[at : at + slice_] @ tx.T
        low = np.full(len(scores), -np.inf, scores.dtype) if floor is None else floor[at : at + slice_].astype(scores.dtype)
        # A k-th score is only looked for where the floor lets too many pass.
        crowded = np.isneginf(low)
        for _ in range(2):
            if crowded.any():
                low[crowded] = np.maximum(low[crowded], np.partition(scores[crowded], len(tx) - keep, axis=1)[:, len(tx) - keep])
            flat = np.flatnonzero(scores >= low[:, None])
            row, col = np.divmod(flat, len(tx))
            found = np.bincount(row, minlength=len(scores))
            crowded = ~crowded & (found > 4 * keep)
            if not crowded.any():
                break
        value = scores.reshape(-1)[flat]
        order = np.lexsort((col, -value, row))
        row, col, value = row[order], col[order], value[order]
        first = np.searchsorted(row, np.arange(len(scores)))
        top = np.arange(len(row)) - first[row] < keep
        yield row[top] + at, col[top], value[top]


class Lists:
    """The best ``k`` (target id, score) of every source of a block so far, in arrays of one size."""

    def __init__(self, sources: int, k: int, kind: str) -> None:
        self.none = np.iinfo(kind).max
        self.ids, self.scores = np.full((sources, k), self.none, kind), np.full((sources, k), -np.inf, "f4")

    def put(self, row: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """More candidates, at most k a row; rows ascending."""
        if not len(row):
            return
        rows, at = np.unique(row, return_inverse=True)
        place = np.arange(len(row)) - np.searchsorted(row, row)
        k, wide = self.ids.shape[1], place.max() + 1
        i = np.full((len(rows), k + wide), self.none, self.ids.dtype)
        v = np.full(i.shape, -np.inf, "f4")
        i[:, :k], v[:, :k] = self.ids[rows], self.scores[rows]
        i[at, k + place], v[at, k + place] = ids, scores
        best = np.argpartition(-v, k - 1, axis=1)[:, :k]
        low = np.take_along_axis(v, best, 1).min(axis=1)[:, None]
        # Equal scores on both sides of the cut: the smaller id stays.
        tied = np.flatnonzero((v >= low).sum(axis=1) > k)
        best[tied] = np.lexsort((i[tied], -v[tied]), axis=1)[:, :k]
        self.ids[rows], self.scores[rows] = np.take_along_axis(i, best, 1), np.take_along_axis(v, best, 1)

    def low(self) -> np.ndarray:
        """The k-th scores; -inf where there are fewer."""
        return self.scores.min(axis=1)

    def rows(self, sid: np.ndarray):
        """(source, target, score, pos) frames of bounded size, best first."""
        step = max(1, LIST_ROWS // self.ids.shape[1])
        for a in range(0, len(sid), step):
            i, v = self.ids[a : a + step], self.scores[a : a + step]
            order = np.lexsort((i, -v), axis=1)
            i, v = np.take_along_axis(i, order, 1), np.take_along_axis(v, order, 1)
            row, col = np.nonzero((i != self.none) | ~np.isneginf(v))
            yield pd.DataFrame({"source": sid[a + row], "target": i[row, col].astype("i8"), "score": v[row, col].astype("f8"), "pos": (col + 1).astype("i4")})


def _by_norm(targets: DataFrame, n: int, block: int) -> DataFrame:
    """Targets -> (key, norm, ids, matrix), written: blocks by falling norm, ``norm`` the largest in it, ids ascending."""
    blocks = max(1, -(-n // block))
    norm = F.sqrt(F.aggregate("features", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))
    ranged = targets.withColumn("norm", norm)
    ranged = ranged.repartitionByRange(blocks, F.desc("norm"), "id") if blocks > 1 else ranged.coalesce(1)

    def pack(batches):
        held, size, made = [], 0, TaskContext.get().partitionId() << 32

        def row(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("id")
            matrix = np.stack([np.asarray(f, "f4") for f in group["features"]])
            return pd.DataFrame({"key": [made], "norm": [group["norm"].max()], "ids": [group["id"].to_numpy("i8").tobytes()], "matrix": [matrix.tobytes()]})

        for batch in batches:
            held.append(batch)
            size += len(batch)
            while size >= 2 * block:  # a range may be longer than asked for
                every = pd.concat(held)
                yield row(every[:block])
                held, size, made = [every[block:]], size - block, made + 1
        if size:
            yield row(pd.concat(held))

    return _stored(ranged.mapInPandas(pack, "key long, norm double, ids binary, matrix binary"), "targets-by-norm")


def top_k_products(
    sources: DataFrame,
    targets: DataFrame,
    k: int,
    source: str = "user_id",
    target: str = "item_id",
    source_block: int | None = None,
    target_block: int | None = None,
) -> DataFrame:
    """The k targets of largest product for every source (O3): (source, target, score, pos), pos from 1.

    Both sides are (id, features) with factors of one length.  Ties go to the smaller target id.  Sources
    or targets without rows: no result rows.
    """
    spark = sources.sparkSession
    s_kind, t_kind = sources.schema["id"].dataType, targets.schema["id"].dataType
    sources, targets = _known(sources), _known(targets)
    n_sources, n_targets = sources.count(), targets.count()
    size = source_block or min(SOURCE_BLOCK, max(LEAST_SOURCES, n_sources // (2 * spark.sparkContext.defaultParallelism)))
    n_left = max(1, -(-n_sources // size))
    right = _by_norm(targets, n_targets, target_block or TARGET_BLOCK)
    # One number a block of targets.
    meta = sorted(((-r["norm"], r["key"]) for r in right.select("norm", "key").collect()))
    norms, names = np.array([-x for x, _ in meta]), [key for _, key in meta]
    number = F.array_position(F.lit(names or [-1]), F.col("key")).cast("int") - 1
    right = right.select(number.alias("other"), "norm", "ids", "matrix")
    left = packed(sources, n_left, "f4")
    columns = ["block", "other", "norm", "ids", "matrix", "floor"]
    kind = "i4" if t_kind.typeName() in ("integer", "short", "byte") else "i8"

    def read(ids: bytes, matrix: bytes) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(ids, "i8")
        return ids, np.frombuffer(matrix, "f4").reshape(len(ids), -1)

    def floors(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        """The k-th scores of a block of sources and the last target block that one of them can need."""
        if not len(a) or not len(b):
            return pd.DataFrame({"block": [], "floor": [], "reach": []})
        (sid, sx), (tid, tx) = (read(x["ids"].iloc[0], x["matrix"].iloc[0]) for x in (a, b))
        floor = np.full(len(sid), -np.inf, np.float32)
        if len(tid) >= k:
            for row, _, value in best_of(sx, tx, k):
                floor[row] = value  # best first: the last one written is the k-th
        length = np.linalg.norm(sx.astype("f8"), axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(floor > 0, floor / length, -np.inf).min()
        return pd.DataFrame({"block": [a["block"].iloc[0]], "floor": [floor.tobytes()], "reach": [int((norms * SLACK >= need).sum()) - 1]})

    def solve(batches):
        """A block of sources, then the target blocks that it needs, one row each: lists grow in
        arrays of one size and leave when the next block of sources begins."""
        lists = block = None
        for batch in batches:
            for at in range(batch.num_rows):
                x = {c: batch.column(c)[at].as_py() for c in columns}
                if x["other"] < 0:
                    if lists is not None:
                        yield from framed(lists.rows(sid))
                    sid, sx = read(x["ids"], x["matrix"])
                    block, length = x["block"], np.linalg.norm(sx.astype("f8"), axis=1)
                    start = None if x["floor"] is None else np.frombuffer(x["floor"], "f4")
                    lists = Lists(len(sid), k, kind)
                    continue
                if x["block"] != block:  # a block without sources
                    continue
                tid, tx = read(x["ids"], x["matrix"])
                low = lists.low() if start is None else np.maximum(lists.low(), start)
                live = np.flatnonzero(length * x["norm"] * SLACK >= low)
                for row, col, value in best_of(sx[live], tx, min(k, len(tid)), low[live]):
                    lists.put(live[row], tid[col], value)
        if lists is not None:
            yield from framed(lists.rows(sid))

    def framed(frames):
        for f in frames:
            yield pa.RecordBatch.from_pandas(f, preserve_index=False)

    if not names:
        left = left.limit(0)
    if len(names) > 1:
        left = _stored(left, "packed-sources")
        copies = F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))).alias("block")
        top = right.filter("other = 0").select("ids", "matrix", copies)
        bounds = _stored(left.groupBy("block").cogroup(top.groupBy("block")).applyInPandas(floors, "block int, floor binary, reach int"), "floors")
        needed = bounds.select("block", F.explode(F.sequence(F.lit(0), F.greatest("reach", F.lit(0)))).alias("other"))
        left = left.join(bounds.select("block", "floor"), "block")
    else:
        needed = spark.range(n_left).select(F.col("id").cast("int").alias("block"), F.lit(0).alias("other"))
        left = left.withColumn("floor", F.lit(None).cast("binary"))
    own = left.withColumns({"other": F.lit(-1), "norm": F.lit(0.0)}).select(columns)
    met = right.join(F.broadcast(needed), "other").withColumn("floor", F.lit(None).cast("binary")).select(columns)
    # A hash may bring two blocks to one task, so there are more tasks than blocks.
    dealt = own.unionByName(met).repartition(min(4 * n_left, 1 << 14), "block").sortWithinPartitions("block", "other")
    found = dealt.mapInArrow(solve, "source long, target long, score double, pos int")
    return found.select(F.col("source").cast(s_kind).alias(source), F.col("target").cast(t_kind).alias(target), "score", "pos")
