"""Prefix trie of conversations, its subtrees read from balanced parentheses.

A node is a distinct sequence of first turns.  Its key is a sum over the turns of hashes of
(place, role, text), 128 bits in four parts: sums run over a conversation of any length in
parts, so no task holds a conversation whole.  Conversations that end in the same node are one path with
a number of copies.

Sharding: a node's weight is the number of path rows below it.  Nodes above ``shard_rows`` are
the spine, shared by many shards; every other node lies in the subtree of its topmost light ancestor,
and whole subtrees go to shards by hash.  A shard writes its forest as parentheses, an open one where a
node begins and a close one where its subtree ends.  Blocks of least and greatest excess answer
``findclose`` for all nodes, a rank over leaf pairs "()" counts leaves, and cumulative arrays give
savings.  The sums of the light subtrees hang on the spine as weights, and the spine is solved in
the same way: in one piece, or if conversations are very long in bands of ``BAND`` levels from below.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, written
from tessera.operators.grouped import dense_positions

#: Path rows under a light subtree at most, and nodes of a shard about.
SHARD_ROWS = 1 << 14
#: Turns that are summed in one window; levels of the spine that are solved at a time; ids hashed as one string.
STRETCH, BAND, ID_BLOCK = 1 << 14, 1 << 16, 1 << 12


class Parentheses:
    """A balanced sequence (1 opens, 0 closes) with range min-max blocks over its excess."""

    def __init__(self, bits: np.ndarray, block: int = 256) -> None:
        self.bits, self.block = bits, block
        self.excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        pad = -len(bits) % block
        self.rows = np.concatenate((self.excess, np.full(pad, 1 << 40))).reshape(-1, block)
        low, high = self.rows.min(1, initial=1 << 40), np.where(self.rows < 1 << 40, self.rows, -1).max(1, initial=-1)
        self.levels = [(low, high)]
        while len(low) > 1:  # a node of the next level spans two of this one
            odd = len(low) % 2
            low, high = np.concatenate((low, [1 << 40] * odd)), np.concatenate((high, [-1] * odd))
            low, high = low.reshape(-1, 2).min(1), high.reshape(-1, 2).max(1)
            self.levels.append((low, high))
        self.opens = np.flatnonzero(bits)
        self.leaf_rank = np.cumsum((bits == 1) & (np.append(bits[1:], 1) == 0))

    def findclose(self, p: np.ndarray) -> np.ndarray:
        """For every open place the place of its close: the first one after it with an excess one lower."""
        goal, out = self.excess[p] - 1, np.full(len(p), -1)
        self._scan(out, np.arange(len(p)), p // self.block, p % self.block, goal)
        left = np.flatnonzero(out < 0)
        node, found, at = p[left] // self.block, np.full(len(left), -1), np.zeros(len(left), np.int64)
        for level, (low, high) in enumerate(self.levels):  # up, until a right neighbour spans the goal
            open_ = np.flatnonzero(found < 0)
            right = node[open_] + 1
            spans = (node[open_] % 2 == 0) & (right < len(low))
            seen = np.minimum(right, len(low) - 1)
            spans &= (low[seen] <= goal[left[open_]]) & (goal[left[open_]] <= high[seen])
            found[open_[spans]], at[open_[spans]] = level, right[spans]
            node //= 2
        for level in range(len(self.levels) - 2, -1, -1):  # down, to the first block that spans it
            below = np.flatnonzero(found > level)
            low, high = self.levels[level]
            child = at[below] * 2
            want = goal[left[below]]
            at[below] = child + ~((low[child] <= want) & (want <= high[child]))
        self._scan(out, left, at, np.full(len(left), -1), goal)
        return out

    def _scan(self, out: np.ndarray, which: np.ndarray, block: np.ndarray, after: np.ndarray, goal: np.ndarray) -> None:
        column = np.arange(self.block)
        for k in range(0, len(which), 1 << 12):
            w, b, a = which[k : k + (1 << 12)], block[k : k + (1 << 12)], after[k : k + (1 << 12)]
            hit = (self.rows[b] == goal[w][:, None]) & (column > a[:, None])
            some = hit.any(1)
            out[w[some]] = b[some] * self.block + hit[some].argmax(1)


def parentheses(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest by parent numbers (-1: none) -> (its parentheses, nodes in the order of their opens)."""
    n = len(parent)
    child = np.argsort(parent, kind="stable")
    bounds = np.searchsorted(parent[child], np.arange(-1, n + 1)).tolist()
    child = child.tolist()
    bits, order = bytearray(), []
    stack = child[bounds[0] : bounds[1]][::-1]
    while stack:
        k = stack.pop()
        if k < 0:
            bits.append(0)
            continue
        bits.append(1)
        order.append(k)
        stack.append(-1)
        stack += child[bounds[k + 1] : bounds[k + 2]][::-1]
    return np.frombuffer(bytes(bits), np.uint8), np.array(order, np.int64)


def subtree_sums(parent: np.ndarray, saved: np.ndarray, kids: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Children, leaves and savings of every node's subtree, from ``parent`` numbers and, for each node, its own
    savings with those that hang on it from elsewhere, and the children and leaves that hang on it."""
    bits, order = parentheses(parent)
    tree = Parentheses(bits)
    close = tree.findclose(tree.opens)
    # Opens up to a place are node ranks, so both ends of a subtree are places in arrays by that order.
    first, last = np.arange(len(order)), np.cumsum(bits)[close]
    total = lambda x: (lambda c: c[last] - c[first])(np.concatenate(([0], np.cumsum(x[order]))))
    pairs = tree.leaf_rank[close] - tree.leaf_rank[tree.opens] + (np.append(bits, 1)[tree.opens + 1] == 0)
    bare = np.bincount(parent[parent >= 0], minlength=len(parent)) == 0
    out = [np.empty(len(parent), np.int64) for _ in range(3)]
    out[0][:] = np.bincount(parent[parent >= 0], minlength=len(parent)) + kids
    out[1][order] = pairs + total(leaves - (bare & (kids > 0)))  # a pair on which leaves hang is none itself
    out[2][order] = total(saved)
    return tuple(out)


SUMS = "key binary, n_children long, n_leaves long, saved_tokens long"


def _solve(nodes: DataFrame, group: str) -> DataFrame:
    """(key, parent, saved, kids, leaves) nodes -> SUMS, one forest a ``group``."""

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        parent = pd.Index(part["key"]).get_indexer(part["parent"])
        kids, leaves, saved = subtree_sums(parent, *(part[c].to_numpy(np.int64) for c in ("saved", "kids", "leaves")))
        return pd.DataFrame({"key": part["key"], "n_children": kids, "n_leaves": leaves, "saved_tokens": saved})

    return nodes.groupBy(group).applyInPandas(solve, SUMS)


def _hung(tops: DataFrame) -> DataFrame:
    """Sums of solved subtrees, by the node that they hang on."""
    return tops.groupBy(F.col("parent").alias("on")).agg(
        F.count(F.lit(1)).alias("kids_"), F.sum("n_leaves").alias("leaves_"), F.sum("saved_tokens").alias("saved_")
    )


def _with_hung(nodes: DataFrame, hung: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    cols = [c for c in nodes.columns if c not in ("saved", "kids", "leaves")]
    sums = [(F.col(c) + F.coalesce(F.col(c + "_"), zero)).alias(c) for c in ("saved", "kids", "leaves")]
    return nodes.join(hung, nodes["key"] == hung["on"], "left").select(*cols, *sums)


def _key(sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", *[s.cast("string") for s in sums])))


PARTS = ("s0", "s1", "s2", "s3")
ROOT = hashlib.md5(b"0,0,0,0").digest()


def _ranked(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (c, pid, mid, x1, x2, words) in global order, written, and per (c, pid) their number, the first ``mid``
    and how many turns of the conversation stand before."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn"), half(1).alias("x1"), half(16).alias("x2"), F.size(F.regexp_extract_all(text, F.lit(f"({WORD})"))).cast("long").alias("words")
    )
    ordered = turns.orderBy("c", F.asc_nulls_first("turn"), "x1", "x2").withColumn("mid", F.monotonically_increasing_id())
    ordered = written(ordered.select("c", F.shiftright("mid", 33).alias("pid"), "mid", "x1", "x2", "words"), "trie-turns")
    before = Window.partitionBy("c").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("c", "pid").agg(F.count(F.lit(1)).alias("n"), F.min("mid").alias("first"))
    return ordered, parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def rebuilt_paths(conversations: DataFrame, base_of: Callable[[Column], Column], head_of: Callable[[Column], Column], most_head: int) -> tuple[DataFrame, DataFrame]:
    """(c, length) of every rebuilt conversation, and its turns: c, depth, words, key and parent of the node that ends there."""
    ordered, parts = _ranked(conversations)
    sizes = parts.groupBy("c").agg(F.sum("n").alias("n"))
    convs = sizes.select("c", "n", head_of(F.col("c")).cast("long").alias("h"), base_of(F.col("c")).alias("base"))
    n_base = sizes.select(F.col("c").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(n_base, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    convs = written(convs.select("c", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-convs")
    # One row a (conversation, partition) meets the turns of that partition only.
    placed = ordered.join(parts.join(convs.select("c", "h", "k"), "c"), ["c", "pid"]).withColumn("rank", F.col("before") + F.col("mid") - F.col("first") + 1)
    own = placed.filter("rank > h").select("c", (F.col("rank") - F.col("h") + F.col("k")).alias("depth"), "x1", "x2", "words")
    heads = placed.filter((F.col("rank") <= most_head) & (F.col("c") == base_of(F.col("c")))).select(F.col("c").alias("base"), "rank", "x1", "x2", "words")
    lent = convs.join(heads, "base").filter("rank <= h").select("c", F.col("rank").alias("depth"), "x1", "x2", "words")
    turns = own.unionByName(lent)
    hashes = [F.xxhash64(F.lit(seed), "depth", "x1", "x2") for seed in (1, 2)]
    low = F.lit(0xFFFFFFFF)
    each = [f for h in hashes for f in (h.bitwiseAND(low), F.shiftrightunsigned(h, 32))]
    turns = turns.select("c", "depth", "words", F.floor((F.col("depth") - 1) / STRETCH).alias("stretch"), *[e.alias(p) for e, p in zip(each, PARTS)])
    longest = convs.agg(F.max("length")).first()[0] or 0
    upto = Window.partitionBy("c", "stretch").orderBy("depth")
    summed = turns.select("c", "depth", "words", "stretch", *PARTS, *[F.sum(p).over(upto).alias(p + "u") for p in PARTS])
    if longest > STRETCH:
        earlier = Window.partitionBy("c").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        totals = turns.groupBy("c", "stretch").agg(*[F.sum(p).alias(p) for p in PARTS])
        totals = totals.select("c", "stretch", *[F.coalesce(F.sum(p).over(earlier), F.lit(0).cast("long")).alias(p + "b") for p in PARTS])
        summed = summed.join(totals, ["c", "stretch"]).withColumns({p + "u": F.col(p + "u") + F.col(p + "b") for p in PARTS})
    here, above = [F.col(p + "u") for p in PARTS], [F.col(p + "u") - F.col(p) for p in PARTS]
    return convs.select("c", "length"), written(summed.select("c", "depth", "words", _key(here).alias("key"), _key(above).alias("parent")), "trie-paths")


def _id_hashes(ends: DataFrame) -> DataFrame:
    """(key, c) -> (key, ends_sha256): SHA-256 over the ascending ids, comma-joined.

    Ids are joined by blocks of the id order first; the hash runs over a key's blocks in order, one in memory at a time."""
    blocks = ends.join(dense_positions(ends, "c", "pos"), "c").groupBy("key", F.floor(F.col("pos") / ID_BLOCK).alias("block"))
    joined = blocks.agg(F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = state = None
        for batch in batches:
            out = []
            for k, ids in zip(batch["key"], batch["ids"]):
                if k == key:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if state:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])

    return joined.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInPandas(digest, "key binary, ends_sha256 string")


def _light(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Path rows -> (key, top): every light node with its topmost light ancestor."""
    depth = rows.join(heavy.select("key"), "key").groupBy("rep").agg(F.max("depth").alias("spine"))
    cut = rows.join(depth, "rep", "left").withColumn("spine", F.coalesce("spine", F.lit(-1).cast("long")))
    tops = cut.filter("depth = spine + 1").select("rep", F.col("key").alias("top"))
    return cut.filter("depth > spine").select("rep", "key").join(tops, "rep").groupBy("key").agg(F.min("top").alias("top"))


def _spine(heavy: DataFrame, rows: DataFrame) -> DataFrame:
    """SUMS of the spine: one forest, or bands of levels from below, each hanging on the one above it."""
    deepest = heavy.agg(F.max("depth")).first()[0]
    if deepest is None or deepest < BAND:
        return _solve(heavy.withColumn("band", F.lit(0)), "band")
    band = F.floor(F.col("depth") / BAND)
    on_path = rows.join(heavy.select("key"), "key", "left_semi").select("rep", "key", band.alias("band"), "depth")
    tops = on_path.filter(F.col("depth") % BAND == 0).select("rep", "band", F.col("key").alias("top"))
    named = on_path.join(tops, ["rep", "band"]).groupBy("key").agg(F.min("top").alias("top"), F.min("band").alias("band"))
    heavy, out = written(heavy.join(named, "key"), "trie-spine"), None
    hung = None
    for k in range(deepest // BAND, -1, -1):
        nodes = heavy.filter(F.col("band") == k)
        solved = written(_solve(_with_hung(nodes, hung) if hung else nodes, "top"), f"trie-band-{k}")
        hung = _hung(solved.join(nodes.filter(F.col("key") == F.col("top")).select("key", "parent"), "key"))
        out = solved if out is None else out.unionByName(solved)
    return out


def prefix_trie(
    conversations: DataFrame,
    base_of: Callable[[Column], Column],
    head_of: Callable[[Column], Column],
    most_head: int,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Turns (conv_id, turn, role, text) -> one row a trie node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    A conversation is rebuilt as the first ``head_of`` (at most ``most_head``) turns of ``base_of`` it, then its own
    after as many.  Null turns come first; equal turn numbers go by a digest of role and text, so repeated
    rows stand next to each other.  A null role or text is empty; rows without conv_id are left out.
    Conversations of any length and groups of copies of any size are worked on in parts.  Other columns are ignored.  Empty
    input gives no rows; otherwise the root (depth 0) is one of them.
    """
    lengths, paths = rebuilt_paths(conversations, base_of, head_of, most_head)
    last = paths.join(lengths, (paths["c"] == lengths["c"]) & (paths["depth"] == lengths["length"])).select(paths["c"], "length", "key")
    root = F.lit(bytearray(ROOT))
    ends = written(last.unionByName(lengths.filter("length = 0").select("c", "length", root.alias("key"))), "trie-ends")
    seqs = ends.groupBy("key").agg(F.min("c").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("length").alias("length"))
    seqs = written(seqs.select("rep", "copies", "length"), "trie-sequences")
    inner = paths.join(seqs, paths["c"] == seqs["rep"]).select("rep", "copies", "length", "depth", "words", "key", "parent")
    tops = seqs.select("rep", "copies", "length", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), root.alias("key"), F.lit(None).cast("binary").alias("parent"))
    rows = inner.unionByName(tops)
    nodes = rows.groupBy("key").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("words").alias("words"),
        F.min("rep").alias("conv_id"),
        F.sum("copies").alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    nodes = written(nodes, "trie-nodes")
    zero = F.lit(0).cast("long")
    own = nodes.select("key", "parent", "depth", "weight", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), zero.alias("kids"), zero.alias("leaves"))
    heavy = own.filter(F.col("weight") > shard_rows)
    n = nodes.count()
    if heavy.limit(1).count():
        light = own.join(_light(rows, heavy), "key").withColumn("shard", F.pmod(F.xxhash64("top"), F.lit(max(1, math.ceil(n / shard_rows)))))
        light = written(light, "trie-light")
        solved = written(_solve(light, "shard"), "trie-solved")
        hung = _hung(solved.join(light.filter("key = top").select("key", "parent"), "key"))
        solved = solved.unionByName(_spine(_with_hung(heavy, hung), rows))
    else:
        solved = _solve(own.withColumn("shard", F.lit(0)), "shard")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(solved, "key").join(_id_hashes(ends.select("key", "c")), "key", "left").join(above, "parent", "left")
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    )
