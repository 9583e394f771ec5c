"""Alignment of two tokenizers by merge-path partitioning.

Tokens A and B of one text are two rising lists of byte ends.  Merging them shows everything:
an end in both lists closes a group, and every distinct end closes the overlap of one A and one B
token, a link.  Diagonal binary searches cut the merge into independent pieces of equal work;
each piece emits its links and common ends, and groups that a cut runs through are stitched by the
common ends on both sides of it.

How often two ids are linked is counted over the whole corpus.  The text pass writes links by the
chunk (a bounded number of links, a long document may span several): every chunk holds
its distinct id pairs with their counts, and its links as places in that list.  Only the lists are
summed and sent back; no table of all pairs is collected or broadcast.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, text_or_empty, written

#: Ends that one piece of the merge holds.
PIECE = 1 << 16
#: Links of a chunk; characters and text units that are taken at a time.
CHUNK_LINKS, RUN_CHARS, RUN_UNITS = 1 << 21, 1 << 22, 1 << 17
#: Units and ids that a task's table of known units may hold between runs; units that B encodes in one call.
TABLE_UNITS, TABLE_IDS, CALL_UNITS = 1 << 18, 1 << 22, 256
#: Units of these characters only: letter classes that no version of Unicode has changed.
LATIN = re.compile(r"[\x00-\x7f\xc0-\u024f]*")

#: A unit: white space, then what follows up to the next space or line break that stands after a sign.
#: Neither tokenizer joins anything across such a place, so the tokens of a text are those of its units.
UNIT = re.compile(r"\s*\S+(?:[^\S \n]\s*(?:\S+|\Z))*|\s+")
CUT = re.compile(r"(?<=\S)(?=[ \n])")

#: Byte-level BPE writes a byte as its own character if that is visible, else as one from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
CHAR_BYTE = {**{chr(b): b for b in _VISIBLE}, **{chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_VISIBLE))}}


def byte_tokens(spec: dict) -> list[bytes]:
    """The bytes of every id of a byte-level BPE vocabulary (tokenizer file as a dict)."""
    vocab = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
    out = [b""] * (max(vocab.values()) + 1)
    for token, k in vocab.items():
        out[k] = bytes(CHAR_BYTE[c] for c in token) if all(c in CHAR_BYTE for c in token) else token.encode()
    return out


def piece_tokens(processor) -> list[bytes]:
    """The bytes of every id of a sentencepiece vocabulary."""
    out = []
    for k in range(processor.get_piece_size()):
        piece = processor.id_to_piece(k)
        out.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(k) else piece.replace("▁", " ").encode())
    return out


def _ranked(spec: dict):
    """The same byte-level BPE by ranks, which is quicker; None if its merges do not stand in the order of their ids."""
    import public_tokenizers
    import tiktoken

    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if [vocab.get(x + y) for x, y in pairs] != list(range(256, 256 + len(pairs))) or spec["model"].get("ignore_merges"):
        return None
    ranks = {bytes(CHAR_BYTE[c] for c in t): k for t, k in vocab.items() if k < 256 + len(pairs)}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Places(dict):
    """Unit -> its number; units that are not known yet get the next one and are listed."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.new.append(unit)
        return n


class _Side:
    """Ids of all known units, one after the other, for one tokenizer."""

    def __init__(self, token_bytes: list[bytes]) -> None:
        self.bytes = pa.array(token_bytes, pa.binary())
        self.size = np.array([len(b) for b in token_bytes], np.int64)
        self.clear()

    def __len__(self) -> int:
        return len(self.size)

    def clear(self) -> None:
        self.flat, self.stop = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, n: np.ndarray) -> None:
        """Ids of new units in a row, and how many each has."""
        self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
        self.stop = np.concatenate((self.stop, np.cumsum(n) + (self.stop[-1] if len(self.stop) else 0)))

    def tokens(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units in a row, and where each unit's ids begin (and the end)."""
        length = np.diff(self.stop, prepend=0)[units]
        stop = np.cumsum(length)
        ids = self.flat[np.repeat(self.stop[units] - stop, length) + np.arange(stop[-1] if len(stop) else 0)]
        return ids, np.concatenate(([0], stop))

    def misspelt(self, units: list[bytes], ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Which units the ids do not spell."""
        stop = np.concatenate(([0], np.cumsum(self.size[ids])))[np.cumsum(n)]
        raw = pc.take(self.bytes, pa.array(ids)).buffers()[2]
        spelt = raw.to_pybytes() if raw else b""
        bad = np.diff(stop, prepend=0) != np.fromiter(map(len, units), np.int64, len(units))
        if bad.any() or spelt[: stop[-1]] != b"".join(units):
            bounds = [0, *stop.tolist()]
            bad = np.array([spelt[x:y] != u for u, x, y in zip(units, bounds, bounds[1:])])
        return bad


def _row(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n.sum())), n


class Encoder:
    """Both tokenizers behind one table of known units; each distinct unit is encoded once a table."""

    def __init__(self, byte_file: str, piece_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        spec = json.loads(byte_file)
        self._byte_file, self._byte = byte_file, None
        self.piece = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        before, pieces = spec["pre_tokenizer"], [self.piece.id_to_piece(k) for k in range(self.piece.get_piece_size())]
        if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True):
            raise ValueError("tokenizer A must be byte-level BPE that splits at spaces and adds none")
        if any("\n" in p or "▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("tokenizer B must not have pieces with an inner space or a line break")
        self.a, self.b = _Side(byte_tokens(spec)), _Side(piece_tokens(self.piece))
        self.ranked = _ranked(spec)
        self.line = self.piece.encode("\n")[-1]
        self.clear()

    @property
    def byte(self):
        """Tokenizer A itself, made when a unit needs it."""
        if self._byte is None:
            from tokenizers import Tokenizer

            self._byte = Tokenizer.from_str(self._byte_file)
            self._byte.encode_special_tokens = True  # their strings are plain text
        return self._byte

    def clear(self) -> None:
        self.known, self.bad = _Places(), np.zeros(0, bool)
        self.a.clear()
        self.b.clear()

    def units(self, text: str) -> np.ndarray:
        """Unit numbers of a text that begins with a space; long texts are cut at units.  Before the
        numbers are used, ``learn`` must have been called."""
        out, at = [], 0
        while at < len(text):
            cut = CUT.search(text, at + RUN_CHARS) if len(text) - at > RUN_CHARS else None
            stop = cut.start() if cut else len(text)
            found = UNIT.findall(text[at:stop] if at or cut else text)
            out.append(np.fromiter(map(self.known.__getitem__, found), np.int64, len(found)))
            at = stop
        return out[0] if len(out) == 1 else np.concatenate(out)

    def learn(self) -> None:
        """Encode the units that are new since the last call."""
        new, self.known.new = self.known.new, []
        if not new:
            return
        raw = [u.encode() for u in new]
        a, n_a = self._byte_ids(new)
        b, n_b = self._piece_ids(new)
        bad = self.a.misspelt(raw, a, n_a) | self.b.misspelt(raw, b, n_b)
        self.a.add(a, n_a)
        self.b.add(b, n_b)
        self.bad = np.concatenate((self.bad, bad))

    def _byte_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        quick = self.ranked.encode_ordinary if self.ranked else None
        ids = [quick(u) if quick and LATIN.fullmatch(u) else None for u in units]
        rest = [k for k, x in enumerate(ids) if x is None]
        for k, e in zip(rest, self.byte.encode_batch_fast([units[k] for k in rest], add_special_tokens=False) if rest else ()):
            ids[k] = e.ids
        return _row(ids)

    def _piece_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A line break stands alone in B, so units behind one are encoded as inside a text: many in one
        call, and those with a line break of their own each in one.  The space that B adds goes with the first."""
        plain = [k for k, u in enumerate(units) if "\n" not in u]
        calls = ["\n" + "\n".join([units[k] for k in plain[i : i + CALL_UNITS]]) for i in range(0, len(plain), CALL_UNITS)]
        lines, _ = _row([x[1:] for x in self.piece.encode(calls, num_threads=1)])
        at = np.flatnonzero(lines == self.line)  # one before every unit
        n = np.zeros(len(units), np.int64)
        n[plain] = np.diff(at, append=len(lines)) - 1
        own = [k for k, u in enumerate(units) if "\n" in u]
        singly, n[own] = _row([x[2:] for x in self.piece.encode(["\n" + units[k] for k in own], num_threads=1)])
        out, is_own = np.empty(int(n.sum()), np.int64), np.zeros(len(units), bool)
        is_own[own] = True
        where = np.repeat(is_own, n)
        out[where], out[~where] = singly, lines[lines != self.line]
        return out, n

    def trim(self) -> None:
        """Forget everything once the table is full; only between runs."""
        if len(self.known) > TABLE_UNITS or len(self.a.flat) > TABLE_IDS:
            self.clear()


def cuts(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two rising lists crosses every ``piece``-th diagonal: how many of each stand before.

    Binary searches on all diagonals at once; of equal ends that in ``a`` comes first."""
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low, d - low
        mid = (low[live] + high[live]) // 2
        first = a[mid] <= b[d[live] - 1 - mid]
        low[live] = np.where(first, mid + 1, low[live])
        high[live] = np.where(first, high[live], mid)


def piece_links(a: np.ndarray, b: np.ndarray, i: int, i2: int, j: int, j2: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One piece of the merge, ``a[i:i2]`` with ``b[j:j2]`` -> (A and B token numbers of its links, B numbers of common ends).

    An end of A closes a link; an end of B does unless A has it too, which the last A end up to it tells."""
    ours, theirs = a[i:i2], b[j:j2]
    at = i + np.searchsorted(ours, theirs, "right")  # ends of A up to each end of B
    common = (at > 0) & (a[np.maximum(at - 1, 0)] == theirs)
    alone = ~common
    left = np.concatenate((np.arange(i, i2), at[alone]))
    right = np.concatenate((j + np.searchsorted(theirs, ours, "left"), np.arange(j, j2)[alone]))
    return left, right, np.arange(j, j2)[common]


def align(a_ends: np.ndarray, b_ends: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte ends of two tokenizations -> (A numbers and B numbers of the links, A and B tokens up to the end of every group)."""
    i, j = cuts(a_ends, b_ends, piece)
    parts = [piece_links(a_ends, b_ends, *x) for x in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist())]
    left, right, common = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))
    # Stitching: a group reaches from the common end before it to its own, whatever pieces lie between.
    return left, right, np.searchsorted(a_ends, b_ends[common], "right"), common + 1


def group_texts(names: pa.Array, size: int, a_ids, b_ids, a_stop, b_stop) -> pa.Array:
    """Ids in group order with what follows each: ``names`` holds every id with ',', with '|' and with ';' (``size`` each)."""
    a_in, b_in = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
    a_sep, b_sep = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_sep[a_stop - 1], b_sep[b_stop - 1] = size, 2 * size
    out = np.empty(len(a_ids) + len(b_ids), np.int64)
    out[np.arange(len(a_ids)) + np.repeat(b_stop - b_in, a_in)] = a_ids + a_sep
    out[np.arange(len(b_ids)) + np.repeat(a_stop, b_in)] = b_ids + b_sep
    return pc.take(names, pa.array(out))


class _Chunk:
    """Links of some documents, on their way to a row of the table."""

    def __init__(self) -> None:
        self.links, self.docs, self.sizes, self.n = [], [], [], 0

    def row(self, number: int) -> dict:
        pairs, place, m = np.unique(np.concatenate(self.links), return_inverse=True, return_counts=True)
        order = np.argsort(-m, kind="stable")  # common pairs get small places
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        raw = lambda x, kind: np.asarray(x, kind).tobytes()
        return {"chunk": number, "docs": raw(self.docs, "<i8"), "sizes": raw(self.sizes, "<i8"), "places": raw(rank[place], "<u4"), "pairs": raw(pairs[order], "<i8"), "counts": raw(m[order], "<i8")}


_DOC = [("row", pa.int64()), ("doc_id", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string())]
_CHUNK = [("chunk", pa.int64()), *((c, pa.binary()) for c in ("docs", "sizes", "places", "pairs", "counts"))]
SCHEMA = pa.schema(_DOC + _CHUNK)
LINKS = "row long, doc_id string, n_a long, n_b long, n_groups long, groups_sha256 string, chunk long, docs binary, sizes binary, places binary, pairs binary, counts binary"


def link_table(docs: DataFrame, byte_path: str, piece_path: str, chunk_links: int = CHUNK_LINKS, piece: int = PIECE) -> DataFrame:
    """The text pass, written: one row a document (row, doc_id, n_a, n_b, n_groups, groups_sha256) and one a
    chunk (its documents, their links as places in its list of pairs, the pairs with their counts)."""
    with open(byte_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        files = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))  # two vocabulary files

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, chunk, made, done = Encoder(*files.value), _Chunk(), 0, []
        size = max(len(encoder.a), len(encoder.b))
        kind = np.uint32 if len(encoder.a) * len(encoder.b) < 1 << 32 else np.int64
        names = pa.array([f"{k}{s}" for s in ",|;" for k in range(size)], pa.binary())
        base = TaskContext.get().partitionId() << 32

        def aligned(rows: list[dict], units: list[np.ndarray]) -> Iterator[dict]:
            """Documents of one run, block by block of units; a unit's end is an end of both, so blocks are independent.
            A document with a unit that its tokens do not spell has none."""
            nonlocal chunk, made
            encoder.learn()
            units = [u[:0] if encoder.bad[u].any() else u for u in units]
            every, stop = np.concatenate(units), np.cumsum([len(u) for u in units])
            digest, first = [hashlib.sha256() for _ in rows], 0
            for at in range(0, len(every), RUN_UNITS):
                block = every[at : at + RUN_UNITS]
                a, a_from = encoder.a.tokens(block)
                b, b_from = encoder.b.tokens(block)
                a_ends, b_ends = np.cumsum(encoder.a.size[a]), np.cumsum(encoder.b.size[b])
                left, right, a_stop, b_stop = align(a_ends, b_ends, piece)
                pairs = a[left].astype(kind) * kind(len(encoder.b)) + b[right].astype(kind)
                text = group_texts(names, size, a, b, a_stop, b_stop)
                text_from = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1)
                raw = memoryview(text.buffers()[2] or b"")
                order = np.argsort(left, kind="stable")  # by document: each piece lists A's links, then B's
                pairs, left = pairs[order], left[order]
                while first < len(rows) and (stop[first - 1] if first else 0) < at + len(block):
                    begin, end = max(at, int(stop[first - 1]) if first else 0) - at, min(int(stop[first]), at + len(block)) - at
                    x, y, u, v = int(a_from[begin]), int(a_from[end]), int(b_from[begin]), int(b_from[end])
                    whole = stop[first] <= at + len(block)
                    digest[first].update(raw[text_from[x + u] : text_from[y + v] - (1 if whole and y > x else 0)])
                    rows[first]["n_a"] += y - x
                    rows[first]["n_b"] += v - u
                    rows[first]["n_groups"] += int(np.searchsorted(a_stop, y, "right") - np.searchsorted(a_stop, x, "right"))
                    mine = pairs[np.searchsorted(left, x) : np.searchsorted(left, y)]
                    for k in range(0, len(mine), chunk_links):
                        part = mine[k : k + chunk_links]
                        chunk.links.append(part)
                        chunk.docs.append(rows[first]["row"])
                        chunk.sizes.append(len(part))
                        chunk.n += len(part)
                        if chunk.n >= chunk_links:
                            yield chunk.row(base + made)
                            chunk, made = _Chunk(), made + 1
                    if not whole:
                        break
                    if rows[first]["n_a"]:
                        rows[first]["groups_sha256"] = digest[first].hexdigest()
                    first += 1

        def runs() -> Iterator[dict]:
            rows, units, held = [], [], 0
            for batch in batches:
                for row, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")):
                    text = text.as_py()
                    rows.append({"row": row, "doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "groups_sha256": ""})
                    units.append(encoder.units(" " + text) if text else np.zeros(0, np.int64))
                    held += len(units[-1])
                    if held >= RUN_UNITS:
                        yield from aligned(rows, units)
                        yield from rows
                        rows, units, held = [], [], 0
                        encoder.trim()
            if rows:
                yield from aligned(rows, units)
                yield from rows
            if chunk.n:
                yield chunk.row(base + made)

        for r in runs():
            done.append(r)
            if len(done) >= 10_000 or "chunk" in r:
                yield pa.RecordBatch.from_pylist(done, SCHEMA)
                done = []
        yield pa.RecordBatch.from_pylist(done, SCHEMA)
        del encoder, names, chunk
        give_back()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    return written(rows.mapInArrow(encode, LINKS), "align-links", "zstd")


def pair_counts(chunks: DataFrame, n_b: int) -> tuple[DataFrame, DataFrame]:
    """Chunks -> (their lists as rows: chunk, place, pair; every pair with its corpus-wide ``count`` and
    whether that is the highest of its B id, ``best``)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "pairs", "counts"))):
                pairs, counts = np.frombuffer(pairs, "<i8"), np.frombuffer(counts, "<i8")
                for k in range(0, len(pairs), 1 << 16):
                    part = pairs[k : k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), chunk)), pa.array(np.arange(k, k + len(part), dtype=np.int32)), pa.array(part), pa.array(counts[k : k + len(part)])],
                        names=["chunk", "place", "pair", "m"],
                    )

    rows = chunks.select("chunk", "pairs", "counts").mapInArrow(listed, "chunk long, place int, pair long, m long")
    total = rows.groupBy("pair").agg(F.sum("m").alias("count")).withColumn("b", F.col("pair") % n_b)
    top = total.groupBy("b").agg(F.max("count").alias("top"))
    best = total.join(F.broadcast(top), "b")  # one row an id of B: at most its vocabulary
    return rows, best.select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def align_tokenizers(docs: DataFrame, byte_path: str, piece_path: str, chunk_links: int = CHUNK_LINKS, piece: int = PIECE) -> DataFrame:
    """documents -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row a document.

    Null and empty texts, and those whose tokens do not spell the text in A or B, have no tokens:
    zeros and ''.  Null and repeated doc_ids are rows like any others.  Texts of any length are taken whole, in
    runs of bounded size.  Columns besides doc_id and text are ignored.  Empty input gives no rows.
    """
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    table = link_table(docs, byte_path, piece_path, chunk_links, piece)
    chunks = table.filter("chunk IS NOT NULL")
    listed, counted = pair_counts(chunks, n_b)
    back = listed.select("chunk", "place", "pair").join(counted, "pair").select("chunk", "place", "count", "best")

    def score(links: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        n = len(counts)
        count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        count[counts["place"]], best[counts["place"]] = counts["count"], counts["best"]
        out = []
        for r in links.itertuples():
            sizes, places = np.frombuffer(r.sizes, "<i8"), np.frombuffer(r.places, "<u4")
            first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            out.append(pd.DataFrame({"row": np.frombuffer(r.docs, "<i8"), "n_best": np.add.reduceat(best[places], first), "count_sum": np.add.reduceat(count[places], first)}))
        return pd.concat(out) if out else pd.DataFrame({"row": [], "n_best": [], "count_sum": []})

    lists = chunks.select("chunk", "docs", "sizes", "places").groupBy("chunk")
    scored = lists.cogroup(back.groupBy("chunk")).applyInPandas(score, "row long, n_best long, count_sum long")
    sums = scored.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = table.filter("chunk IS NULL").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return rows.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "n_a",
        "n_b",
        "n_groups",
        (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
