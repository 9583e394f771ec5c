"""Packing documents into training sequences by lexical retrieval.

Every document is tokenized once.  Whole windows of a long document fill sequences of
their own; the rest (its tail) goes to a shard.  A shard holds a bounded number of tail
tokens and has a BM25 inverted index over them, with document frequencies and mean
length of the whole corpus.  The longest unused tail seeds a window; its words are
looked up in the index and the unused neighbours fill the window in score order.  The
neighbour that no longer fits is cut, and what is left of it stays in the shard.  So every
window is full but the last of each shard, which becomes sequences at powers of two.

Shards are cut by content: leaves of a tree over projected BM25 weights, so that lexical
neighbours meet however many shards there are.  A crowded leaf (copies of one text) is split
into bounded shards.  Only tails are shuffled; whole windows go from the text pass to the result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty, written

WINDOW = 2048
END_ID = 1
#: Tail tokens of one shard: bounds the index, and the quadratic work of looking up every tail.
SHARD_TOKENS = 1 << 18
#: Words that a task's table of known words may hold between runs.
CACHE_WORDS = 600_000
#: Text that is encoded at a time, in characters.
RUN_BYTES = 1 << 23
K1, B = 1.2, 0.75


class WordEncoder:
    """Token ids of texts through a table of known words.

    Correct for tokenizers whose pre-tokenizer drops white space and never joins across
    it: then the ids of a text are those of its space-separated words in a row.  With
    ``letter_runs`` (lower-casing byte-level BPE that keeps runs of letters and runs of signs
    apart) a word of letters goes by its lower-case form, and the signs after it by themselves.

    The table is a list of words and their ids one after the other; Arrow finds words
    in it, so Python touches new words only.  Word 0 is the empty one.
    """

    def __init__(self, model: str, words: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.merge = self.tokenizer.model.tokenize
        spec = json.loads(model)
        kinds = {x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])}
        split = [x.get("pattern", {}).get("Regex", "") for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.letter_runs = "Lowercase" in kinds and any(r"[\p{L}]+|" in x and r"[^\s\p{L}\p{N}]+" in x for x in split)
        self.kind = id_type(self.tokenizer)
        self.code = "H" if self.kind == "<u2" else "I"
        self.most = words
        self.words = pa.array([""], pa.string())
        self.flat, self.stop = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts without nulls -> (ids one after the other, first id of every text and the end)."""
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        parts = self._parts(coded.dictionary)
        at = parts[coded.indices.to_numpy()].reshape(-1)
        length = np.diff(self.stop, prepend=0)[at]
        stop = np.cumsum(length)
        take = np.repeat((self.stop[at] - stop).astype(np.int32), length)
        take += np.arange(len(take), dtype=np.int32)
        ends = np.concatenate(([0], stop[parts.shape[1] - 1 :: parts.shape[1]]))
        ids = self.flat[take]
        if len(self.words) > self.most:
            self._forget(np.unique(parts))
        return ids, ends[words.offsets.to_numpy() - words.offsets[0].as_py()]

    def _parts(self, words: pa.Array) -> np.ndarray:
        """For every distinct word the places of its parts in the table, one row a word."""
        if not self.letter_runs:
            return self._places(words).reshape(-1, 1)
        core = pc.utf8_rtrim(words, characters=SIGNS)
        plain = pc.and_(pc.utf8_is_alpha(core), pc.invert(pc.match_substring_regex(core, "[^\\x00-\\x{ff}]")))
        key = pc.if_else(plain, pc.utf8_lower(core), words).dictionary_encode()
        out = np.zeros((len(words), 2), np.int64)
        out[:, 0] = self._places(key.dictionary)[key.indices.to_numpy()]
        ended = pc.and_(plain, pc.not_equal(core, words))
        # What stands after the letters; a letter is never a sign, so the longest match ends there.
        tail = pc.replace_substring_regex(words.filter(ended), LETTERS, "").dictionary_encode()
        out[ended.to_numpy(zero_copy_only=False), 1] = self._places(tail.dictionary)[tail.indices.to_numpy()]
        return out

    def _places(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words in the table, which learns those it lacks."""
        found = pc.index_in(words, value_set=self.words)
        lacking = pc.is_null(found)
        place = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        new = words.filter(lacking)
        if len(new):
            blobs = self._learn(new.to_pylist())
            place[lacking.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
            size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // self.flat.itemsize
            self.stop = np.concatenate((self.stop, len(self.flat) + np.cumsum(size)))
            self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(blobs), self.kind)))
            self.words = pa.concat_arrays([self.words, new])
        return place

    def _forget(self, used: np.ndarray) -> None:
        """A full table keeps the words of the last run."""
        used = used[used > 0]
        length = np.diff(self.stop, prepend=0)[used]
        stop = np.cumsum(length)
        self.flat = self.flat[np.repeat(self.stop[used] - stop, length) + np.arange(stop[-1] if len(stop) else 0)]
        self.stop = np.concatenate(([0], stop))
        self.words = pa.concat_arrays([pa.array([""], pa.string()), self.words.take(pa.array(used))])

    def _learn(self, words: list[str]) -> list[bytes]:
        out = [self._merged(w) for w in words]
        rest = [k for k, ids in enumerate(out) if ids is None]
        if rest:
            for k, e in zip(rest, self.tokenizer.encode_batch_fast([words[k] for k in rest], add_special_tokens=False)):
                out[k] = self.pack(e.ids)
        return out

    def _merged(self, word: str) -> bytes | None:
        """Ids of a lower-case word of letters up to U+00FF straight from the merge model; None for any other."""
        if not self.letter_runs or not word.isalpha() or not word.islower():
            return None
        if not word.isascii():
            if max(word) > "\xff":
                return None
            word = word.encode().decode("latin-1").translate(BYTE_CHARS)
        return self.pack([t.id for t in self.merge(word)])

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)


#: Signs that may follow a word (no apostrophe: it begins contractions; no "<": it begins special tokens).
SIGNS = ".,;:!?%$&*#|)\"-+/="
LETTERS = "^.*[^" + re.escape(SIGNS) + "]"
#: Byte-level BPE writes a byte as its own character if that is visible, else as one from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in set(_VISIBLE))}


def id_type(tokenizer) -> str:
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def runs(texts: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[pa.Array, list[int]]]:
    """Slices of at most about ``most`` bytes, with the text number of every entry; longer texts are cut at spaces."""
    size = pc.binary_length(texts).to_pylist()
    first = held = 0
    for k, n in enumerate(size):
        if k > first and (held + n > most or n > most):
            yield texts.slice(first, k - first), list(range(first, k))
            first, held = k, 0
        held += n
        if n > most:
            text, at = texts[k].as_py(), 0
            while at < len(text):
                cut = text.find(" ", at + most)
                yield pa.array([text[at:cut] if cut >= 0 else text[at:]], pa.string()), [k]
                at = cut + 1 if cut >= 0 else len(text)
            first, held = k + 1, 0
    if first < len(size):
        yield texts.slice(first), list(range(first, len(size)))


def token_blobs(encoder: WordEncoder, texts: pa.Array) -> list[bytes]:
    """Ids of every text with the end id, as bytes."""
    end = np.array([END_ID], encoder.kind).tobytes()
    out: list[list[bytes]] = [[] for _ in range(len(texts))]
    for part, owner in runs(texts):
        ids, bounds = encoder.encode(part)
        raw, bounds = memoryview(ids.tobytes()), (bounds * ids.itemsize).tolist()
        for k, a, b in zip(owner, bounds[:-1], bounds[1:]):
            out[k].append(raw[a:b])
    return [b"".join((*x, end)) for x in out]


TOKENS = "row long, doc_id string, n long, start long, sequence_id long, ids_crc32 long, ids binary"


def token_table(docs: DataFrame, tokenizer_path: str, window: int, keep_ids: bool) -> tuple[DataFrame, str, int]:
    """Every text tokenized once -> (TOKENS rows, id type, vocabulary size).

    Every whole window is a row of its own, in a sequence numbered by task and place (its
    ids, unsigned 32 bit, stand in it with ``keep_ids``).  What is left of a document, even
    nothing, is a row without a sequence, its ids of the id type.  Every task adds one row
    with n = -1, whose ``ids`` holds in how many of the task's documents each id stands.
    """
    from tokenizers import Tokenizer

    with open(tokenizer_path, encoding="utf-8") as f:
        text = f.read()
    tokenizer = Tokenizer.from_str(text)
    size, kind = tokenizer.get_vocab_size(), id_type(tokenizer)
    model = docs.sparkSession.sparkContext.broadcast(text)  # one vocabulary file
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.string()), *((c, pa.int64()) for c in ("n", "start", "sequence_id", "ids_crc32")), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, df, seen = WordEncoder(model.value), np.zeros(size, np.int64), np.zeros(size, bool)
        windows = 0
        for batch in batches:
            out, held = [], 0
            for row, doc_id, blob in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), token_blobs(encoder, batch.column("text"))):
                ids = np.frombuffer(blob, kind)
                seen[ids] = True
                own = np.flatnonzero(seen)
                df[own] += 1
                seen[own] = False
                cut = len(ids) - len(ids) % window
                for a in range(0, cut, window):
                    raw = ids[a : a + window].astype("<u4").tobytes()
                    out.append((row, doc_id, len(ids), a, (row >> 33 << 32) + windows, zlib.crc32(raw), raw if keep_ids else None))
                    windows, held = windows + 1, held + len(raw) * keep_ids
                    if held > RUN_BYTES:
                        yield table(out)
                        out, held = [], 0
                out.append((row, doc_id, len(ids), cut, None, None, blob[cut * ids.itemsize :]))
            yield table(out)
        yield table([(-1, None, -1, None, None, None, df.tobytes())])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), text_or_empty().alias("text"))
    return written(rows.mapInArrow(encode, TOKENS), "pack-tokens", "zstd"), kind, size


def document_frequencies(tokens: DataFrame, size: int) -> np.ndarray:
    """In how many documents each id stands: one number per vocabulary entry."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for part in batch["ids"]:
                df += np.frombuffer(part, np.int64)
        at = np.flatnonzero(df)
        yield pd.DataFrame({"id": at, "df": df[at]})

    out = np.zeros(size, np.int64)
    for r in tokens.filter("n = -1").select("ids").mapInPandas(count, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).collect():
        out[r["id"]] = r["df"]
    return out


#: Random directions of term space; tails that a leaf of the tree is drawn from, and of the whole tree at most.
DIRECTIONS, LEAF_SAMPLE, MOST_SAMPLE = 32, 24, 1 << 17
#: Tokens that are sketched at a time.
SKETCH_TOKENS = 1 << 19
#: Halvings from the root down at most, for samples that are cut very unevenly.
DEPTH = 64


def directions(size: int) -> np.ndarray:
    """A fixed random direction per vocabulary entry."""
    return np.random.default_rng(5).standard_normal((size, DIRECTIONS), np.float32)


def sketches(tails: list[np.ndarray], idf: np.ndarray, mean: float, plane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of BM25 term weights, projected, and smallest term hashes: one a tail, none empty."""
    out, least = np.zeros((len(tails), plane.shape[1]), np.float32), np.zeros(len(tails), np.int64)
    hashed = (np.arange(1, len(idf) + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    hashed = ((hashed ^ hashed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(1)).astype(np.int64)
    length = np.array([len(t) for t in tails], np.int64)
    stop = np.cumsum(length)
    first = 0
    while first < len(tails):  # runs of tails of about SKETCH_TOKENS
        last = max(first + 1, int(np.searchsorted(stop, (stop[first - 1] if first else 0) + SKETCH_TOKENS)))
        part, n = np.concatenate(tails[first:last]), length[first:last]
        key = np.repeat(np.arange(last - first, dtype=np.uint64), n) * np.uint64(len(idf)) + part
        key = key.astype(np.uint32) if (last - first) * len(idf) < 1 << 32 else key
        key.sort()
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        tf = np.diff(at, append=len(key))
        owner, term = np.divmod(key[at], key.dtype.type(len(idf)))
        owner, term = owner.astype(np.int64), term.astype(np.int64)
        norm = (K1 * (1 - B + B * n / mean))[owner]
        weight = (idf[term] * tf * (K1 + 1) / (tf + norm)).astype(np.float32)
        begin = np.searchsorted(owner, np.arange(last - first + 1)).tolist()
        for k, (x, y) in enumerate(zip(begin, begin[1:])):
            out[first + k] = weight[x:y] @ plane[term[x:y]]
        size = np.sqrt(np.add.reduceat(weight * weight, begin[:-1]))
        out[first:last] /= np.maximum(1e-9, size)[:, None]
        least[first:last] = np.minimum.reduceat(hashed[term], begin[:-1])
        first = last
    return out, least


def grown_tree(sample: np.ndarray, weight: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Halves of a weighted sample along its widest direction, again and again, down to ``leaves`` leaves.

    A sample without width (copies) is not cut any further.  The tree is plain arrays, which every task
    can read: by node its axis, its cut and its two kids (-1: a leaf)."""
    axes, cuts, kids = [], [], []

    def grow(x: np.ndarray, weight: np.ndarray, leaves: int, depth: int) -> int:
        at = len(kids)
        axes.append(np.zeros(sample.shape[1], np.float32))
        cuts.append(0.0)
        kids.append((-1, -1))
        if leaves > 1 and len(x) > 1 and depth:
            spread = x - x.mean(0)
            axis = np.linalg.eigh(spread.T @ spread)[1][:, -1]
            place = x @ axis
            order = np.argsort(place, kind="stable")
            run = np.cumsum(weight[order])
            cut = float(place[order[np.searchsorted(run, run[-1] * (leaves // 2) / leaves)]])
            low = place <= cut
            if np.ptp(place) > 1e-4 and not low.all():
                share = min(leaves - 1, max(1, round(leaves * float(weight[low].sum() / run[-1]))))
                axes[at], cuts[at] = axis, cut
                kids[at] = (grow(x[low], weight[low], share, depth - 1), grow(x[~low], weight[~low], leaves - share, depth - 1))
        return at

    grow(sample, weight, leaves, DEPTH)
    return np.array(axes), np.array(cuts), np.array(kids)


def leaf_of(tree: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Leaf number of every vector."""
    axes, cuts, kids = tree
    out, stack = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
    while stack:
        at, rows = stack.pop()
        if kids[at][0] < 0:
            out[rows] = at
        elif len(rows):
            low = x[rows] @ axes[at] <= cuts[at]
            stack += [(kids[at][0], rows[low]), (kids[at][1], rows[~low])]
    return out


def by_content(tails: DataFrame, kind: str, idf: np.ndarray, mean: float, shards: int, shard_tokens: int) -> DataFrame:
    """Tails (row, doc_id, n, ids) with their ``shard``, a number from 0 on: like tails share one.

    Tails go to the leaf of a tree that halves a sample of them.  A leaf of far more than a
    shard's tokens is cut by its tails' smallest term hash, which near copies mostly share, and
    what is still too large (copies) by row, so no shard holds much more than 1.5 x
    ``shard_tokens``, or one tail.  The driver sees the sample only.
    """
    spark = tails.sparkSession
    if shards == 1:
        return tails.withColumn("shard", F.lit(0).cast("long"))
    shared = spark.sparkContext.broadcast((idf, directions(len(idf))))

    def sketch(batch) -> tuple[list[int], np.ndarray, np.ndarray]:
        found = [np.frombuffer(t, kind) for t in batch.column("ids").to_pylist()]
        return [len(t) for t in found], *sketches(found, shared.value[0], mean, shared.value[1])

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, x, _ = sketch(batch)
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array([v.tobytes() for v in x], pa.binary())], names=["length", "x"])

    want, n = min(MOST_SAMPLE, shards * LEAF_SAMPLE), tails.count()
    some = tails.filter(F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, want / max(1, n)) * (1 << 30)))
    sample = some.select("row", "ids").mapInArrow(drawn, "length long, x binary").collect()
    x = np.frombuffer(b"".join(r["x"] for r in sample), np.float32).reshape(-1, DIRECTIONS)
    tree = spark.sparkContext.broadcast(grown_tree(x, np.array([r["length"] for r in sample], np.float64), min(shards, max(1, len(x) // 4))))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, x, least = sketch(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in (length, leaf_of(tree.value, x), least))], names=[*batch.schema.names, "length", "leaf", "least"])

    known = written(tails.mapInArrow(placed, "row long, doc_id string, n long, ids binary, length long, leaf long, least long"), "pack-tails", "zstd")

    def cuts(tokens):
        return F.greatest(F.lit(1).cast("long"), F.round(tokens / shard_tokens).cast("long"))

    # Shards are numbered leaf by leaf: one row a leaf (the tree bounds them), then one a part inside its leaf.
    leaves = known.groupBy("leaf").agg(cuts(F.sum("length")).alias("parts"))
    cut = known.join(leaves, "leaf").withColumn("part", F.pmod(F.xxhash64("least"), F.col("parts")))
    parts = written(cut.groupBy("leaf", "part").agg(cuts(F.sum("length")).alias("pieces")), "pack-parts")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = parts.groupBy("leaf").agg(F.sum("pieces").alias("n")).select("leaf", F.coalesce(F.sum("n").over(before(Window.orderBy("leaf"))), zero).alias("start"))
    inside = parts.withColumn("inside", F.coalesce(F.sum("pieces").over(before(Window.partitionBy("leaf").orderBy("part"))), zero))
    numbered = inside.join(starts, "leaf").select("leaf", "part", (F.col("start") + F.col("inside")).alias("first"), "pieces")
    cut = cut.join(numbered, ["leaf", "part"])
    return cut.select("row", "doc_id", "n", "ids", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("pieces"))).alias("shard"))


class Index:
    """BM25 inverted index of one shard: postings as flat arrays by term."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        n = len(tails)
        length = np.array([len(t) for t in tails])
        wide = np.uint32 if len(idf) * n < 1 << 32 else np.uint64  # short keys sort faster
        key = np.concatenate(tails).astype(wide) * wide(n) + np.repeat(np.arange(n, dtype=wide), length)
        key.sort()
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        tf = np.diff(first, append=len(key))
        term, doc = np.divmod(key[first], wide(n))
        self.doc = doc.astype(np.int64)
        norm = K1 * (1 - B + B * length / mean)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.doc])
        first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
        self.start, self.stop = first, np.concatenate((first[1:], [len(term)]))
        slot = np.repeat(np.arange(len(first)), self.stop - first)
        order = np.argsort(doc.astype(np.uint16) if n <= 1 << 16 else doc, kind="stable")
        bounds = np.searchsorted(self.doc[order], np.arange(n + 1))
        self.terms = [slot[order[a:b]] for a, b in zip(bounds[:-1], bounds[1:])]
        self.n = n

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every tail for the words of the seed's tail."""
        a, b = self.start[self.terms[seed]].tolist(), self.stop[self.terms[seed]].tolist()
        docs = np.concatenate([self.doc[x:y] for x, y in zip(a, b)])
        return np.bincount(docs, np.concatenate([self.weight[x:y] for x, y in zip(a, b)]), self.n)


def fill_windows(tails: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (tail number, start in the tail, length); every token lies in one piece."""
    index = Index(tails, idf, mean)
    left = np.array([len(t) for t in tails])
    begin = np.zeros(len(tails), np.int64)
    out = []
    seeds = np.argsort(-left, kind="stable").tolist()
    for seed in seeds:
        if not left[seed]:
            continue
        pieces, room = [(seed, int(begin[seed]), int(left[seed]))], window - int(left[seed])
        left[seed] = 0
        free = np.flatnonzero(left)
        if room and len(free):
            score = index.scores(seed)[free]
            for k in free[np.argsort(-score, kind="stable")].tolist():
                take = min(room, int(left[k]))
                pieces.append((k, int(begin[k]), take))
                begin[k] += take
                left[k] -= take
                room -= take
                if not room:
                    break
        out.append(pieces)
    return out


def even_ends(windows: list[list[tuple[int, int, int]]], window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Full windows as they are; a short one as sequences of falling powers of two, which need no padding."""
    for pieces in windows:
        left = sum(n for _, _, n in pieces)
        if left >= window:
            yield pieces
            continue
        pieces = list(pieces)[::-1]
        while left:
            room = 1 << left.bit_length() - 1
            left -= room
            out = []
            while room:
                k, at, n = pieces.pop()
                out.append((k, at, min(n, room)))
                if n > room:
                    pieces.append((k, at + room, n - room))
                room -= out[-1][2]
            yield out


PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, keep_ids: bool = False) -> DataFrame:
    """documents -> pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and
    ids, little-endian unsigned 32 bit, with ``keep_ids``).

    A null text counts as empty; an empty text is its end id alone.  Null and repeated
    doc_ids are packed like any others.  Empty input gives no pieces.
    """
    tokens, kind, size = token_table(docs, tokenizer_path, window, keep_ids)
    rows = tokens.filter("n >= 0 AND sequence_id IS NULL")
    stats = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("n") % window).alias("tails"), F.max("row").alias("row")).first()
    n_docs, shards = stats["docs"], max(1, -(-(stats["tails"] or 0) // shard_tokens))
    tasks = ((stats["row"] or 0) >> 33) + 1  # sequences of whole windows are numbered by these
    df = document_frequencies(tokens, size)
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    mean = max(1.0, (stats["tails"] or 0) / max(1, n_docs))
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # one number per vocabulary entry

    def fill(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("row", ignore_index=True)
        base, out = tasks + int(shard["shard"].iloc[0]) << 32, []
        doc_id, total = shard["doc_id"].tolist(), shard["n"].tolist()
        tails = [np.frombuffer(t, kind) for t in shard["ids"]]
        for seq, pieces in enumerate(even_ends(fill_windows(tails, shared.value, mean, window), window)):
            offset = 0
            for k, at, length in pieces:
                ids = tails[k][at : at + length].astype("<u4").tobytes()
                out.append((doc_id[k], total[k] - len(tails[k]) + at, length, zlib.crc32(ids), total[k], base + seq, offset, ids if keep_ids else None))
                offset += length
        return pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])

    whole = tokens.filter("sequence_id IS NOT NULL").select(
        "doc_id", "start", F.lit(window).cast("long").alias("length"), "ids_crc32", F.col("n").alias("doc_tokens"), "sequence_id", F.lit(0).cast("long").alias("offset"), "ids"
    )
    dealt = by_content(rows.filter(F.col("start") < F.col("n")).select("row", "doc_id", "n", "ids"), kind, idf, mean, shards, shard_tokens)
    pieces = whole.unionAll(dealt.groupBy("shard").applyInPandas(fill, PIECES))
    back = pieces.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    return back if keep_ids else back.drop("ids")
