"""Language-model scoring with a weighted backoff automaton.

The model is a smoothed bigram model of the training documents as an automaton: a state for every
known word and one for the text boundary, an arc for every bigram seen in training, and a
failure arc from each state to the root, whose arcs are all words.  With counts c, distinct
followers T and the absolute discount D = n1 / (n1 + 2 n2) of the corpus' counts of counts,

    root arc      P(w)     = (c(w) + 0.5) / (N + 0.5 (V + 1))
    arc h -> w    P(w | h) = max(c(hw) - D, 0) / c(h) + D T(h) / c(h) P(w)
    failure arc   weight   = D T(h) / c(h),  then the root's arc

so the weights out of a state sum to 1.  A text is traversed once, from the boundary to the end
token; a word that training lacks leads to the root.

The automaton is never whole in one place.  Texts are written in chunks of a bounded number of
tokens.  A chunk publishes its distinct words and bigrams, cut into ranges by hash; a range sums
them over all chunks and answers each chunk with what it asked for, the part of the automaton its texts
can reach.  A context that holds much of the corpus (at most ``HOT_SHARE`` words can) is spread
over all ranges by the following word.  Words are known by their 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty, written

#: Tokens of a chunk; bytes of text that are split at a time; tokens whose bigrams one range sums.
CHUNK_TOKENS, RUN_BYTES, RANGE_TOKENS = 2_500_000, 1 << 22, 1 << 22
#: A word above 1 / HOT_SHARE of all tokens is spread over the ranges.
HOT_SHARE = 1024
#: Place 0 of every chunk's list: the text boundary, as a token the end, as a context the start.
BOUNDARY = b" "
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Places(dict):
    """Word -> its place in the chunk's list."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def split(text: str) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size; A-Z lower-cased."""
    raw, at = text.encode("utf-8", "surrogatepass").lower(), 0
    while at < len(raw):
        cut = len(raw) if at + RUN_BYTES >= len(raw) else at + RUN_BYTES
        while cut < len(raw) and raw[cut] not in b" \t\n\r\x0b\x0c":
            cut += 1
        yield raw[at:cut].split()
        at = cut


class _Chunk:
    def __init__(self, lead: bytes = BOUNDARY) -> None:
        self.places, self.tokens, self.rows, self.sizes, self.train, self.n = _Places(), [], [], [], [], 0
        self.places[BOUNDARY]
        self.lead = self.places[lead]

    def add(self, row: int, train: bool, words: list[bytes]) -> None:
        self.tokens.append(np.fromiter(map(self.places.__getitem__, words), np.uint32, len(words)))
        self.rows.append(row)
        self.sizes.append(len(words))
        self.train.append(train)
        self.n += len(words)

    def row(self, number: int) -> dict:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.places), np.uint64, len(self.places))
        tokens = np.concatenate(self.tokens)
        count = np.bincount(tokens, np.repeat(self.train, self.sizes), len(hashes)).astype(np.int64)
        heavy = np.flatnonzero(count * 2 * HOT_SHARE >= len(tokens))
        raw = lambda x, kind: np.asarray(x, kind).tobytes()
        return {
            "chunk": number,
            "lead": self.lead,
            "docs": raw(self.rows, "<i8"),
            "sizes": raw(self.sizes, "<i8"),
            "train": raw(self.train, "u1"),
            "tokens": raw(tokens, "<u4"),
            "words": raw(hashes, "<u8"),
            "n": len(tokens),
            "n_train": int(count.sum()),
            "heavy": [{"word": int(hashes[k].astype(np.int64)), "c": int(count[k])} for k in heavy],
        }


_HEAVY = pa.list_(pa.struct([("word", pa.int64()), ("c", pa.int64())]))
SCHEMA = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.string()), ("held_out", pa.bool_()), ("chunk", pa.int64()), ("lead", pa.int64())]
    + [(c, pa.binary()) for c in ("docs", "sizes", "train", "tokens", "words")]
    + [("n", pa.int64()), ("n_train", pa.int64()), ("heavy", _HEAVY)]
)
TOKENS = "row long, doc_id string, held_out boolean, chunk long, lead long, docs binary, sizes binary, train binary, tokens binary, words binary, n long, n_train long, heavy array<struct<word: long, c: long>>"


def token_table(docs: DataFrame, held_out, chunk_tokens: int) -> DataFrame:
    """The text pass, written: one row a document (row, doc_id, held_out) and one a chunk of tokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, chunk = TaskContext.get().partitionId() << 32, 0, _Chunk()
        for batch in batches:
            rows, ids, held, texts = (batch.column(k) for k in range(4))
            yield pa.RecordBatch.from_arrays([rows, ids, held, *(pa.nulls(len(rows), f.type) for f in list(SCHEMA)[3:])], schema=SCHEMA)
            for row, out, text in zip(rows.to_pylist(), held.to_pylist(), texts):
                last = BOUNDARY
                for words in chain(split(text.as_py()), [[BOUNDARY]]):
                    for k in range(0, len(words), chunk_tokens):
                        part = words[k : k + chunk_tokens]
                        chunk.add(row, not out, part)
                        last = part[-1]
                        if chunk.n >= chunk_tokens:
                            yield pa.RecordBatch.from_pylist([chunk.row(base + made)], SCHEMA)
                            chunk, made = _Chunk(last), made + 1
        if chunk.n:
            yield pa.RecordBatch.from_pylist([chunk.row(base + made)], SCHEMA)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), held_out.alias("held_out"), text_or_empty().alias("text"))
    return written(rows.mapInArrow(encode, TOKENS), "lm-tokens", "zstd")


def packed(x: np.ndarray) -> bytes:
    """Rising unsigned numbers as differences in as few whole bytes as all need (that width comes first)."""
    step = np.diff(x, prepend=x.dtype.type(0))
    width = max(1, (int(step.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    flat = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, raw[0])
    wide = np.zeros((len(flat), 8), np.uint8)
    wide[:, : raw[0]] = flat
    return np.cumsum(wide.view("<u8").reshape(-1), dtype=np.uint64)


class Arcs:
    """The distinct words and bigrams of one chunk, in the order in which it publishes them.

    ``place`` words and ``state``/``label`` bigrams (places in the chunk's list) stand by range; a hot state
    stands in every range in which it has a follower."""

    def __init__(self, chunk, ranges: int, hot: np.ndarray) -> None:
        self.tokens = np.frombuffer(chunk.tokens, "<u4").astype(np.uint64)
        self.words = np.frombuffer(chunk.words, "<u8")
        self.docs, self.sizes = np.frombuffer(chunk.docs, "<i8"), np.frombuffer(chunk.sizes, "<i8")
        self.train = np.repeat(np.frombuffer(chunk.train, "u1"), self.sizes)
        key = np.concatenate(([np.uint64(chunk.lead)], self.tokens[:-1])) << np.uint64(32) | self.tokens
        arcs, self.arc = np.unique(key, return_inverse=True)  # self.arc: the bigram that each token ends
        state, label = (arcs >> np.uint64(32)).astype(np.int64), (arcs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        m = np.bincount(self.arc, self.train, len(arcs)).astype(np.uint32)
        self.is_hot = np.isin(self.words, hot)
        mixed = np.where(self.is_hot[state], self.words[state] ^ self.words[label] * _MIX, self.words[state])
        to = self._range(mixed, ranges)
        order = np.lexsort((self.words[label], self.words[state], to))
        self.order, self.state, self.label, self.m, self.to = order, state[order], label[order], m[order], to[order]
        self.first = np.searchsorted(self.to, np.arange(ranges + 1))
        # Words: each in its own range, hot ones besides where a follower of theirs stands.
        own = self._range(self.words, ranges)
        spread = self.is_hot[self.state]
        entry = np.unique(np.concatenate((own.astype(np.uint64) << np.uint64(32) | np.arange(len(own), dtype=np.uint64), self.to[spread].astype(np.uint64) << np.uint64(32) | self.state[spread].astype(np.uint64))))
        at, place = (entry >> np.uint64(32)).astype(np.int64), (entry & np.uint64(0xFFFFFFFF)).astype(np.int64)
        order = np.lexsort((self.words[place], at))
        self.place, self.home = place[order], own[place[order]] == at[order]
        self.word_first = np.searchsorted(at[order], np.arange(ranges + 1))
        self.count = np.bincount(self.tokens.astype(np.int64), self.train, len(self.words)).astype(np.int64)

    @staticmethod
    def _range(x: np.ndarray, ranges: int) -> np.ndarray:
        return ((x * _MIX >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)

    def published(self, r: int) -> dict | None:
        """What range ``r`` gets: words with their counts and numbers of followers, followers by 6 bytes of their
        hash (of a state's followers two share them with p < T^2 / 2^49), training counts of the bigrams."""
        a, b, x, y = self.word_first[r], self.word_first[r + 1], self.first[r], self.first[r + 1]
        if a == b:
            return None
        words = self.words[self.place[a:b]]
        followers = np.bincount(np.searchsorted(words, self.words[self.state[x:y]]), minlength=b - a)
        count = np.where(self.home[a:b], self.count[self.place[a:b]], 0)
        return {
            "words": packed(words),
            "count": count.astype("<i8").tobytes(),
            "followers": followers.astype("<u4").tobytes(),
            "labels": np.ascontiguousarray(self.words[self.label[x:y]]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
            "m": self.m[x:y].astype("<u4").tobytes(),
        }


def _publish(chunks: DataFrame, ranges: int, hot: np.ndarray) -> DataFrame:
    schema = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), *((c, pa.binary()) for c in ("words", "count", "followers", "labels", "m"))])

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pandas().itertuples():
                arcs, out, held = Arcs(chunk, ranges, hot), [], 0
                for r in range(ranges):
                    row = arcs.published(r)
                    if row:
                        out.append({"range": r, "chunk": chunk.chunk, **row})
                        held += len(row["labels"])
                    if held > RUN_BYTES or r == ranges - 1:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, held = [], 0

    return chunks.mapInArrow(publish, "range long, chunk long, words binary, count binary, followers binary, labels binary, m binary")


ANSWER = "chunk long, range long, count binary, followers binary, more binary, word long, c long, t long, v long, n1 long, n2 long"


def _summed(hot: np.ndarray):
    """One range: sums over all chunks -> an answer a chunk (counts c and followers T of its words, by how much
    the count of each bigram exceeds its own), hot words' partial c and T, and statistics."""

    def total(group: pd.DataFrame) -> pd.DataFrame:
        words = [unpacked(w) for w in group["words"]]
        n_words, followers = [len(w) for w in words], [np.frombuffer(x, "<u4") for x in group["followers"]]
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        count = np.bincount(place, np.concatenate([np.frombuffer(x, "<i8") for x in group["count"]]), len(distinct)).astype(np.int64)
        wide = np.zeros((sum(len(x) for x in group["labels"]) // 6, 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(group["labels"]), np.uint8).reshape(-1, 6)
        label, m = wide.view("<u8").reshape(-1), np.frombuffer(b"".join(group["m"]), "<u4").astype(np.int64)
        state = np.repeat(place, np.concatenate(followers))
        order = np.lexsort((label, state))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (state[order][1:] != state[order][:-1]) | (label[order][1:] != label[order][:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        sums = np.bincount(number, m, int(fresh.sum())).astype(np.int64)
        seen = sums > 0
        t = np.bincount(state[order][fresh][seen], minlength=len(distinct))
        more = sums[number] - m
        rows, a, x = [], 0, 0
        for chunk, n, f in zip(group["chunk"], n_words, followers):
            k = int(f.sum())
            rows.append({"chunk": chunk, "range": group["range"].iloc[0], "count": count[place[a : a + n]].astype("<i8").tobytes(), "followers": t[place[a : a + n]].astype("<i8").tobytes(), "more": more[x : x + k].astype("<i8").tobytes()})
            a, x = a + n, x + k
        warm = np.isin(distinct, hot)
        rows += [{"word": int(w.astype(np.int64)), "c": int(c), "t": int(f)} for w, c, f in zip(distinct[warm], count[warm], t[warm])]
        rows.append({"v": int(((count > 0) & ~warm).sum()), "n1": int((sums == 1).sum()), "n2": int((sums == 2).sum())})
        kinds = (x.split() for x in ANSWER.split(", "))
        return pd.DataFrame({c: pd.array([r.get(c) for r in rows], "Int64" if kind == "long" else "object") for c, kind in kinds})

    return total


class Model:
    """The corpus-wide numbers of the automaton: N, V and the discount, and the hot words' counts."""

    def __init__(self, n: int, v: int, n1: int, n2: int) -> None:
        self.n, self.v = n, v
        self.discount = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5

    def root(self, c: np.ndarray) -> np.ndarray:
        """Weight of the root's arc of a word with count ``c``."""
        return (c + 0.5) / (self.n + 0.5 * (self.v + 1))


def traverse(model: Model, state: np.ndarray, label: np.ndarray, c_arc: np.ndarray, c: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log10 weight of the step from each state over each label.

    ``c_arc``: bigram counts; ``c``, ``t``: counts and followers by place.  A step takes the state's own
    arc if there is one, else its failure arc and the root's; the root (a state never seen) has no other."""
    root, context = model.root(c[label]), c[state]
    at_root = context == 0
    fail = model.discount * t[state] / np.maximum(context, 1)
    arc = np.maximum(c_arc - model.discount, 0) / np.maximum(context, 1)
    return np.log10(np.where(at_root, root, np.where(c_arc > 0, arc + fail * root, np.where(fail > 0, fail, 1.0) * root)))


def score_texts(docs: DataFrame, held_out, chunk_tokens: int = CHUNK_TOKENS, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """documents -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row a document.

    ``held_out``: a boolean column, true for documents that the model doesn't learn from.  Words are
    runs of anything but ASCII white space, A-Z in lower case; the end counts as a token.  A
    null or empty text is its end alone.  Null and repeated doc_ids are rows like any others; texts of any
    length are taken whole, in chunks.  Without training documents every probability is 1.
    Columns besides doc_id and text are ignored.  Empty input gives no rows.
    """
    table = token_table(docs, held_out, chunk_tokens)
    chunks = table.filter("chunk IS NOT NULL")
    sizes = chunks.agg(F.sum("n").alias("n"), F.sum("n_train").alias("train")).first()
    n, ranges = sizes["train"] or 0, max(1, math.ceil((sizes["n"] or 0) / range_tokens))
    # A word above 1 / HOT_SHARE of the tokens reaches half of that in the chunks where it is heavy: at most 2 * HOT_SHARE words.
    heavy = chunks.select(F.explode("heavy").alias("h")).groupBy("h.word").agg(F.sum("h.c").alias("c")).filter(F.col("c") * 2 * HOT_SHARE >= max(1, n))
    hot = np.sort(np.array([r["word"] for r in heavy.select("word").collect()], np.int64).view(np.uint64))
    parts = chunks.select("chunk", "lead", "docs", "sizes", "train", "tokens", "words")
    answers = written(_publish(parts, ranges, hot).groupBy("range").applyInPandas(_summed(hot), ANSWER), "lm-answers", "zstd")
    stats = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("v", "n1", "n2")]).first()
    warm = {r["word"]: (r["c"], r["t"]) for r in answers.filter("word IS NOT NULL").groupBy("word").agg(F.sum("c").alias("c"), F.sum("t").alias("t")).collect()}
    model = Model(n, stats["v"] + sum(c > 0 for c, _ in warm.values()), stats["n1"], stats["n2"])
    hot_c, hot_t = (np.array([warm.get(int(w.astype(np.int64)), (0, 0))[k] for w in hot], np.int64) for k in (0, 1))

    def score(group: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        out = []
        answer = answer.sort_values("range")
        joined = {c: np.frombuffer(b"".join(answer[c]), "<i8") for c in ("count", "followers", "more")}
        for chunk in group.itertuples():
            arcs = Arcs(chunk, ranges, hot)
            c, t = np.zeros(len(arcs.words), np.int64), np.zeros(len(arcs.words), np.int64)
            c[arcs.place], t[arcs.place] = joined["count"], joined["followers"]
            if len(hot):
                at = np.searchsorted(hot, arcs.words[arcs.is_hot])
                c[arcs.is_hot], t[arcs.is_hot] = hot_c[at], hot_t[at]
            step = np.empty(len(arcs.order))
            step[arcs.order] = traverse(model, arcs.state, arcs.label, arcs.m + joined["more"], c, t)
            tokens, owner = arcs.tokens.astype(np.int64), np.repeat(np.arange(len(arcs.docs)), arcs.sizes)
            add = lambda x: np.bincount(owner, x, len(arcs.docs))  # noqa: B023, E731
            out.append(pd.DataFrame({"row": arcs.docs, "n_tokens": arcs.sizes, "n_known": add(c[tokens] > 0).astype(np.int64), "base_score": add(np.log10(model.root(c))[tokens]), "score": add(step[arcs.arc])}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("row", "n_tokens", "n_known", "base_score", "score")})

    asked = answers.filter("chunk IS NOT NULL").select("chunk", "range", "count", "followers", "more")
    scored = parts.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInPandas(score, "row long, n_tokens long, n_known long, base_score double, score double")
    sums = scored.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    rows = table.filter("row IS NOT NULL").select("row", "doc_id", "held_out").join(sums, "row")
    return rows.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )


def fold(remainder: int = 1, folds: int = 5, col: str = "doc_id"):
    """Whether the CRC-32 of the id as text leaves ``remainder``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % folds == remainder
