"""Personal data in whole texts: base patterns and a skip-chain CRF on top.

Base spans come from four fixed patterns.  The patterns are matched on short regions
(round an '@', or runs of digits and separators), which finds exactly what a scan
of the whole text finds, in linear time even on very long texts.

The skip-chain CRF labels *active* tokens: white-space-separated tokens that hold a digit
or an '@'.  Every other token can only be "none", so the chain falls apart at those
and the factors on active tokens are all there is.  Factors: one per token (its
shape), one per pair of neighbouring tokens, and one per pair of distant tokens that are
repeated or similar (same letters and digits, same last seven digits, same mail name).
Each occurrence is linked to the next one only, so a value that occurs n times adds
n - 1 links.  Factors are trained piecewise: Spark counts shapes and label pairs over all
documents, with base spans as labels, and the tables of counts (bounded by
shapes and label pairs) become log potentials.  Loopy sum-product messages run over all
documents of an Arrow batch at once until they have settled, so that evidence reaches the
last of many repeats.

A span is added where a token's belief names a kind, strongly, and skip links lead from
it, or from its neighbours in the same span, to a base span of that kind in the same
document.  So a text without
base spans gets none.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import text_or_empty

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: Messages run until none changes by more than this in a round.
TOLERANCE = 1e-7
#: Rounds that a link of the longest path may take to settle under the damping, and rounds besides.
ROUNDS_A_LINK, ROUNDS = 3, 50
DAMPING = 0.3
BELIEF = 0.8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_NUMBERS = re.compile(r"[0-9+][0-9\x20().+-]*")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
_EDGE = ".,;:!?\"'<>[]{}|`*"


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        total += _DOUBLED[ord(c) - 48] if k % 2 else ord(c) - 48
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of every base span, by start, then kind."""
    out = [(a, b, 0) for a, b in _emails(text)]
    for region in _NUMBERS.finditer(text):
        a, part = region.start(), region.group()
        if len(part) < 7:
            continue
        for m in _IP.finditer(part):
            if all(map(_byte, m.groups())):
                out.append((a + m.start(), a + m.end(), 1))
        for m in _CARD.finditer(part):
            if len(m.group()) >= 14:
                digits = "".join(_DIGITS.findall(m.group()))
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    out.append((a + m.start(), a + m.end(), 2))
        if "+" in part:
            for m in _PHONE.finditer(part):
                if 10 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                    out.append((a + m.start(), a + m.end(), 3))
    out.sort(key=lambda s: (s[0], s[2]))
    return out


_HINT = re.compile(r"[0-9@]")


def active_tokens(text: str) -> list[tuple[int, int]]:
    """White-space-separated tokens that hold an ASCII digit or an '@'."""
    out, m = [], _HINT.search(text)
    while m:
        a = b = m.start()
        low = out[-1][1] if out else 0
        while a > low and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        out.append((a, b))
        m = _HINT.search(text, b)
    return out


def shape(token: str) -> str:
    """What the token factor sees: signs, letters, digit count in classes."""
    digits = sum(map(len, _DIGITS.findall(token)))
    size = next(k for k, most in enumerate((0, 1, 3, 4, 6, 7, 9, 13, 19, 1 << 60)) if digits <= most)
    flags = "".join(c if c in token else "" for c in "@+(-")
    return f"{size}{flags}{'.' * min(3, token.strip(_EDGE).count('.'))}{'a' if any(c.isalpha() for c in token) else ''}"


def similar_keys(token: str) -> list[str]:
    """Keys under which repeated or similar tokens meet."""
    core = token.strip(_EDGE).lower()
    plain = "".join(c for c in core if c.isalnum())
    digits = "".join(_DIGITS.findall(core))
    keys = [f"w{plain}"] if len(plain) >= 4 else []
    if len(digits) >= 7 and not any(c.isalpha() for c in core):
        keys.append(f"d{digits[-7:]}")
    name = core.partition("@")[0]
    if len(name) >= 4 and not name.isdigit() and any(c.isalpha() for c in name):
        keys.append(f"m{name}")
    return keys


class Graph:
    """Active tokens of many texts with their links, as flat arrays."""

    def __init__(self) -> None:
        self.label: list[int] = []  # by base spans
        self.shape: list[str] = []
        self.place: list[tuple[int, int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, text: str, spans: list[tuple[int, int, int]]) -> tuple[int, int]:
        first = len(self.label)
        seen: dict[str, int] = {}
        at, before = 0, None
        for a, b in active_tokens(text):
            n = len(self.label)
            token = text[a:b]
            while at < len(spans) and spans[at][1] <= a:
                at += 1
            label, k = NONE, at
            while k < len(spans) and spans[k][0] < b:
                if spans[k][1] > a:
                    label = spans[k][2]
                    break
                k += 1
            self.label.append(label)
            self.shape.append(shape(token))
            self.place.append((a, b))
            if before is not None and text[before:a].isspace():
                self.chain.append((n - 1, n))
            before = b
            keys = similar_keys(token)
            for s, e, _ in spans[at : k + 1 if label != NONE else at]:
                digits = "".join(_DIGITS.findall(text[s:e])) if s < a < e <= b else ""
                if len(digits) >= 7:  # a value written with spaces meets its other forms in its last token
                    keys.append(f"d{digits[-7:]}")
            for key in keys:
                if key in seen and seen[key] != n:
                    self.skip.append((seen[key], n))
                seen[key] = n
        return first, len(self.label)


COUNTS = "factor string, a string, y int, z int, n long"


def _counts(graph: Graph) -> list[tuple]:
    """Rows of COUNTS: shapes by label, label pairs on chain and on skip links."""
    c: Counter = Counter()
    c.update(("shape", s, y, -1) for s, y in zip(graph.shape, graph.label))
    for name, pairs in (("chain", graph.chain), ("skip", graph.skip)):
        for i, j in pairs:
            c[name, "", graph.label[i], graph.label[j]] += 1
    return [(*k, n) for k, n in c.items()]


class Potentials:
    """Log potentials from the counted tables, add-one smoothed."""

    def __init__(self, counts: list) -> None:
        k = NONE + 1
        self.shapes: dict[str, np.ndarray] = {}
        self.pair = {name: np.ones((k, k)) for name in ("chain", "skip")}
        for r in counts:
            if r["factor"] == "shape":
                self.shapes.setdefault(r["a"], np.ones(k) / k)[r["y"]] += r["n"]
            else:
                self.pair[r["factor"]][r["y"], r["z"]] += r["n"]
        self.shapes = {s: np.log(v / v.sum()) for s, v in self.shapes.items()}
        for name, m in self.pair.items():
            m = m + m.T
            p = m / m.sum()
            self.pair[name] = np.log(p / np.outer(p.sum(1), p.sum(0)))
        self.unknown = np.zeros(k)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def longest_path(n: int, links: list[tuple[int, int]]) -> int:
    """Links on the longest way forward through the tokens of a batch; links go from earlier to later tokens."""
    far = [0] * n
    for i, j in sorted(links, key=lambda x: x[1]):
        far[j] = max(far[j], far[i] + 1)
    return max(far, default=0)


def beliefs(graph: Graph, pot: Potentials) -> np.ndarray:
    """Marginals per token by damped loopy sum-product; base tokens are clamped."""
    n, k = len(graph.label), NONE + 1
    unary = np.array([pot.shapes.get(s, pot.unknown) for s in graph.shape]).reshape(n, k)
    label = np.array(graph.label, np.int64)
    held = label != NONE
    unary[held] = -30.0
    unary[held, label[held]] = 0.0
    one_way = [(i, j, pot.pair["chain"]) for i, j in graph.chain] + [(i, j, pot.pair["skip"]) for i, j in graph.skip]
    if not one_way:
        return np.exp(unary - _lse(unary, 1)[:, None])
    src = np.array([i for i, _, _ in one_way] + [j for _, j, _ in one_way])
    dst = np.array([j for _, j, _ in one_way] + [i for i, _, _ in one_way])
    table = np.stack([p for _, _, p in one_way] * 2)
    table[len(one_way) :] = table[len(one_way) :].transpose(0, 2, 1)
    back = np.concatenate((np.arange(len(one_way)) + len(one_way), np.arange(len(one_way))))
    msg = np.zeros((len(src), k))
    live, moved = np.arange(len(src)), np.ones(n, bool)
    total = unary.copy()
    for _ in range(ROUNDS + ROUNDS_A_LINK * longest_path(n, graph.chain + graph.skip)):
        new = _lse((total[src[live]] - msg[back[live]])[:, :, None] + table[live], 1)
        new -= _lse(new, 1)[:, None]
        step = (1 - DAMPING) * (new - msg[live])
        msg[live] += step
        np.add.at(total, dst[live], step)
        changed = np.abs(step).max(1) > TOLERANCE
        if not changed.any():
            break
        # Only messages out of tokens that just heard something new, and those still on their way, change next.
        moved[:] = False
        moved[dst[live[changed]]] = True
        again = np.zeros(len(src), bool)
        again[live[changed]] = True
        live = np.flatnonzero(again | moved[src])
    total = unary.copy()
    np.add.at(total, dst, msg)
    return np.exp(total - _lse(total, 1)[:, None])


def added_spans(graph: Graph, bounds: list[tuple[int, int]], texts: list[str], pot: Potentials) -> list[list[tuple[int, int, int]]]:
    """Per text the spans that label consistency adds to its base spans."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in bounds]
    if not graph.skip or all(y == NONE for y in graph.label):
        return out
    near: dict[int, list[int]] = {}
    for i, j in graph.skip:
        near.setdefault(i, []).append(j)
        near.setdefault(j, []).append(i)
    chained: dict[int, list[int]] = {}
    for i, j in graph.chain:
        chained.setdefault(i, []).append(j)
        chained.setdefault(j, []).append(i)
    marginal = beliefs(graph, pot)
    best, sure = marginal.argmax(1), marginal.max(1) >= BELIEF
    named = [int(y) for y in graph.label]
    reach = [i for i, y in enumerate(named) if y != NONE]
    while reach:  # along skip links from base spans outwards, and along the chain from there
        i = reach.pop()
        beside = chained.get(i, []) if graph.label[i] == NONE else []
        for j in near.get(i, []) + beside:
            if named[j] == NONE and sure[j] and best[j] == named[i]:
                named[j] = named[i]
                reach.append(j)
    linked = set(graph.chain)
    for t, (first, stop) in enumerate(bounds):
        i = first
        while i < stop:
            if graph.label[i] != NONE or named[i] == NONE:
                i += 1
                continue
            j = i
            while j + 1 < stop and graph.label[j + 1] == NONE and named[j + 1] == named[i] and (j, j + 1) in linked:
                j += 1
            a, b = graph.place[i][0], graph.place[j][1]
            while a < b and texts[t][a] in _EDGE:
                a += 1
            while b > a and texts[t][b - 1] in _EDGE:
                b -= 1
            if a < b:
                out[t].append((a, b, named[i]))
            i = j + 1
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def label_counts(docs: DataFrame) -> DataFrame:
    """Shape, chain and skip counts over all documents: one small row per table cell."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            graph = Graph()
            for text in batch["text"]:
                if _HINT.search(text):
                    graph.add(text, base_spans(text))
            yield pd.DataFrame(_counts(graph), columns=["factor", "a", "y", "z", "n"])

    rows = docs.select(text_or_empty().alias("text")).mapInPandas(count, COUNTS)
    return rows.groupBy("factor", "a", "y", "z").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> Potentials:
    return Potentials(label_counts(docs).collect())  # bounded by shapes x labels


def _spans_of(texts: list[str], pot: Potentials) -> list[tuple[list, list]]:
    graph, bounds, base = Graph(), [], []
    for text in texts:
        spans = base_spans(text) if _HINT.search(text) else []
        base.append(spans)
        # Without a base span nothing can be added, and texts share no factors.
        bounds.append(graph.add(text, spans) if spans else (len(graph.label),) * 2)
    more = added_spans(graph, bounds, texts, pot)
    return [(b, sorted(b + m, key=lambda s: (s[0], s[2], s[1]))) for b, m in zip(base, more)]


FOUND = "struct<n_email:long,n_ip:long,n_card:long,n_phone:long,base_sha256:string,spans:string>"


def find_pii(docs: DataFrame, pot: Potentials | None = None) -> DataFrame:
    """documents -> doc_id, base counts per kind, base_sha256, spans; one row a document row.

    Null texts count as empty.  Offsets are code points, ends exclusive.  Spans of
    different kinds may overlap; all are listed, by start, then kind.  Null doc_ids stay null, repeated rows come back
    as often as they stand, texts of any length are read whole, other columns are ignored whatever their names.  Empty
    input gives no rows.
    """
    pot = pot or train(docs)

    @pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for base, every in _spans_of(texts.tolist(), pot):
            kinds = [k for _, _, k in base]
            rows.append((*(kinds.count(k) for k in range(len(KINDS))), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", find(text_or_empty()).alias("found")).select("doc_id", "found.*")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Every span replaced by its kind in angle brackets; overlapping spans become one, named after the first."""
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k]}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame) -> DataFrame:
    """documents with every span redacted and n_chars set anew; null texts stay null.  Long texts are redacted whole;
    repeated rows and further columns stay as they are; empty input gives no rows."""
    pot = train(docs)

    @pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        texts = texts.tolist()
        return pd.Series([redact(t, every) if every else t for t, (_, every) in zip(texts, _spans_of(texts, pot))])

    text = F.when(F.col("text").isNotNull(), clean(text_or_empty()))
    out = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
