"""The backoff automaton against a plain dictionary model."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import language_model as lm
from tests_llm_data import awkward, empty, sentence

FIELDS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows):
    """(doc_id, text) rows -> the expected columns, one tuple a row."""
    out_fold = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    texts = [[*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "</s>"] for _, t in rows]
    c, pairs = Counter(), Counter()
    for words, out in zip(texts, out_fold):
        if not out:
            c.update(words)
            pairs.update(zip(["</s>", *words], words))
    n, v, followers = sum(c.values()), len(c), Counter(h for h, _ in pairs)
    times = Counter(pairs.values())
    d = times[1] / (times[1] + 2 * times[2]) if times[1] + times[2] else 0.5
    p = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))

    def step(h, w):
        if not c[h]:
            return p(w)
        fail = d * followers[h] / c[h]
        if pairs[h, w]:
            return max(pairs[h, w] - d, 0) / c[h] + fail * p(w)
        return fail * p(w) if fail else p(w)

    res = []
    for words, out in zip(texts, out_fold):
        base, score = sum(math.log10(p(w)) for w in words), sum(math.log10(step(h, w)) for h, w in zip(["</s>", *words], words))
        res.append((out, len(words), sum(c[w] > 0 for w in words), n, base, score))
    return res


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:4] == w[:4] and np.allclose(g[4:], w[4:], rtol=1e-9, atol=1e-9)


def scored(docs, **kw):
    return [(r["doc_id"], r["held_out"], *(r[f] for f in FIELDS)) for r in lm.score_texts(docs, lm.fold(), **kw).collect()]


@pytest.mark.parametrize("chunk,range_", [(5_000_000, 1 << 22), (37, 25)])
def test_scores_brute_force(spark, chunk, range_):
    # "the" is hot: a third of all tokens.
    texts = [None, "", " \n", "The the THE", "Éa É a\x0bb", *(sentence(k % 9, 30) for k in range(40)), *(" the ".join(sentence(k, 20).split()) for k in range(20))]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(scored(docs, chunk_tokens=chunk, range_tokens=range_))
    same([g[1:] for g in got], brute(rows))


def test_weights_out_of_a_state_sum_to_one():
    c, t = np.array([4, 5, 3, 0]), np.array([2, 3, 1, 0])
    model = lm.Model(12, 3, 4, 2)
    for h, arcs in ((0, {1: 3, 2: 1}), (1, {0: 1, 1: 2, 2: 2}), (2, {0: 3})):
        label = np.arange(4)
        steps = lm.traverse(model, np.full(4, h), label, np.array([arcs.get(w, 0) for w in range(4)]), c, t)
        assert abs((10.0**steps).sum() - 1) < 1e-12


def test_hot_words_are_spread_and_found(spark):
    words = ["the " + w for w in sentence(1, 300).split()]
    docs = spark.createDataFrame([(k, " ".join(words[k::7])) for k in range(7)], "doc_id long, text string")
    table = lm.token_table(docs, lm.fold(), 50)
    heavy = {r["h"]["word"] for r in table.selectExpr("explode(heavy) AS h").collect()}
    import xxhash

    assert int(np.uint64(xxhash.xxh64_intdigest(b"the")).astype(np.int64)) in heavy
    chunk = next(r for r in table.filter("chunk IS NOT NULL").toPandas().itertuples() if r.n >= 50)
    hot = np.array([xxhash.xxh64_intdigest(b"the")], np.uint64)
    arcs = lm.Arcs(chunk, 16, hot)
    per_range = defaultdict(int)
    for s, r in zip(arcs.state, arcs.to):
        per_range[r] += arcs.words[s] == hot[0]
    assert max(per_range.values()) <= sum(per_range.values()) / 3


def test_packing_of_rising_numbers():
    rng = np.random.default_rng(2)
    for x in (np.zeros(0, np.uint64), np.array([0], np.uint64), np.sort(rng.integers(0, 1 << 63, 1000, np.uint64)), np.arange(5, dtype=np.uint64)):
        assert lm.unpacked(lm.packed(x)).tolist() == x.tolist()


def test_awkward_rows(spark):
    odd = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[2], round(x[-1], 6))
    got = sorted(scored(odd), key=key)
    want = sorted(((d, *w) for (d, _), w in zip(rows, brute(rows))), key=key)
    same([g[1:] for g in got], [w[1:] for w in want])
    assert lm.score_texts(empty(spark), lm.fold()).collect() == []
    held = lm.score_texts(odd, lm.F.lit(True)).collect()
    assert all(r["score"] == r["base_score"] == 0 and r["train_tokens"] == r["n_known"] == 0 for r in held)


def test_beats_the_base_on_texts_that_repeat(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = lm.score_texts(docs, lm.fold()).collect()
    for fold in (False, True):
        part = [r for r in got if r["held_out"] == fold]
        assert sum(r["score"] for r in part) > sum(r["base_score"] for r in part)
