"""Cross-tokenizer alignment against whole-text encoding and plain loops."""

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessera.llm import alignment
from tests_llm_data import DOCS, awkward, empty, sentence

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "Plain words, and more.",
    " leading and trailing ",
    "   ",
    "\n",
    " \n\t x\n\n\ny \t",
    "tabs\tand hard spaces   wide",
    "it's we'll <|endoftext|> <s> </s> <unk> <0x41>",
    "under▁score",
    "你好 \U0001f600 café é ｆｕｌｌ",
    "a\x1c b!\x1c c\x0b d\x85e",
    "x" * 700,
    "1234567890 3.14 --- ... !!!  ??",
    "null\x00byte",
    "the theme thesis then the theme",
]


def brute(texts):
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    x, y = alignment.byte_tokens(json.load(open(A))), alignment.piece_tokens(sp)
    docs, counts = [], Counter()
    for t in texts:
        a, b = (tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)) if t else ([], [])
        raw = (" " + (t or "")).encode()
        if b"".join(x[i] for i in a) != raw or b"".join(y[i] for i in b) != raw:
            a, b = [], []
        spans = lambda ids, of: list(zip(np.cumsum([0] + [len(of[i]) for i in ids])[:-1].tolist(), np.cumsum([len(of[i]) for i in ids]).tolist()))
        sa, sb = spans(a, x), spans(b, y)
        links = [(a[i], b[j]) for i, (p, q) in enumerate(sa) for j, (r, s) in enumerate(sb) if p < s and r < q]
        ends = sorted({q for _, q in sa} & {q for _, q in sb})
        groups = [
            ",".join(str(k) for k, (_, q) in zip(a, sa) if lo < q <= hi) + "|" + ",".join(str(k) for k, (_, q) in zip(b, sb) if lo < q <= hi)
            for lo, hi in zip([0] + ends, ends)
        ]
        docs.append((len(a), len(b), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        counts.update(links)
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(top.get(j, 0), n)
    return [(n, m, g, len(k), sum(counts[p] == top[p[1]] for p in k), sum(counts[p] for p in k), h) for n, m, g, k, h in docs]


def table(df):
    cols = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((r["doc_id"], *(r[c] for c in cols)) for r in df.collect())


@pytest.mark.parametrize("chunk,piece", [(1 << 23, 1 << 16), (50, 7)])
def test_alignment_brute_force(spark, chunk, piece):
    texts = [*ODD, None, "", *(sentence(k, 60) for k in range(6)), sentence(1, 60)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS).repartition(3)
    got = table(alignment.align_tokenizers(docs, A, B, chunk, piece))
    assert got == [(k, *w) for k, w in enumerate(brute(texts))]


def test_alignment_on_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [r for r in rows if len(r[1] or "") < 900]
    got = table(alignment.align_tokenizers(spark.createDataFrame(rows, "doc_id long, text string"), A, B))
    assert got == [(k, *w) for (k, _), w in zip(rows, brute([t for _, t in rows]))]


def test_alignment_awkward_rows(spark):
    odd = awkward(spark)
    got = alignment.align_tokenizers(odd, A, B).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["n_links"] == by_id[3]["n_a"] == 0 and by_id[2]["groups_sha256"] == ""
    assert by_id[4]["n_a"] > 0 and by_id[7]["n_links"] > 30_000
    assert alignment.align_tokenizers(empty(spark), A, B).collect() == []


def test_long_texts_are_cut_into_runs(monkeypatch):
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        encoder = alignment.Encoder(f.read(), g.read())
    text = " " + " ".join(ODD) + "\n" + sentence(3, 500)
    whole = encoder.units(text)
    encoder.learn()
    assert encoder.bad.any() and not encoder.bad.all()
    monkeypatch.setattr(alignment, "RUN_CHARS", 37)
    assert encoder.units(text).tolist() == whole.tolist()


def test_cuts_are_equal_work_on_the_merge_path():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(1, 200, rng.integers(0, 90))) for _ in range(2))
        i, j = alignment.cuts(a, b, 11)
        assert (np.diff(i + j)[:-1] == 11).all() and i[-1] == len(a) and j[-1] == len(b)
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        for p, q in zip(i, j):
            assert sum(k == 0 for _, k in merged[: p + q]) == p


def test_units_by_either_way_are_the_same():
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        encoder = alignment.Encoder(f.read(), g.read())
    units = [u for t in ODD for u in alignment.UNIT.findall(" " + t)] + [" Émile's", " naïve--", "\x0c\x0b", " ", "\n", " 's'S 1a2"]
    encoder.ranked, ranked = None, encoder.ranked
    slow = encoder._byte_ids(units)
    encoder.ranked = ranked
    assert ranked and all((x == y).all() for x, y in zip(slow, encoder._byte_ids(units)))
    ids, n = encoder._piece_ids(units)
    one = [encoder._piece_ids([u])[0].tolist() for u in units]
    assert n.tolist() == [len(x) for x in one] and ids.tolist() == sum(one, [])
