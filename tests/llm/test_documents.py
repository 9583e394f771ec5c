"""Document operators on awkward rows and against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import blob_secrets, graph, licenses, mixing, packing, pii, quality, queries, simhash
from tests_llm_data import DOCS, awkward, empty, sentence

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    return awkward(spark)


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- licenses -----------------------------------------------------------------


def test_licenses_awkward(spark, odd):
    got = rows(licenses.scan_licenses(odd, licenses.NOTICES))
    assert [(r["doc_id"], r["template"], r["containment"]) for r in got] == [(1, "mit", 1.0)]
    assert rows(licenses.scan_licenses(empty(spark), licenses.NOTICES)) == []
    assert rows(licenses.scan_licenses(odd, [])) == []
    with pytest.raises(ValueError):
        licenses.scan_licenses(odd, [("blank", " .")])


def brute_licenses(text, templates):
    terms = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    words, out = terms(text), {}
    for name, notice in templates:
        s = licenses.Shape(len(terms(notice)))
        sh = lambda w: {tuple(w[i : i + s.width]) for i in range(max(1, len(w) - s.width + 1))}  # noqa: E731, B023
        want = sh(terms(notice))
        shares = [len(want & sh(words[a : a + s.window + s.width - 1])) / len(want) for a in range(0, len(words), s.step)]
        good = [x for x in shares if x >= licenses.CONTAINMENT]
        if good:
            out[name] = (len(good), max(good))
    return out


def test_licenses_brute_force_with_changed_words(spark):
    rng = random.Random(3)
    texts = []
    for k in range(60):
        body = sentence(k, 50).split()
        notice = licenses.NOTICES[k % len(licenses.NOTICES)][1].split()
        if k % 3 == 0 and len(notice) > 20:
            notice[rng.randrange(len(notice))] = "changed"
        at = rng.randrange(len(body))
        texts.append(" ".join(body[:at] + notice + body[at:] + notice * (k % 2)))
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)
    got = {(r["doc_id"], r["template"]): (r["n_windows"], r["containment"]) for r in rows(licenses.scan_licenses(docs, licenses.NOTICES))}
    want = {(k, n): v for k, t in enumerate(texts) for n, v in brute_licenses(t, licenses.NOTICES).items()}
    assert got == want and len(want) >= 60


def test_licenses_many_shingles_stay_out_of_the_plan(spark):
    long = [(f"t{k}", sentence(k, 300 + k)) for k in range(8)]
    texts = [sentence(99, 40) + " " + t + " " + sentence(98, 40) for _, t in long]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)
    got = licenses.scan_licenses(docs, long)
    want = {(k, n): v for k, t in enumerate(texts) for n, v in brute_licenses(t, long).items()}
    assert {(r["doc_id"], r["template"]): (r["n_windows"], r["containment"]) for r in rows(got)} == want and len(want) >= 8
    assert licenses.table_longs(1) == 16 and licenses.table_longs(1000) == 2048


# --- packing ------------------------------------------------------------------


def test_short_windows_end_at_powers_of_two():
    windows = [[(0, 0, 2000), (1, 5, 48)], [(2, 0, 700), (3, 9, 300), (4, 1, 7)]]
    got = list(packing.even_ends(windows))
    assert got[0] == windows[0]
    assert [sum(n for _, _, n in s) for s in got[1:]] == [512, 256, 128, 64, 32, 8, 4, 2, 1]
    assert got[1:3] == [[(2, 0, 512)], [(2, 512, 188), (3, 9, 68)]]
    flat = sorted((k, a, n) for s in got[1:] for k, a, n in s)
    assert sum(n for _, _, n in flat) == 1007 and list(packing.even_ends([])) == []


def check_pieces(docs, pieces, window):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.word_tokenizer())
    by_seq, by_doc = {}, {}
    for p in pieces:
        by_seq.setdefault(p["sequence_id"], []).append(p)
        by_doc.setdefault(p["doc_id"], []).append(p)
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
    want = Counter()
    for doc_id, text in docs:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want[doc_id, len(ids)] += 1
        if sum(d == doc_id for d, _ in docs) == 1:
            at = 0
            for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(ids)
                assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
                at += p["length"]
            assert at == len(ids)
    assert sum(p["length"] for p in pieces) == sum(n * c for (_, n), c in want.items())
    return by_seq


def test_packing_awkward(spark, odd):
    got = rows(packing.pack(odd, queries.word_tokenizer()))
    check_pieces([(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()], got, packing.WINDOW)
    assert rows(packing.pack(empty(spark), queries.word_tokenizer())) == []


def test_packing_whole_table_in_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows(packing.pack(docs, queries.word_tokenizer(), shard_tokens=40_000, keep_ids=True))
    seqs = check_pieces([(r["doc_id"], r["text"]) for r in docs.collect()], got, packing.WINDOW)
    assert len({s >> 32 for s in seqs}) > 2
    full = [sum(p["length"] for p in s) for s in seqs.values()]
    assert all(n & (n - 1) == 0 for n in full) and full.count(packing.WINDOW) * packing.WINDOW > 0.9 * sum(full)  # no padding
    assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] for p in got)


def test_packing_takes_lexical_neighbours():
    rng = np.random.default_rng(1)
    tails = [rng.integers(t * 100, t * 100 + 100, 500).astype("<u2") for t in (0, 1, 2, 0, 1, 2, 0, 1, 2, 0, 1, 2)]
    idf = np.full(400, 1.0)
    for window in packing.fill_windows(tails, idf, 500.0, 2000):
        assert len({k % 3 for k, _, _ in window}) == 1
    brute = packing.Index(tails, idf, 500.0).scores(0)
    for d, t in enumerate(tails):
        tf = Counter(t.tolist())
        score = sum(tf[w] * 2.2 / (tf[w] + 1.2) for w in set(tails[0].tolist()) if w in tf)
        assert brute[d] == pytest.approx(score)


def test_packing_shards_are_cut_by_content(spark):
    rng = np.random.default_rng(3)
    topics = [["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(60)] for _ in range(12)]
    docs = [(k, " ".join(rng.choice(topics[k % 12], 100)), "en", "s", 1) for k in range(600)]
    docs += [(k, docs[0][1], "en", "s", 1) for k in range(600, 900)]  # a crowd of copies
    table = spark.createDataFrame(docs, DOCS).repartition(4)
    got = rows(packing.pack(table, queries.word_tokenizer(), shard_tokens=20_000))
    seqs = check_pieces([(k, t) for k, t, *_ in docs], got, packing.WINDOW)
    size = Counter()
    for s, pieces in seqs.items():
        size[s >> 32] += sum(p["length"] for p in pieces)
    assert len(size) >= 10 and max(size.values()) <= 2 * 20_000
    topic = lambda p: 0 if int(p["doc_id"]) >= 600 else int(p["doc_id"]) % 12
    same = [max(Counter(map(topic, s)).values()) / len(s) for s in seqs.values() if len(s) > 1]
    assert sum(same) > 0.9 * len(same)


def test_word_encoder_equals_whole_text_encoding():
    import pyarrow as pa
    from tokenizers import Tokenizer

    model = open(queries.word_tokenizer(), encoding="utf-8").read()
    tok, enc = Tokenizer.from_str(model), packing.WordEncoder(model, words=50)
    rng = random.Random(0)
    texts = ["", " \n ", "aé, Éa! ª. ñ- b, ö", "don't 'S we'LL <|endoftext|>x <|startoftext|> İΣ ΑΣ' 12 3½ 你好 ﬁ\x0b\x1c\x85 a\tb", "a... b.,c (d) \"e\"! f!! g's."]
    texts += ["ab.,", "ab\".c", "ªº. µ, ÿ!", "İ. Σ, ſ"]
    texts += ["".join(rng.choice("ab É.ñ'!,9 \n-<|>sç") for _ in range(60)) for _ in range(300)]
    got = packing.token_blobs(enc, pa.array(texts, pa.string()))
    for text, blob in zip(texts, got):
        assert np.frombuffer(blob, "<u2").tolist() == tok.encode(text, add_special_tokens=False).ids + [1], text


def test_long_texts_are_cut_into_runs():
    import pyarrow as pa

    texts = ["a b", "x" * 50, "one two three " * 40, "", "end"]
    parts = list(packing.runs(pa.array(texts), 100))
    back = [""] * len(texts)
    for part, owner in parts:
        for k, t in zip(owner, part.to_pylist()):
            back[k] += (" " if back[k] else "") + t
    assert [b.split() for b in back] == [t.split() for t in texts]


# --- personal data -------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(s[::-1])) % 10 == 0


def plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(t)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), m.end(), 2) for m in CARD.finditer(t) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


@pytest.mark.parametrize("alphabet", ["a.@1 +-()2390 %_\n", "1.2 +-0255(45", "@@a.b-"])
def test_base_spans_equal_plain_patterns(alphabet):
    rng = random.Random(5)
    for _ in range(20_000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_base_spans_stay_linear_on_long_runs():
    for t in ("a" * 300_000 + "@", "@a" * 100_000, "1" * 300_000, "1." * 150_000, "+1" * 100_000, "+1(" * 100_000):
        pii.base_spans(t)


def test_pii_awkward(spark, odd):
    got = rows(pii.find_pii(odd))
    assert len(got) == odd.count()
    none = hashlib.sha256(b"").hexdigest()
    for r in got:
        if r["doc_id"] == 8:
            assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 0, 0, 0)
            assert r["base_sha256"] == hashlib.sha256(b"email:5:31").hexdigest() and r["spans"].startswith("email:5:31")
        else:
            assert (r["base_sha256"], r["spans"]) == (none, "")
    assert rows(pii.find_pii(empty(spark))) == []


def test_skip_links_spread_labels_only_from_base_spans(spark):
    pot = pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))

    def found(text):
        return [(text[a:b], pii.KINDS[k]) for a, b, k in pii._spans_of([text], pot)[0][1]]

    assert ("(988) 555-2485", "phone") in found("Call +1 (988) 555-2485 now. Later (988) 555-2485, again.")
    assert ("4041.8949.7460.8795", "card") in found("card 4041894974608795 and 4041.8949.7460.8795 ok")
    assert found("no mail: 4041.8949.7460.8795 and (988) 555-2485 or bosbt.42") == []


def test_evidence_reaches_the_last_of_many_repeats():
    graph = pii.Graph()
    text = " y ".join(["4111111111111111"] + ["4111/1111/1111/1111"] * 50)
    spans = pii.base_spans(text)
    bounds = [graph.add(text, spans)]
    graph.skip = list(dict.fromkeys(graph.skip))  # a pair may meet under two keys; one link is the harder case
    pot, card = pii.Potentials([]), pii.KINDS.index("card")
    prior = np.full(pii.NONE + 1, 1e-9)
    prior[card], prior[pii.NONE] = 0.02, 0.98
    pot.shapes = {s: np.log(prior) for s in graph.shape}
    pot.pair["skip"] = np.full((pii.NONE + 1, pii.NONE + 1), -5.0)
    pot.pair["skip"][card, card], pot.pair["skip"][pii.NONE, pii.NONE] = 4.0, 0.0
    assert len(spans) == 1 and len(graph.skip) >= 50
    exact = pii.beliefs(graph, pot)[:, card]
    assert exact.min() >= pii.BELIEF
    added = pii.added_spans(graph, bounds, [text], pot)[0]
    assert [c for *_, c in added].count(card) == 50
    assert len({(a, b) for a, b, _ in added}) == len(added)


def test_beliefs_match_enumeration():
    pot = pii.Potentials([])
    rng = np.random.default_rng(2)
    pot.pair = {n: rng.normal(size=(5, 5)) for n in ("chain", "skip")}
    g = pii.Graph()
    g.label, g.shape = [0, pii.NONE, pii.NONE, pii.NONE], ["a", "b", "c", "d"]
    g.chain, g.skip = [(0, 1), (2, 3)], [(1, 2)]  # a tree: message passing is exact
    pot.shapes = {s: rng.normal(size=5) for s in "abcd"}
    total = np.zeros((4, 5))
    for y in np.ndindex(5, 5, 5, 5):
        if y[0] != 0:
            continue
        e = sum(pot.shapes[s][v] for s, v in zip("bcd", y[1:])) + pot.pair["chain"][y[0], y[1]] + pot.pair["chain"][y[2], y[3]] + pot.pair["skip"][y[1], y[2]]
        for i in range(4):
            total[i, y[i]] += np.exp(e)
    old, pii.ROUNDS = pii.ROUNDS, 60
    try:
        got = pii.beliefs(g, pot)
    finally:
        pii.ROUNDS = old
    assert np.allclose(got[1:], (total / total.sum(1, keepdims=True))[1:], atol=1e-6)


def test_redaction_keeps_the_rest(spark, odd):
    out = rows(pii.redact_documents(odd))
    assert len(out) == odd.count() and list(out[0]) == odd.columns
    by = {r["doc_id"]: r for r in out}
    assert by[8]["text"].startswith("mail <email> or") and by[8]["n_chars"] == len(by[8]["text"])
    assert by[2]["text"] is None and by[5]["text"] == sentence(5)


# --- mixing --------------------------------------------------------------------


def water_fill(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: float(weights[k % len(weights)]) for k, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > most * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        open_ -= set(over)
        left -= sum(target[s] for s in over)
    return target


@pytest.mark.parametrize("digits", [0, 2, None])
def test_mix_targets_and_budgets(spark, digits):
    rng = random.Random(4)
    items = [(k, rng.choice(["b", "a", "Z", "é", None, "c"]), rng.choice([0, 1, 5, 50, 400])) for k in range(300)] + [(1000, "a", 7)] * 40
    df = spark.createDataFrame(items, "doc_id long, source string, size long")
    got = rows(mixing.mix(df, digits=digits))
    again = rows(mixing.mix(df.repartition(7), digits=digits))
    order = lambda x: sorted(map(repr, x))
    assert order(got) == order(again) and len(got) == len(items)
    sizes = Counter()
    for _, s, n in items:
        sizes[s] += n
    want = water_fill(sizes)
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) < 1 + 1e-6


def test_mix_awkward(spark, odd):
    got = rows(mixing.mix(odd.withColumn("size", mixing.word_count())))
    assert len(got) == odd.count()
    assert rows(mixing.mix(empty(spark).withColumn("size", F.lit(1)))) == []
    docs = rows(mixing.mixed_documents(odd))
    assert list(docs[0]) == odd.columns
    words = Counter()
    for r in docs:
        words[r["source"]] += len(r["text"].split())
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    assert words == taken and mixing.mixed_documents(empty(spark)).count() == 0


def test_many_copies_of_one_row_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 10)
    df = spark.createDataFrame([(1, "a b c", "en", "s", 5)] * 95 + [(2, "d e", "en", "t", 3)], DOCS)
    got = rows(mixing.mix(df.withColumn("size", mixing.word_count())))
    assert len(got) == 96 and sum(r["taken"] for r in got) == sum(len(r["text"].split()) for r in rows(mixing.mixed_documents(df)))


# --- secrets -------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_secrets(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_secrets_brute_force(spark):
    rng = random.Random(6)
    bits = ["password", "Token", "api_key", "APIKEY", '"', "'", " ", "=", ":", "abc123", "AKIA", "ABCDEFGHIJ123456", "0123456789abcdef", "deadbeef", "x", "\n", "ſecret", "é", "secret"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)
    for r in rows(blob_secrets.scan_documents(docs)):
        want = plain_secrets(texts[r["doc_id"]])
        assert r["spans"] == want and r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == (len(want.split(",")) if want else 0)


def test_secrets_awkward(spark, odd):
    got = rows(blob_secrets.scan_documents(odd))
    assert len(got) == odd.count() and sum(r["n_assign"] for r in got) == 1
    assert rows(blob_secrets.scan_documents(empty(spark))) == []


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    v1 = spark.createDataFrame([("a", 1, "password=secret1"), ("b", 1, "password=secret1"), ("c", 1, None)], "path string, version int, text string")
    v2 = v1.unionByName(spark.createDataFrame([("a", 2, "token: abcdef99"), ("d", 1, "password=secret1")], v1.schema))
    n = len(blob_secrets.RULES)
    blob_secrets.scan_versions(v1, ledger)
    assert spark.read.parquet(ledger).count() == 2 * n
    got = {(r["path"], r["version"]): r["findings"] for r in rows(blob_secrets.scan_versions(v2, ledger))}
    assert spark.read.parquet(ledger).count() == 3 * n
    assert got == {("a", 1): {"assign": "0:16"}, ("b", 1): {"assign": "0:16"}, ("c", 1): {}, ("a", 2): {"assign": "0:15"}, ("d", 1): {"assign": "0:16"}}
    newer = tuple(blob_secrets.Rule(r.name, 2, lambda t: [(0, 1)] if t else []) if r.name == "hex" else r for r in blob_secrets.RULES)
    got = {(r["path"], r["version"]): r["findings"] for r in rows(blob_secrets.scan_versions(v2, ledger, newer))}
    assert spark.read.parquet(ledger).count() == 3 * n + 3 and got["a", 1] == {"assign": "0:16", "hex": "0:1"} and got["c", 1] == {}


# --- SimHash -------------------------------------------------------------------


def plain_fingerprint(text, width=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), seed=42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    for text in [None, "", " ", "A b", "a B c", sentence(1), sentence(2, 100), "É é Ü the THE the the"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    hashed = spark.createDataFrame([("abc def ghi",)], "t string").select(F.xxhash64("t")).first()[0]
    assert hashed % (1 << 64) == xxhash.xxh64_intdigest(b"abc def ghi", seed=42)


def plain_components(fps):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("bucket, floor", [(1, 2), (4, 6), (64, 256)])
def test_links_and_components_brute_force(spark, bucket, floor, monkeypatch):
    """Also with crowded buckets: near copies that share a segment, chains, and far fingerprints; and with heavy keys."""
    monkeypatch.setattr(simhash.links, "__defaults__", (2, bucket))
    monkeypatch.setattr(simhash, "HEAVY_FLOOR", floor)
    monkeypatch.setattr(graph, "FLOOR", floor)
    rng = random.Random(bucket)
    fps = []
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            fps.append(at)
            for _ in range(rng.choice([0, 1, 2, 2, 3, 5])):
                at ^= 1 << rng.randrange(64)
    ids = rng.sample(range(10_000), len(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame(list(zip(ids, signed)), "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in rows(simhash.near_duplicates(df))}
    roots = plain_components(fps)
    want = {}
    for i, r in zip(ids, roots):
        want.setdefault(r, []).append(i)
    assert got == {i: min(g) for g in want.values() for i in g}


def test_hub_is_spread(spark):
    """A node with 100,000 leaves meets its minimum where its links lie, not in one task."""
    n = 100_000
    edges = spark.range(0, n, 1, 8).select(F.lit(0).cast("long").alias("a"), (F.col("id") + 1).alias("b"))
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    placed = graph.join_by_key(both, least, "u", 2 * n).groupBy((F.col("u") == 0).alias("hub"), F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in placed) == 2 * n
    assert max(r["count"] for r in placed if r["hub"]) <= n // 8
    got = graph.components(edges).agg(F.count(F.lit(1)).alias("n"), F.max("component").alias("c")).first()
    assert (got["n"], got["c"]) == (n + 1, 0)


def test_simhash_awkward(spark, odd):
    got = rows(simhash.simhash_dedup(odd))
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[2]["fingerprint"] == "0" * 16 and {by[k]["component_id"] for k in (2, 3, 4)} == {2}
    assert by[6]["component_id"] == 5 and all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in got)
    assert rows(simhash.simhash_dedup(empty(spark))) == []
    kept = rows(simhash.keep_one(odd))
    assert list(kept[0]) == odd.columns
    ids = [r["doc_id"] for r in kept]
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 7, 8, 9, 10] and ids.count(None) == 2
    assert simhash.keep_one(empty(spark)).count() == 0


# --- quality -------------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r for r in rows(quality.classify(docs, labels))}
    assert len(got) == docs.count()
    known = [(got[r["doc_id"]], r["quality"]) for r in labels.collect()]
    held = [(g, y) for g, y in known if g["held_out"]]
    assert len(held) > 50 and np.mean([g["predicted"] == y for g, y in held]) > 0.95
    assert np.mean([g["predicted"] for g, y in known if y == 1]) > 0.98  # clean documents stay
    for i, g in got.items():
        assert g["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.7)


def test_quality_never_reads_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in rows(quality.classify(docs, labels))}
    b = {r["doc_id"]: r["score"] for r in rows(quality.classify(docs, flipped))}
    assert max(abs(a[i] - b[i]) for i in a) < 1e-9


def test_qda_is_the_density_ratio(spark):
    rng = np.random.default_rng(0)
    d = len(quality.STATS)
    x = np.concatenate([rng.normal(0, 1, (300, d)), rng.normal(0.7, 0.5, (500, d))])
    y = [0] * 300 + [1] * 500
    df = spark.createDataFrame([(r.tolist(), k) for r, k in zip(x, y)], "x array<double>, y int")
    m = quality.fit_qda(df, own=0, pooled=0, few=0, floor=0)
    want = []
    for k in (0, 1):
        c, mu = np.cov(x[np.array(y) == k].T, bias=True), x[np.array(y) == k].mean(0)
        z = x - mu
        want.append(np.log(len(z) and y.count(k) / 800) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("nd,de,ne->n", z, np.linalg.inv(c), z))
    assert np.allclose(m.scores(x), 1 / (1 + np.exp(np.clip(want[0] - want[1], -700, 700))), atol=1e-6)


def test_quality_awkward(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (5, None, 0), (7, 3, 0)], "doc_id long, quality int, toxic int")
    got = rows(quality.classify(odd, labels))
    assert len(got) == odd.count() and len({r["score"] for r in got}) == 1  # too few labels: one score for all
    none = spark.createDataFrame([], labels.schema)
    assert {r["score"] for r in rows(quality.classify(odd, none))} == {0.5}
    assert rows(quality.classify(empty(spark), labels)) == []
    assert quality.keep_good(odd, none, 0.4).columns == odd.columns and quality.keep_good(odd, none, 0.4).count() == odd.count()


def test_spaced_values_meet_their_other_forms(spark):
    filler = " ".join(f"word{k}x" for k in range(30))
    texts = [f"card 4041 8949 7460 8795 {filler} again 4041.8949.7460.8795 end", f"call +44 20 7946 0958 {filler} or 02079460958 now"]
    agreeing = [f"{x} {filler} and {x} {filler} and {x}" for x in ("4041894974608795", "+442079460958", "bosbt.42@mail8.example.com", "10.20.30.40")] * 60
    docs = spark.createDataFrame([(k, t, "en", "a", 1) for k, t in enumerate(texts + agreeing)], DOCS)
    found = {r["doc_id"]: r["spans"] for r in rows(pii.find_pii(docs))}
    for k, (text, kind, form) in enumerate(zip(texts, ("card", "phone"), ("4041.8949.7460.8795", "02079460958"))):
        got = found[k]
        at = text.index(form)
        assert f"{kind}:{at}:{at + len(form)}" in got, got


def test_private_keys_of_every_form():
    body = "MIIEpAIBAAKCAQEA1234\nabcd+/==\n"
    for text, want in [
        (f"x -----BEGIN RSA PRIVATE KEY-----\n{body}-----END RSA PRIVATE KEY----- y", lambda t: (2, len(t) - 2)),
        (f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n{body}-----END RSA PRIVATE KEY-----", lambda t: (0, len(t))),
        (f"-----BEGIN PRIVATE KEY-----\n{body}\nnot a key any more", lambda t: (0, t.index("not") - 3 + 1)),
    ]:
        spans = blob_secrets._pem(text)
        assert len(spans) == 1 and spans[0][0] == want(text)[0], (text, spans)
        if "END" in text:
            assert spans[0] == want(text)
        else:
            assert text[: spans[0][1]].rstrip().endswith("abcd+/==") or text[spans[0][0] : spans[0][1]].count("abcd") == 1
    two = "-----BEGIN PRIVATE KEY-----\nAAAA\n-----BEGIN PRIVATE KEY-----\nBBBB\n-----END PRIVATE KEY-----"
    assert [two[a:b].count("BEGIN") for a, b in blob_secrets._pem(two)] == [1, 1]
    assert blob_secrets._pem("-----BEGIN CERTIFICATE-----\nAAAA") == []


def test_versions_with_clashing_columns(spark):
    from tessera.session import scratch_path

    rows_ = [(1, "token=abcdef123", 7, 8, 9)]
    df = spark.createDataFrame(rows_, "path long, text string, blob__ long, found_blob__ long, findings__ long")
    got = blob_secrets.scan_versions(df, scratch_path(spark, "clash-ledger")).collect()[0]
    assert (got["blob__"], got["found_blob__"], got["findings__"]) == (7, 8, 9) and "assign" in got["findings"]


def test_near_duplicate_plans_stay_small(spark, monkeypatch):
    """The driver holds one plan at a time: a star step or a match does not repeat the steps before it."""
    seen = {}

    def noted(df, name, codec="snappy"):
        seen[name] = max(seen.get(name, 0), df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return common.written(df, name, codec)

    from tessera.llm import common

    monkeypatch.setattr(simhash, "written", noted)
    monkeypatch.setattr(graph, "written", noted)
    fps = [1 << i for i in range(32)] + [(7 << 40) + (1 << i) for i in range(16)]
    monkeypatch.setattr(simhash.links, "__defaults__", (2, 4))
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows).collect()}
    assert got == {i: 0 if i < 32 else 32 for i in range(48)}
    steps = {n: k for n, k in seen.items() if n.startswith("components-") or n == "simhash-links"}
    assert len(steps) >= 3 and max(steps.values()) <= 30, steps
