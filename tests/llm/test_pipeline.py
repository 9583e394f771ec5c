"""The pipeline's stages on their own inputs, and the registration of the queries."""

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import pii, quality, queries, simhash
from tests_llm_data import awkward

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """name -> (input rows, output rows)"""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    from tessera.llm.common import written

    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF), f"test-{name}")
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()])
        docs = after
    return out


def test_stage_order_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "pii", "mixing", "packing"]
    for name in list(stages)[:-1]:
        assert list(stages[name][1][0]) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage_keeps_what_it_scores_well(spark, stages):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in quality.classify(docs, labels).collect() if r["predicted"] == 1}
    assert {r["doc_id"] for r in stages["quality"][1]} == good
    clean = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    assert len(clean & good) >= 0.98 * len(clean)


def test_near_dedup_stage_keeps_one_of_each_component(stages):
    before, after = stages["near_dedup"]
    fps = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in before}
    ids, parent = sorted(fps), {i: i for i in fps}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if (fps[ids[a]] ^ fps[ids[b]]).bit_count() <= 2:
                x, y = find(ids[a]), find(ids[b])
                parent[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in after) == sorted({find(i) for i in ids})


def test_pii_stage_leaves_no_base_span_and_clean_texts_alone(stages):
    before, after = stages["pii"]
    old = {r["doc_id"]: r["text"] for r in before}
    assert len(before) == len(after)
    for r in after:
        assert pii.base_spans(r["text"]) == []
        if not pii.base_spans(old[r["doc_id"]]):
            assert r["text"] == old[r["doc_id"]]


def test_mixing_stage_takes_the_budget(stages):
    before, after = stages["mixing"]
    size = lambda rows: Counter({s: sum(len(r["text"].encode().split()) for r in rows if r["source"] == s) for s in {r["source"] for r in before}})
    had, got = size(before), size(after)
    assert abs(sum(got.values()) - 1.5 * sum(had.values())) <= len(had) + 1
    assert all(got[s] <= 2 * had[s] for s in had)


def test_packing_stage_packs_every_row(stages):
    before, after = stages["packing"]
    rows, tokens = Counter(r["doc_id"] for r in before), Counter()
    for p in after:
        tokens[p["doc_id"]] += p["length"]
    assert set(tokens) == set(rows)


def test_packed_sequences_are_rebuilt_from_the_result(stages):
    from tokenizers import Tokenizer

    before, after = stages["packing"]
    tok = Tokenizer.from_file(queries.word_tokenizer())
    want = Counter((r["doc_id"], tuple(tok.encode(r["text"] or "", add_special_tokens=False).ids) + (1,)) for r in before)
    sequences, cut = {}, Counter()
    for p in after:
        sequences.setdefault(p["sequence_id"], []).append(p)
    for pieces in sequences.values():
        ids = b"".join(p["ids"] for p in sorted(pieces, key=lambda p: p["offset"]))
        assert len(ids) == 4 * sum(p["length"] for p in pieces) <= 4 * 2048
        for p in pieces:
            cut[p["doc_id"], p["doc_tokens"], p["start"], ids[4 * p["offset"] : 4 * (p["offset"] + p["length"])]] += 1
    got, texts = Counter(), Counter()
    for (doc, n, _, ids), c in cut.items():
        got.update({(doc, n, t): c * k for t, k in Counter(np.frombuffer(ids, "<u4").tolist()).items()})
    for (doc, ids), c in want.items():
        texts.update({(doc, len(ids), t): c * k for t, k in Counter(ids).items()})
        start = [p for p in cut if p[0] == doc and p[1] == len(ids)]
        assert all(np.frombuffer(x, "<u4").tolist() in [list(i[a : a + len(x) // 4]) for d, i in want if d == doc and len(i) == n] for _, n, a, x in start)
    assert got == texts


def test_stages_take_awkward_rows(spark):
    odd = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == odd.columns
            out.write.format("noop").mode("overwrite").save()


def test_run_is_the_stages_in_a_row(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"])
    tokens = lambda rows: Counter((r["doc_id"], r["doc_tokens"]) for r in rows)
    rows = [r.asDict() for r in got.collect()]
    assert set(tokens(rows)) == set(tokens(stages["packing"][1])) and key(rows[0])


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = con.execute(queries.ORACLE[name]).to_arrow_table().to_pandas()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    plain = lambda rows: sorted((tuple(None if v != v else round(float(v), 6) if isinstance(v, (int, float)) else v for v in r) for r in rows), key=str)
    assert plain(tuple(r[c] for c in cols) for r in got.collect()) == plain(want[cols].itertuples(index=False, name=None))
