"""The registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import alignment, ann, blob_secrets, exact_topk, html_text, language_model, licenses, mixing, packing, pii, prefix_trie, quality, simhash
from tessera.llm.common import table


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.NOTICES)


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_secrets.scan_documents(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("size"))
    return mixing.mix(items).select("doc_id", "size", "source_size", "target", "taken")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), *paths)


def trie_base(c: Column) -> Column:
    return c - c % 20


def trie_head(c: Column) -> Column:
    return F.crc32(c.cast("string")) % 4


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), trie_base, trie_head, most_head=3)


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"), language_model.fold())


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_packing": op2_packing,
    "op3_ann": op3_ann,
    "op4_exact_topk": op4_exact_topk,
    "op5_pii": op5_pii,
    "op7_secrets": op7_secrets,
    "op8_html": op8_html,
    "op6_mixing": op6_mixing,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_language_model": op13_language_model,
}

#: The mix in plain SQL: sizes, water-filled targets, order by hashed key, cut.
MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, 2.0 * source_size AS cap,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS w FROM s
), r AS (
  SELECT *, cap / w AS ratio,
         (1.5 * sum(source_size) OVER ()
          - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), f AS (
  SELECT min(ratio) AS ratio, arg_min(level, ratio) AS level FROM r WHERE level <= ratio
), t AS (
  SELECT source, source_size, CASE WHEN f.ratio IS NULL OR r.ratio < f.ratio THEN cap ELSE least(cap, w * f.level) END AS target
  FROM r, f
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('7:' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (epochs * size + greatest(0, least(floor(target) - epochs * source_size - before, size)))::BIGINT AS taken
FROM p
"""

#: The exact integer search in plain SQL.
TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

#: The trie in plain SQL: conversations as lists of hashed turns, nodes as their prefixes.  CRC-32 bit by bit.
TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT c, list({'role': role, 'text': text} ORDER BY r) AS turns FROM t GROUP BY c
), h AS (
  SELECT c, turns,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
             lambda a, x: list_reduce(list_prepend(xor(a, x), [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]),
                                      lambda s, k: xor(s >> 1, (s & 1) * 3988292384)))) % 4 AS h
  FROM o
), b AS (
  SELECT h.c, list_concat(coalesce(o.turns[1:h.h], []), h.turns[h.h + 1:]) AS turns FROM h LEFT JOIN o ON o.c = h.c - h.c % 20
), p AS (
  SELECT c, len(turns) AS n, d, turns[1:d] AS path, turns[d].text AS last FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM b)
), v AS (
  SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, min(CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(last, '[^\x20\x09-\x0D]+')) END) AS words,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends
  FROM p GROUP BY path, d
), k AS (
  SELECT v.*, q.conv_id AS parent_conv_id, q.path AS up FROM v LEFT JOIN v q ON q.path = v.path[1:v.d - 1] AND v.d = q.d + 1
), f AS (
  SELECT up AS path, count(*) AS n_children FROM k WHERE up IS NOT NULL GROUP BY up
), below AS (
  SELECT a.path, sum((u.n_convs - 1) * u.words) AS saved_tokens, count(*) FILTER (WHERE f.path IS NULL) AS n_leaves
  FROM (SELECT v.path AS under, v.path[1:x.i] AS path FROM v, (SELECT unnest(range(0, (SELECT max(d) + 1 FROM v))) AS i) x WHERE x.i <= v.d) a
  JOIN v u ON u.path = a.under LEFT JOIN f ON f.path = a.under GROUP BY a.path
)
SELECT conv_id::BIGINT AS conv_id, d::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id, n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM k LEFT JOIN f ON f.path = k.path JOIN below ON below.path = k.path
"""

ORACLE = {"op12_prefix_trie": TRIE_SQL, "op1_licenses": licenses.oracle(licenses.NOTICES), "op4_exact_topk": TOPK_SQL, "op6_mixing": MIXING_SQL}
