"""The registered queries of this subpackage, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tidemark.llm import bpe, filter_audit, langid, mixing, ngram_join, pii, quality, search, secrets, simple8b, token_counts, url_rules, vectors
from tidemark.plans.durable import work_folder

END_ID = 2
# (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_folder(spark, "tokens")
    simple8b.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return simple8b.token_digests(spark, path)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(_table(spark, sf_dir, "documents")))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode_documents(encoded, ranks, public_tokenizers.PATTERN))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    mined = url_rules.mine_rules(pages, _table(spark, sf_dir, "labels"))
    return url_rules.judge(pages, URL_RULES, mined).select("page_id", "host", "path", "rule", "verdict")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.similar_sets(_table(spark, sf_dir, "documents"), width=5, percent=75)
    return found.select("doc_id", F.col("size").alias("n_shingles"), "component_id")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find(_table(spark, sf_dir, "documents")))


def op7_perplexity_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents")).drop("log_perplexity")


def op8_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    query.__name__: query
    for query in (
        op1_simple8b_tokens,
        op2_secret_scan,
        op3_byte_bpe,
        op4_url_filter,
        op5_ngram_jaccard,
        op6_personal_data,
        op7_perplexity_quality,
        op8_vector_near_duplicates,
        op9_language,
        op10_source_mix,
        op11_lexical_search,
        op12_filter_audit,
        op13_token_counts,
        pipeline,
    )
}

ORACLE = {
    "op5_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id""",
    "op11_lexical_search": r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
d AS (SELECT * FROM t WHERE len(terms) > 0),
s AS (SELECT count(*) AS n_all, sum(len(terms))::BIGINT AS length_all FROM d),
q AS (
  SELECT item_id, row_number() OVER () AS query, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM (SELECT DISTINCT item_id, text FROM benchmark)),
w AS (SELECT item_id, query, term, count(*) AS often FROM (SELECT item_id, query, unnest(terms) AS term FROM q) GROUP BY ALL),
p AS (SELECT doc_id, place, n, term, count(*) AS tf FROM (SELECT doc_id, place, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
c AS (
  SELECT w.item_id, w.query, p.doc_id, p.place,
    often * floor(1000 * ln((2 * n_all + 2) / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_all) // length_all))) AS part
  FROM w JOIN p ON p.term = w.term JOIN f ON f.term = w.term, s),
r AS (SELECT item_id, query, doc_id, place, sum(part)::BIGINT AS score FROM c GROUP BY ALL HAVING sum(part) > 0)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id))::INT AS rank FROM r) WHERE rank <= 10""",
    "op12_filter_audit": r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT t.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS fails
  FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS filter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.filter || b.filter || c.filter || d.filter || e.filter AS filter_order
  FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit) JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit)
  JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
s AS (
  SELECT filter_order, step, f.bit, (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE instr(filter_order, g.filter) < step)::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) k JOIN f ON f.filter = substr(filter_order, step, 1)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
r AS (
  SELECT part, filter_order, step, s.bit,
    coalesce(sum(n) FILTER (fails & (before | s.bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails & before = 0 AND fails & s.bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails & before <> 0 AND fails & s.bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = s.bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails & before = 0 AND fails & s.bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails & before = 0 AND fails & s.bit <> 0), 0)::BIGINT AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, s.bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r""",
}
