"""Queries of the operators, each over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (op1_warc, op2_suffix_dedup, op3_token_records, op4_mixing, op5_decontaminate, op6_url_filter, op7_line_dedup, op8_language,
               op9_topk, op10_hyperminhash, op11_dual_tree, op12_whitening,
               op13_quality)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_warc_archive(spark, sf_dir):
    got = op1_warc.archive(spark, table(spark, sf_dir, "pages"))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op1_warc_archive"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last_id AND last_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM last_id THEN last_id END AS refers_to
FROM p
"""


@query
def op2_suffix_dedup_of_documents(spark, sf_dir):
    return op2_suffix_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op3_token_records_of_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return op3_token_records.token_records(spark, docs, tokenizer_path(), end_id=2)


@query
def op4_mix_sources(spark, sf_dir):
    return op4_mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL["op4_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), k AS (
  SELECT greatest(1, least(1024, sum(size) // 1000000)) AS block, greatest(1, (sum(size) + 2097151) // 2097152) AS shards FROM d
), s AS (
  SELECT *, 1 + (source_rank - 1) % 3 AS weight, 3 * source_size AS cap FROM (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank
    FROM d GROUP BY source)
), f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_rank
                                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
         sum(weight) OVER (ORDER BY cap / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM s
), o AS (
  SELECT cap / weight AS ratio, source_rank AS open_rank, CAST(remains AS DOUBLE) AS remains, CAST(rest AS BIGINT) AS rest
  FROM f WHERE cap * rest > remains * weight ORDER BY cap / weight, source_rank LIMIT 1
), src AS (
  SELECT s.*, CASE WHEN o.open_rank IS NOT NULL AND (s.cap / s.weight, s.source_rank) >= (o.ratio, o.open_rank)
                   THEN o.remains * s.weight / o.rest ELSE CAST(s.cap AS DOUBLE) END AS target
  FROM s LEFT JOIN o ON true
), p AS (
  SELECT d.doc_id, src.source_rank, src.source_size, src.target, d.size, md5('mix:' || d.doc_id) AS h
  FROM d JOIN src ON d.source IS NOT DISTINCT FROM src.source
), c AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source_rank, shard ORDER BY h, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM (SELECT p.*, CAST('0x' || substr(h, 1, 8) AS BIGINT) % shards AS shard FROM p, k)
), cell AS (
  SELECT source_rank, shard, sum(size) AS words, CAST(ceil(sum(size) / any_value(block)) AS BIGINT) AS n
  FROM c, k GROUP BY source_rank, shard
), q1 AS (
  SELECT source_rank, target / (2 * u.i + 1) AS q
  FROM src JOIN (SELECT source_rank, sum(n) AS n FROM cell GROUP BY source_rank) USING (source_rank), unnest(range(CAST(3 * n AS BIGINT))) AS u(i)
  WHERE target > 0
), seats AS (
  SELECT source_rank, count(*) AS seats
  FROM (SELECT source_rank, row_number() OVER (ORDER BY q DESC, source_rank) AS r FROM q1), (SELECT sum(target) AS total FROM src), k
  WHERE r <= round(total / block) GROUP BY source_rank
), q2 AS (
  SELECT source_rank, shard, row_number() OVER (PARTITION BY source_rank ORDER BY words / (2 * u.i + 1) DESC, shard) AS r
  FROM cell, unnest(range(CAST(3 * n AS BIGINT))) AS u(i)
), quota AS (
  SELECT cell.source_rank, cell.shard, greatest(n, 1) AS n, count(q2.r) AS quota,
         CAST('0x' || substr(md5('mix:' || cell.source_rank || ':' || cell.shard), 1, 8) AS BIGINT) % greatest(n, 1) AS turn
  FROM cell LEFT JOIN seats USING (source_rank)
  LEFT JOIN q2 ON q2.source_rank = cell.source_rank AND q2.shard = cell.shard AND q2.r <= seats.seats
  GROUP BY ALL
), b AS (
  SELECT c.*, quota, n, turn, block, u.i FROM c JOIN quota USING (source_rank, shard), k,
         unnest(CASE WHEN size > 0 THEN range(CAST(pos // block AS BIGINT), CAST((pos + size - 1) // block + 1 AS BIGINT)) ELSE [0] END) AS u(i)
)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       CAST(any_value(size * (quota // n)) + sum(CASE
         WHEN size > 0 AND ((i + turn) % n + 1) * (quota % n) // n > (i + turn) % n * (quota % n) // n
         THEN least(pos + size, (i + 1) * block) - greatest(pos, i * block) ELSE 0 END) AS BIGINT) AS taken
FROM b GROUP BY doc_id
"""


@query
def op5_benchmark_leaks(spark, sf_dir):
    return op5_decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_url_verdicts(spark, sf_dir):
    model = op6_url_filter.train(op6_url_filter.labelled_urls(spark))
    got = op6_url_filter.judge_urls(table(spark, sf_dir, "pages"), model, keep=("page_id",))
    return got.select("page_id", "host", "path", "rule", "verdict")


@query
def op7_line_dedup_of_documents(spark, sf_dir):
    return op7_line_dedup.duplicate_lines(table(spark, sf_dir, "documents"))


@query
def op8_languages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    got = op8_language.identify(docs, op8_language.train(docs))
    return got.select("doc_id", "declared", "language", "confidence", "rejected")


@query
def op9_exact_top_k(spark, sf_dir):
    vectors = op9_topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return op9_topk.top_k(vectors, vectors.where("id % 50 = 0"), k=5)


ORACLE_SQL["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op10_near_duplicates(spark, sf_dir):
    got = op10_hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)
    return got.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL["op10_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN ws ELSE ws[i:i + 3] END AS g
  FROM w, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1)) + 1)) AS u(i)
), n AS (
  SELECT w.doc_id, count(s.g) AS n_shingles FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id
), both_sets AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM both_sets JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n_shingles + y.n_shingles - c)
), reach AS (
  SELECT a, b FROM link
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
), least_id AS (
  SELECT a, min(b) AS m FROM reach GROUP BY a
)
SELECT n.doc_id, CAST(n.n_shingles AS BIGINT) AS n_shingles, least(n.doc_id, coalesce(m, n.doc_id)) AS component_id,
       n.doc_id = least(n.doc_id, coalesce(m, n.doc_id)) AS kept
FROM n LEFT JOIN least_id ON n.doc_id = least_id.a
"""


@query
def op11_ranked_documents(spark, sf_dir):
    return op11_dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op11_ranked_documents"] = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS w FROM documents
), c AS (
  SELECT doc_id, w, count(*) AS tf FROM t GROUP BY ALL
), n AS (
  SELECT doc_id, sum(tf) AS n FROM c GROUP BY doc_id
), s AS (
  SELECT count(*) AS docs, sum(n) AS terms FROM n
), m AS (
  SELECT doc_id, CAST(75 + (25 * n * docs) // terms AS BIGINT) AS m FROM n, s
), q AS (
  SELECT item_id, w, count(*) AS q
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS w FROM benchmark) GROUP BY ALL
), f AS (
  SELECT w, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM c SEMI JOIN q USING (w), s GROUP BY w, docs
), r AS (
  SELECT item_id, doc_id, CAST(sum(q * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN f USING (w) JOIN c USING (w) JOIN m USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 20
"""


@query
def op12_whitened_embeddings(spark, sf_dir):
    return op12_whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_quality_of_documents(spark, sf_dir):
    return op13_quality.judge(table(spark, sf_dir, "documents")).drop("failed_rule")


ORACLE_SQL["op13_quality_of_documents"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT doc_id, i, w[i:i + 2] AS g FROM d, unnest(range(1, len(w) - 1)) AS u(i)
), r AS (
  SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
  FROM (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), unnest([0, 1, 2]) AS u(o)
  GROUP BY doc_id
), c AS (
  SELECT d.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT n_symbols > 0.1 * n_words
       AND word_chars / n_words BETWEEN 3 AND 15
       AND NOT n_dup_lines > 0.5 * len(l)
       AND NOT length(regexp_replace(t, '[^!]+', '', 'g')) > 0.3 * n_words
       AND NOT length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 0.4 * word_chars
       AND NOT length(regexp_replace(t, '[^0-9]+', '', 'g')) > 0.3 * word_chars
       AND NOT len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{L}'))) > 0.3 * n_words
       AND NOT len(list_filter(l, lambda x: suffix(rtrim(x), '...') OR suffix(rtrim(x), '…'))) > 0.3 * len(l)
       AND NOT len(list_filter(l, lambda x: substring(ltrim(x), 1, 1) IN ('-', '•', '·', '*'))) > 0.9 * len(l) AS kept
FROM b
"""
