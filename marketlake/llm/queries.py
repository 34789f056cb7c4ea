"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import alignment_table
from .common import table
from .embeddings import embedding_near_duplicates
from .importance import importance_resample
from .langid import identify_languages
from .mixing import mix_sources
from .pii import find_personal_data
from .sentencepieces import piece_digests
from .simhash import simhash_near_duplicates
from .spotsigs import spot_fingerprints
from .substrings import remove_repeats
from .tokencount import count_tokens
from .tokenfiles import token_files
from .urls import RULES, filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_fingerprints(table(spark, sf_dir, "documents"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"))


@query
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_table(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


ORACLE["op1_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x,
         label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
           AND len(list_filter(embedding, lambda e: e <> 0)) > 0 AS ok
  FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE a.ok AND b.ok AND list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least USING (vec_id) LEFT JOIN n USING (vec_id)
"""

ORACLE["op9_url_filter"] = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM parts),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT page_id, host, path, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC) AS nth
  FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE nth = 1
"""

ORACLE["op11_importance_resampling"] = r"""
WITH texts AS (SELECT doc_id, text, 0 AS t FROM documents UNION ALL SELECT NULL, text, 1 FROM benchmark),
features AS (
  SELECT doc_id, t, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
words AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM features)),
-- CRC-32, a byte at a time: eight shifts of the reversed polynomial
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                               lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 10000 AS bucket
  FROM words),
counts AS (SELECT bucket, count(*) FILTER (t = 0) AS s, count(*) FILTER (t = 1) AS n FROM features JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT sum(s)::DOUBLE AS s_all, sum(n)::DOUBLE AS n_all FROM counts),
gain AS (SELECT bucket, floor(1000 * ln((n + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (n_all + 10000))))::BIGINT AS g FROM counts, sums),
weights AS (SELECT doc_id, count(*) AS n_features, sum(g)::BIGINT AS weight FROM features JOIN hashed USING (word) JOIN gain USING (bucket) WHERE t = 0 GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS nth, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN nth <= 10 * n // 100 THEN nth END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLE["op12_substring_dedup"] = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS pos, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS words
  FROM texts WHERE len(w) >= 20),
later AS (SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, (SELECT unnest(range(20)) AS k)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM texts),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (doc_id)
"""
