"""The opN queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: End-of-document ids of the contracts.
STORE_END_ID, PACK_END_ID = 2, 0
SEQUENCE_TOKENS = 2048


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_token_store")
def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.token_store import token_store

    return token_store(table(spark, sf_dir, "documents"), tokenizer_path(), STORE_END_ID)


@query("op3_warc_segments", """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha256(encode(coalesce(html, ''))) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100
                     THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
""")
def op3_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.warc import warc_roundtrip

    return warc_roundtrip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.packing import best_fit_packing

    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer_path(), PACK_END_ID, SEQUENCE_TOKENS)


@query("op7_url_filter", """
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(action, rule, rule_host, rule_path) AS (VALUES
    ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
    ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
    ('block', 'com/de/', 'com', '/de/')),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
      FROM p JOIN r ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(action,
    CASE WHEN regexp_matches('.' || host || path,
        '^\\.[^/]*(/ads/.*|/.*/track[^/]|/.*/tracking/.*|/.*/login.*|/.*/signin.*|/cgi-bin/.*|/.*\\.php|/wp-admin/.*)$')
        OR regexp_matches('.' || host || path, '^\\.ads\\..*$') OR regexp_matches('.' || host || path, '^[^/]*\\.ads\\..*$')
        OR regexp_matches('.' || host || path, '^[^/]*\\.doubleclick\\.[^/]*/.*$')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m USING (page_id)
""")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.url_filter import filter_urls

    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op10_multiset_fingerprint")
def op10_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.fingerprint import edited_pairs

    return edited_pairs(table(spark, sf_dir, "documents"))


@query("op8_jaccard_join")
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


@query("op9_entropy_secrets")
def op9_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.secrets import ALL_CLASSES, scan

    return scan(table(spark, sf_dir, "documents"), classes=ALL_CLASSES)


@query("op5_pigeonhole_decontamination")
def op5_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.decontam import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_crf_language")
def op6_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


@query("op2_ngram_trie")
def op2_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.ngram_lm import score_texts

    return score_texts(table(spark, sf_dir, "documents"), order=3)


@query("op13_line_dedup", r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, i, line, r.key IS NOT NULL AND r.last <> k.doc_id AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.line_dedup import drop_repeated_lines

    return drop_repeated_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_collocations", r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\n\x0B\f\r]')) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cut AS (SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, n.n,
               (1000 * c.a::HUGEINT * n.n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:j], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[j + 1:], ' ')
        JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
    FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k > 2)) GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
           FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase
           WHERE x.longer IS NULL OR 100 * x.longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martkit.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))
