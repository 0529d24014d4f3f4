"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulsegrid.llm import (
    divergence,
    hnsw,
    line_dedup,
    mixing,
    packing,
    pq_dedup,
    simhash,
    tokens,
    tool_calls,
    toxicity,
    urls,
    warc,
    whitening,
)


def op1_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hnsw.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("url")


#: Rules as the contract of op7 gives them.
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urls.rules_table(spark, URL_RULES)
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.judge(docs, model)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("row.doc_id", "source", "lang", "topic", "tokens", "probability", "chosen")


#: The one tool that turns of conversations stand for.
TOOLS = (("reply", "request", "string", True),)


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool messages where turns hold them; all other user turns as calls answered by the assistant."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    written, pairs = tool_calls.tool_messages(turns), tool_calls.turn_pairs(turns)
    calls, results = (a.unionByName(b) for a, b in zip(written, pairs))
    return tool_calls.link(calls, results, tool_calls.schemas_table(spark, TOOLS))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = F.sha2(F.col("kept"), 256).alias("kept_sha256")
    return kept.select("row.doc_id", "n_lines", "n_dropped", digest)


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) e FROM embeddings),
link AS (SELECT a.vec_id a, b.vec_id b FROM v a JOIN v b
         ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id a, vec_id b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least AS (SELECT a, min(b) m FROM reach GROUP BY a),
n AS (SELECT a, count(*) c FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n.c, 0) AS n_links, least.m AS component_id, v.vec_id = least.m AS kept
FROM v JOIN least ON least.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
o AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
                ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM o
"""

OP7_SQL = r"""
WITH r(rule, host, path, verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                           ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT s.*, r.rule, r.verdict, row_number() OVER (
        PARTITION BY s.page_id ORDER BY length(r.rule) DESC) AS k
      FROM s LEFT JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host))
                        AND starts_with(s.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""

OP10_SQL = """
WITH RECURSIVE call AS (
  SELECT conv_id, turn, conv_id || ':' || turn AS call_id, text FROM conversations
  WHERE role = 'user'),
chain AS (
  SELECT conv_id, turn, 0 AS level FROM call c
  WHERE NOT EXISTS (SELECT 1 FROM call b WHERE b.conv_id = c.conv_id AND b.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, chain.level + 1 FROM chain JOIN call c
    ON c.conv_id = chain.conv_id AND c.turn = chain.turn + 2),
done AS (SELECT conv_id, turn - 1 AS turn, text AS result FROM conversations WHERE role = 'assistant')
SELECT call.conv_id, call.call_id, call.turn, chain.level,
  row_number() OVER (PARTITION BY call.conv_id ORDER BY chain.level, call.turn, call.call_id) AS position,
  CASE WHEN done.result IS NULL THEN 'no result' ELSE 'ok' END AS status,
  '' AS faults,
  CASE WHEN done.result IS NULL THEN 0 ELSE 1 END AS n_results,
  '{"after":[' || CASE WHEN chain.level > 0
      THEN '"' || call.conv_id || ':' || (call.turn - 2) || '"' ELSE '' END
    || '],"arguments":{"request":' || to_json(call.text) || '},"id":"' || call.call_id
    || '","name":"reply"' || CASE WHEN done.result IS NULL THEN '' ELSE ',"result":'
    || to_json(done.result) END || '}' AS message
FROM call JOIN chain USING (conv_id, turn)
LEFT JOIN done USING (conv_id, turn)
"""


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
n AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM t GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM n GROUP BY ALL HAVING sum(docs) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0)::HUGEINT AS n, k.n::HUGEINT AS lang_n
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
s AS (SELECT *, 1 + (1000000000 * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS p,
    1 + (1000000000 * (lang_n + 2)) // (sum(lang_n) OVER w + 2 * count(*) OVER w) AS q
  FROM c WINDOW w AS (PARTITION BY lang, source)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
part AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM s WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM part)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r
WHERE part = 'pair' OR rank <= 10
"""

OP13_SQL = r"""
WITH line AS (SELECT doc_id, n, unnest AS line,
    translate(regexp_replace(unnest, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(l) AS unnest, unnest(range(len(l))) AS n
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
held AS (SELECT key, min(doc_id) AS first FROM line WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count_if(first IS NOT NULL AND first <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (first IS NULL OR first = doc_id), ''))
    AS kept_sha256
FROM line LEFT JOIN held USING (key) GROUP BY doc_id
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: query
        for name, query in globals().items()
        if name.startswith("op") and name[2].isdigit()
    }


def llm_sql() -> dict[str, str]:
    return {
        "op1_pq_dedup": OP1_SQL,
        "op6_warc": OP6_SQL,
        "op7_url_filter": OP7_SQL,
        "op10_tool_calls": OP10_SQL,
        "op12_source_divergence": OP12_SQL,
        "op13_line_dedup": OP13_SQL,
    }

