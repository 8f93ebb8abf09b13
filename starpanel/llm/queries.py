"""Queries of the operators in this subpackage, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starpanel.llm.merge_replay import op8_merge_replay
from starpanel.llm.license_scan import op10_license_scan
from starpanel.llm.pii import op9_pii
from starpanel.llm.packing import op5_packing
from starpanel.llm.embedding_dedup import op1_embedding_dedup
from starpanel.llm.topk_search import ORACLE as TOPK_SQL
from starpanel.llm.topk_search import op4_topk_search
from starpanel.llm.minhash_dedup import op6_minhash_dedup
from starpanel.llm.quality import op3_quality
from starpanel.llm.token_counts import op7_token_counts
from starpanel.llm.secret_scan import op2_secret_scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op7_token_counts": op7_token_counts,
    "op3_quality": op3_quality,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op4_topk_search": op4_topk_search,
    "op1_embedding_dedup": op1_embedding_dedup,
    "op5_packing": op5_packing,
    "op9_pii": op9_pii,
    "op10_license_scan": op10_license_scan,
    "op2_secret_scan": op2_secret_scan,
    "op8_merge_replay": op8_merge_replay,
}

def _base(query: Callable[[SparkSession, str], DataFrame], *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """The columns of a query that its base patterns alone decide: these can be said in SQL."""
    return lambda spark, sf_dir: query(spark, sf_dir).select("doc_id", *columns)


QUERIES |= {
    "secret_base": _base(op2_secret_scan, "n_assign", "n_access", "n_hex"),
    "pii_base": _base(op9_pii, "n_email", "n_ip", "n_card", "n_phone"),
    "license_base": _base(op10_license_scan, "n_words", "n_base", "first_word", "last_word", "base_labels"),
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Everything that each node reaches by edges (u, v), itself included.
_REACH = """reach AS (SELECT DISTINCT u AS id, u AS other FROM edges UNION SELECT r.id, e.v FROM reach r JOIN edges e ON e.u = r.other),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""

_EMBEDDING_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
edges AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND (a.embedding = b.embedding OR list_cosine_similarity(a.e, b.e) >= 0.95)),
{_REACH},
n AS (SELECT u AS id, count(*) AS n_links FROM edges GROUP BY u),
c AS (SELECT vec_id AS id, min(vec_id) OVER (PARTITION BY embedding) AS class_id FROM v)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept, coalesce(class_id, vec_id) AS class_id
FROM embeddings LEFT JOIN n ON n.id = vec_id LEFT JOIN least ON least.id = vec_id LEFT JOIN c ON c.id = vec_id
"""

_MINHASH_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN generate_series(1, len(w) - 4)]) END AS s FROM w),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS shared FROM one a JOIN one b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
edges AS (SELECT u, v FROM pairs WHERE 100 * shared >= 85 * (n + m - shared)),
{_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept FROM s LEFT JOIN least ON least.id = doc_id
"""

_SECRET_SQL = r"""
SELECT doc_id, len([x FOR x IN regexp_extract_all(coalesce(text, ''), '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) IF len(x) >= 12]) AS n_assign,
 len([x FOR x IN regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+') IF len(x) >= 18]) AS n_access,
 len([x FOR x IN regexp_extract_all(coalesce(text, ''), '[0-9a-f]+') IF len(x) >= 16]) AS n_hex FROM documents
"""

_PII_SQL = r"""
WITH m AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS email,
  regexp_extract_all(coalesce(text, ''), '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') AS ip,
  [regexp_replace(x, '[^0-9]', '', 'g') FOR x IN regexp_extract_all(coalesce(text, ''), '[0-9](?:[\x20-]?[0-9])+')] AS card,
  [regexp_replace(x, '[^0-9]', '', 'g') FOR x IN regexp_extract_all(coalesce(text, ''), '\+[0-9][\x20().0-9-]+[0-9]')] AS phone FROM documents)
SELECT doc_id, len(email) AS n_email, len([x FOR x IN ip IF len([p FOR p IN string_split(x, '.') IF CAST(p AS HUGEINT) > 255]) = 0]) AS n_ip,
 len([x FOR x IN card IF len(x) BETWEEN 13 AND 19 AND list_sum([CASE WHEN i % 2 = 0 THEN CAST(x[len(x) - i] AS INTEGER) ELSE (2 * CAST(x[len(x) - i] AS INTEGER)) % 10 + 2 * CAST(x[len(x) - i] AS INTEGER) // 10 END FOR i IN generate_series(0, len(x) - 1)]) % 10 = 0]) AS n_card,
 len([x FOR x IN phone IF len(x) BETWEEN 9 AND 15]) AS n_phone FROM m
"""

_LICENSE_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT * FROM (VALUES (['under', 'the', 'mit', 'license'], 'mit'), (['apache', 'license', 'version', '2'], 'apache-2'), (['cc', 'by', 'nc'], 'cc-by-nc')) AS v(phrase, label)),
h AS (SELECT doc_id, label, unnest([i - 1 FOR i IN generate_series(1, len(w)) IF w[i] = phrase[1] AND w[i:i + len(phrase) - 1] = phrase]) AS pos FROM w, p),
g AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h GROUP BY 1)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels FROM w LEFT JOIN g ON g.doc_id = w.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op1_embedding_dedup": _EMBEDDING_SQL,
    "op4_topk_search": TOPK_SQL,
    "op6_minhash_dedup": _MINHASH_SQL,
    "secret_base": _SECRET_SQL,
    "pii_base": _PII_SQL,
    "license_base": _LICENSE_SQL,
}
