"""The registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .cross_entropy import cross_entropy_difference, good_documents
from .decontamination import contamination
from .jaccard_join import jaccard_join
from .kdtree import top_k
from .lexical_search import search
from .license_scan import PHRASES, TEMPLATES, digest, license_scan, mandatory_words, pattern
from .packing import pack
from .pii import pseudonymize
from .quality_rules import quality
from .sharding import uniform_shards
from .toxicity import toxicity
from .url_filter import MIN_SOFT, RULES, SOFT, STRICT, url_filter
from .vector_codes import ENTRIES, PARTS, ROUNDS, vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and its component of near copies."""
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "links")


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in one of 24 shards of equal row counts."""
    text = F.coalesce("text", F.lit(""))
    return uniform_shards(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, deciding rule and verdict."""
    return url_filter(table(spark, sf_dir, "pages"))


def _op9_sql() -> str:
    """The rules, and each term between boundaries as a pattern."""
    lower = ", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    terms = ", ".join(f"('{k}', '{t}')" for k, ts in (("strict", STRICT), ("soft", SOFT)) for t in ts)
    return rf"""
WITH cut AS (SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url,
    CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT r, page_id, translate(url{lower} AS url, translate(regexp_extract(rest, '^[^/?#]*'){lower} AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
rules(verdict, host, path) AS (VALUES {rules}),
fit AS (SELECT p.r, arg_max(u.host || u.path, length(u.host || u.path)) AS rule,
    arg_max(u.verdict, length(u.host || u.path)) AS verdict FROM parts p JOIN rules u
    ON (p.host = u.host OR p.host LIKE '%.' || u.host) AND starts_with(p.path, u.path) GROUP BY p.r),
terms(kind, term) AS (VALUES {terms}),
hit AS (SELECT p.r, kind, term, len(regexp_extract_all(replace(p.url, '_', '-'), '\b' || term || '\b')) AS n
    FROM parts p JOIN terms t ON contains(p.url, t.term)),
sums AS (SELECT r, coalesce(sum(n) FILTER (kind = 'strict'), 0) AS strict_hits,
    count(*) FILTER (kind = 'soft' AND n > 0) AS soft_hits FROM hit GROUP BY r)
SELECT page_id, p.host, p.path, f.rule,
    coalesce(f.verdict, CASE WHEN coalesce(strict_hits, 0) > 0 OR coalesce(soft_hits, 0) >= {MIN_SOFT} THEN 'block' ELSE 'allow' END)
    AS verdict, CAST(coalesce(strict_hits, 0) AS INTEGER) AS strict_hits, CAST(coalesce(soft_hits, 0) AS INTEGER) AS soft_hits
FROM parts p LEFT JOIN fit f USING (r) LEFT JOIN sums s USING (r)"""


ORACLES["op9_url_vocabulary"] = _op9_sql()


@query
def op8_kdtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors of every query vector (ids divisible by 50)."""
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where("vec_id % 50 = 0"))


ORACLES["op8_kdtree_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.c, c.c) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with format-preserving pseudonyms in its text."""
    return pseudonymize(table(spark, sf_dir, "documents")).select("doc_id", "text")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("x")


@query
def op4_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's loss difference between a model of good documents and one of all."""
    docs = table(spark, sf_dir, "documents")
    return cross_entropy_difference(docs, good_documents(table(spark, sf_dir, "labels")), least=1)


@query
def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_lexical_search"] = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT r, doc_id, w, len(w) AS n FROM t WHERE len(w) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM g),
p AS (SELECT r, doc_id, 100 - 50 + ((50 * n * docs) // total) AS m, term, count(*) AS tf
    FROM (SELECT r, doc_id, n, unnest(w) AS term FROM g), s GROUP BY ALL),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
d AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, docs),
c AS (SELECT q.item_id, p.r, p.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
    FROM q JOIN p USING (term) JOIN d USING (term) GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM c WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50"""


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license wording."""
    return digest(license_scan(table(spark, sf_dir, "documents")))


def _op12_sql() -> str:
    """Phrases by search and templates by pattern in the words, each between blanks of its own."""
    kinds = [(label, text, True) for label, text in PHRASES] + [(label, text, False) for label, text in TEMPLATES]
    rows = ", ".join(f"('{label}', '{pattern(text)}', {base}, {mandatory_words(text)})" for label, text, base in kinds)
    return rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, len(w) AS n, ' ' || array_to_string(w, '  ') || ' ' AS s FROM t),
k(label, p, base, words) AS (VALUES {rows}),
h AS (SELECT r, label, base, words, CASE WHEN base THEN (length(s) - length(replace(s, p, ''))) // length(p) END AS places,
    CASE WHEN base THEN length(regexp_replace(substr(s, 1, instr(s, p) - 1), '[^ ]', '', 'g')) // 2 END AS first,
    CASE WHEN base THEN n - words - length(regexp_replace(substr(reverse(s), 1, instr(reverse(s), reverse(p)) - 1), '[^ ]', '', 'g'))
        // 2 END AS last FROM d JOIN k ON regexp_matches(s, p)),
g AS (SELECT r, sum(places) AS n_base, min(first) AS first_word, max(last) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(words / (words + 1)) AS score FROM h GROUP BY r)
SELECT doc_id, n AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (r)"""


ORACLES["op12_license_scan"] = _op12_sql()


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code in four codebooks of 256 entries, and its error."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _op13_sql() -> str:
    """Rounds of assignment to the nearest entry and of means, a common table each."""
    gap = "list_sum(list_transform(list_zip(r.x, e.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    nearest = f"SELECT r.r, r.p, min({{{{'d': CAST({gap} AS BIGINT), 'e': e.e}}}}) AS m FROM parts r JOIN e{{k}} e USING (p) GROUP BY r.r, r.p"
    steps = []
    for k in range(ROUNDS):
        steps.append(f"""a{k} AS MATERIALIZED ({nearest.format(k=k)}),
s{k} AS (SELECT p, m.e AS e, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n FROM a{k} JOIN parts USING (r, p),
    generate_series(1, len(x)) AS g(j) GROUP BY ALL),
m{k} AS (SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS x FROM s{k} GROUP BY p, e),
e{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{k}.x, e{k}.x) AS x FROM e{k} LEFT JOIN m{k} USING (p, e))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, v) AS r, vec_id, label, v, len(v) // {PARTS} AS w FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
parts AS MATERIALIZED (SELECT r, p, v[(p - 1) * w + 1:p * w] AS x FROM v, generate_series(1, {PARTS}) AS g(p)),
e0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= {ENTRIES}),
{", ".join(steps)},
a AS MATERIALIZED ({nearest.format(k=ROUNDS)}),
c AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a GROUP BY r),
t AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM c JOIN v USING (r) GROUP BY label),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM e{ROUNDS})
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM c JOIN v USING (r) JOIN t ON v.label IS NOT DISTINCT FROM t.label, b"""


ORACLES["op13_vector_codes"] = _op13_sql()
