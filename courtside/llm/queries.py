"""The registered query of every corpus operator, over whole tables, with its DuckDB statement where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import bpe, decontaminate, langid, license_scan, line_dedup, minhash, near_vectors, quality, suffix_dedup, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(text):
    return F.sha2(text.cast("binary"), 256)


# The rules of the query (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


OP2_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(rh, rp, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT page_id, host, path, rh || rp AS rule, says FROM parts JOIN rules
  ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
), best AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(says, length(rule)) AS says FROM fits GROUP BY ALL
)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.says, 'allow') AS verdict FROM parts p LEFT JOIN best b ON p.page_id = b.page_id
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", digest(F.col("kept_text")).alias("kept_sha256"))


LINES_SQL = """
lines AS (
  SELECT doc_id, row_number() OVER () AS rn, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), common AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT doc_id, line, pos, (first IS NOT NULL AND doc_id <> first) AS gone FROM keyed LEFT JOIN common USING (k)
)
"""
OP4_SQL = f"""
WITH {LINES_SQL}
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("found").withColumn("score", F.round("score", 6))


def _op8_sql() -> str:
    t = license_scan.TEMPLATES
    rows = ", ".join(f"({k}, '{x.label}', {str(x.base).lower()}, {i}, '{w}', {str(license_scan.key_at(x) <= i < license_scan.key_at(x) + len(x.key.split())).lower()})" for k, x in enumerate(t) for i, w in enumerate(x.words.split()))
    return f"""
WITH template(k, label, base, i, w, must) AS (VALUES {rows}),
split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM split
), held AS (
  SELECT doc_id, w, p FROM words WHERE w IN (SELECT w FROM template)
), idf AS (
  SELECT v.w, ln(((SELECT count(*) FROM documents) + 1) / (count(DISTINCT h.doc_id) + 1)) + 1 AS idf
  FROM (SELECT DISTINCT w FROM template) v LEFT JOIN held h ON v.w = h.w GROUP BY v.w
), whole AS (
  SELECT k, sum(idf) AS total, count(*) FILTER (must) AS musts FROM template JOIN idf USING (w) GROUP BY k
), starts AS (
  SELECT doc_id, k, label, base, p - i AS s, sum(idf) AS got, count(*) FILTER (must) AS musts
  FROM held JOIN template USING (w) JOIN idf USING (w) GROUP BY ALL
), found AS (
  SELECT doc_id, label, base, s, got / total AS share FROM starts JOIN whole USING (k)
  WHERE starts.musts = whole.musts AND got / total >= {license_scan.MIN_SHARE}
), by_doc AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         max(share) FILTER (NOT base) AS score FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(round(coalesce(score, 0), 6) AS DOUBLE) AS score
FROM split LEFT JOIN by_doc USING (doc_id)
"""


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


OP7_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END) AS h FROM w
), size AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL
), pair AS (
  SELECT c.a, c.b FROM common c JOIN size x ON x.doc_id = c.a JOIN size y ON y.doc_id = c.b WHERE 100 * k >= 80 * (x.n + y.n - k)
), link AS (
  SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), lowest AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(coalesce(low, d.doc_id), d.doc_id) AS component_id,
       least(coalesce(low, d.doc_id), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN size z ON z.doc_id = d.doc_id LEFT JOIN lowest l ON l.a = d.doc_id
"""


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), lowest AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n FROM link GROUP BY a
)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(coalesce(low, e.vec_id), e.vec_id) AS component_id,
       least(coalesce(low, e.vec_id), e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN lowest w ON w.a = e.vec_id
"""


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", (~F.col("contaminated")).alias("kept"), "items", "matches")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    out = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    ids = F.array_join(F.col("tokens").cast("array<string>"), ",")
    return out.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.train_part(docs).select("text", "lang"))
    return langid.identify(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), digest(F.col("kept")).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_quality": op3_quality,
    "op4_line_dedup": op4_line_dedup,
    "op5_near_vectors": op5_near_vectors,
    "op6_decontaminate": op6_decontaminate,
    "op7_minhash": op7_minhash,
    "op8_license_scan": op8_license_scan,
    "op9_langid": op9_langid,
    "op10_bpe": op10_bpe,
}
ORACLES: dict[str, str] = {"op2_url_filter": OP2_SQL, "op4_line_dedup": OP4_SQL, "op5_near_vectors": OP5_SQL, "op7_minhash": OP7_SQL, "op8_license_scan": _op8_sql()}
