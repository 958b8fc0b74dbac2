"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, centroids, decontam, filter_audit, langid, lm, near_dup, packing, preference, secret_scan, suffix_dedup, toxicity, url_filter


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(_read(spark, sf_dir, "documents")).select("doc_id", "class_id", "copies")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer_file())


def op3_gru_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = langid.held_out(10, 0)
    return lm.score_documents(docs, F.col("doc_id").isNotNull() & ~held_out, held_out)


def op4_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    training = _read(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & ~langid.held_out(5, 0))
    lexicon = toxicity.learn(toxicity.sample(docs, training))
    return toxicity.score_documents(docs.select("doc_id", langid.held_out(5, 0).alias("held_out"), "text"), lexicon).drop("text")


def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_pairs(preference.swapped_reply_pairs(_read(spark, sf_dir, "conversations")))


def op6_byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    training = docs.where(F.col("doc_id").isNotNull() & ~langid.held_out(4, 2)).select("doc_id", "text", "lang")
    model = langid.train(training)
    return langid.identify(docs.select("doc_id", langid.held_out(4, 2).alias("held_out"), "text"), model).drop("text")


def op7_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op9_url_digest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(_read(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(_read(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "net")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), number("net")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_order_minhash": op1_order_minhash,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_gru_lm_scores": op3_gru_lm_scores,
    "op4_lexicon_toxicity": op4_lexicon_toxicity,
    "op5_preference_pairs": op5_preference_pairs,
    "op6_byte_gru_language": op6_byte_gru_language,
    "op7_simhash_decontamination": op7_simhash_decontamination,
    "op8_hnsw_neighbours": op8_hnsw_neighbours,
    "op9_url_digest_filter": op9_url_digest_filter,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_filter_interaction": op12_filter_interaction,
    "op13_secret_scan": op13_secret_scan,
}

DISTANCE = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _clusters_sql(rounds: int = 3) -> str:
    """Every round written out: nearest centroids, then componentwise floors of the means."""
    sql = """
WITH vectors AS (
  SELECT ROW_NUMBER() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY h) - 1 AS INTEGER) AS j, v
  FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM vectors ORDER BY h LIMIT 16)),"""
    for n in range(rounds + 1):
        sql += f"""
a{n} AS (
  SELECT r, j, d FROM (SELECT r, j, d, ROW_NUMBER() OVER (PARTITION BY r ORDER BY d, j) AS place
                       FROM (SELECT v.r, c.j, {DISTANCE} AS d FROM vectors v CROSS JOIN c{n} c)) WHERE place = 1),"""
        if n < rounds:
            sql += f"""
m{n} AS (
  SELECT j, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS v
  FROM (SELECT j, i, CAST(SUM(x) AS BIGINT) AS s, COUNT(*) AS n
        FROM (SELECT a.j, UNNEST(v.v) AS x, UNNEST(range(64)) AS i FROM a{n} a JOIN vectors v ON v.r = a.r) GROUP BY j, i)
  GROUP BY j),
c{n + 1} AS (SELECT c.j, COALESCE(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m ON m.j = c.j),"""
    return sql.rstrip(",") + f"""
SELECT v.vec_id, a.j AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(SUM(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
       CAST(SUM(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN vectors v ON v.r = a.r JOIN c{rounds} c ON c.j = a.j
"""


ORACLE_SQL: dict[str, str] = {
    "op11_centroid_clusters": _clusters_sql(),
    "op12_filter_interaction": """
WITH texts AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text FROM documents),
parts AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM texts),
marks AS (SELECT doc_id, MAX(CAST(quality = 1 AS INTEGER)) AS good, MAX(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
failing AS (
  SELECT part, COALESCE(good, 0) AS good, COALESCE(toxic, 0) AS toxic,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN parts.doc_id > MIN(parts.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM parts LEFT JOIN marks ON marks.doc_id = parts.doc_id),
cells AS (SELECT part, mask, COUNT(*) AS n, SUM(good) AS good, SUM(toxic) AS toxic FROM failing GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(name, bit)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, s AS step, bits[s] AS bit, CAST(COALESCE(list_sum(bits[1:s - 1]), 0) AS INTEGER) AS before
  FROM orders, (SELECT UNNEST([1, 2, 3, 4, 5]) AS s)),
found AS (
  SELECT part, filter_order, step, bit,
         SUM(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         SUM(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
         SUM(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
         SUM(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         SUM(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
         SUM(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(SUM(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM found
""",
    "op5_preference_pairs": """
WITH t AS (
  SELECT conv_id, role, text, COUNT(*) OVER (PARTITION BY conv_id) AS size,
         ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS p
  FROM conversations),
last AS (SELECT conv_id, MAX(p) AS p FROM t WHERE role = 'assistant' GROUP BY conv_id),
convs AS (SELECT conv_id, COUNT(*) AS size FROM t GROUP BY conv_id),
rejected AS (
  SELECT t.conv_id, t.p, t.role, t.text FROM t LEFT JOIN last ON t.conv_id IS NOT DISTINCT FROM last.conv_id WHERE last.p IS NULL OR t.p < last.p
  UNION ALL
  SELECT l.conv_id, l.p, t.role, t.text FROM last l JOIN last o ON o.conv_id = xor(l.conv_id, 1) JOIN t ON t.conv_id = o.conv_id AND t.p = o.p),
rsize AS (SELECT conv_id, COUNT(*) AS size FROM rejected GROUP BY conv_id),
prefix AS (
  SELECT c.conv_id, LEAST(c.size, COALESCE(r.size, 0),
         COALESCE((SELECT MIN(a.p) - 1 FROM t a JOIN rejected b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.p = b.p
                   WHERE a.conv_id IS NOT DISTINCT FROM c.conv_id AND (a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text)), c.size)) AS n
  FROM convs c LEFT JOIN rsize r ON c.conv_id IS NOT DISTINCT FROM r.conv_id),
rendered AS (
  SELECT 'c' AS side, conv_id, p, role, text FROM t UNION ALL SELECT 'r', conv_id, p, role, text FROM rejected),
parts AS (
  SELECT side, r.conv_id, r.p, r.role, n, '<|' || COALESCE(role, 'unknown') || '|>' || chr(10) AS head,
         REPLACE(COALESCE(text, ''), '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM rendered r JOIN prefix x ON r.conv_id IS NOT DISTINCT FROM x.conv_id),
placed AS (
  SELECT *, SUM(LENGTH(head) + LENGTH(body)) OVER (PARTITION BY side, conv_id, p > n ORDER BY p) AS stop FROM parts),
spans AS (
  SELECT side, conv_id, p, n, head || body AS shown,
         CASE WHEN role = 'assistant' THEN CAST(stop - LENGTH(body) AS BIGINT)::VARCHAR || '-' || CAST(stop AS BIGINT)::VARCHAR END AS span
  FROM placed)
SELECT x.conv_id AS pair_id, CAST(x.n AS INTEGER) AS prompt_turns,
       COALESCE((SELECT STRING_AGG(shown, '' ORDER BY p) FROM spans s WHERE s.conv_id IS NOT DISTINCT FROM x.conv_id AND side = 'c' AND p <= x.n), '') AS prompt,
       COALESCE((SELECT STRING_AGG(shown, '' ORDER BY p) FROM spans s WHERE s.conv_id IS NOT DISTINCT FROM x.conv_id AND side = 'c' AND p > x.n), '') AS chosen,
       COALESCE((SELECT STRING_AGG(shown, '' ORDER BY p) FROM spans s WHERE s.conv_id IS NOT DISTINCT FROM x.conv_id AND side = 'r' AND p > x.n), '') AS rejected,
       COALESCE((SELECT STRING_AGG(span, ';' ORDER BY p) FROM spans s WHERE s.conv_id IS NOT DISTINCT FROM x.conv_id AND side = 'c' AND p > x.n), '') AS chosen_spans,
       COALESCE((SELECT STRING_AGG(span, ';' ORDER BY p) FROM spans s WHERE s.conv_id IS NOT DISTINCT FROM x.conv_id AND side = 'r' AND p > x.n), '') AS rejected_spans
FROM prefix x
""",
    "op9_url_digest_filter": """
WITH u AS (
  SELECT page_id, TRANSLATE(COALESCE(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         COALESCE(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' ELSE 'allow' END AS verdict FROM r
""",
}
