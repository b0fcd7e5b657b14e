"""Registered queries of the text operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskgraph.llm import (
    centroids, decontaminate, exact_dedup, language, line_dedup, ngram_join, pieces, quality, secret_scan, shards, simhash, spelling, toxicity,
)

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@register
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.digest_groups(_documents(spark, folder))


SQL["op1_exact_dedup"] = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM rows WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
"""


@register
def op2_sentencepiece(spark: SparkSession, folder: str, model: str = PIECE_MODEL) -> DataFrame:
    return pieces.encode(_documents(spark, folder), pieces.load(model))


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


@register
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(_documents(spark, folder), _labels(spark, folder))


@register
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(_documents(spark, folder), _labels(spark, folder))


@register
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, folder))


@register
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), stride=decontaminate.STRIDE)


@register
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_classes(_documents(spark, folder))


@register
def op8_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.byte_shards(_documents(spark, folder), 16)


@register
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    return language.identify(docs, language.train(docs))


@register
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.find_secrets(_documents(spark, folder))


@register
def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clusters(spark.read.parquet(f"{folder}/embeddings.parquet"))


def _clusters_sql(k: int = centroids.K, rounds: int = centroids.ROUNDS) -> str:
    """One stage of SQL a round: distances to all centroids, then the exact floor of each component's mean."""
    nearest = """best{r} AS MATERIALIZED (
  SELECT rid, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
  FROM (SELECT rid, cluster, sum((x - c) * (x - c))::BIGINT AS d FROM cells JOIN centroids{r} USING (i) GROUP BY rid, cluster) GROUP BY rid)"""
    moved = """centroids{next} AS MATERIALIZED (
  SELECT cluster, i, coalesce((s - ((s % n) + n) % n) // n, c) AS c
  FROM centroids{r} LEFT JOIN (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM cells JOIN best{r} USING (rid) GROUP BY cluster, i) USING (cluster, i))"""
    steps = ",\n".join(nearest.format(r=r) + (",\n" + moved.format(r=r, next=r + 1) if r < rounds else "") for r in range(rounds + 1))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
cells AS MATERIALIZED (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept),
centroids0 AS MATERIALIZED (
  SELECT cluster, unnest(v) AS c, generate_subscripts(v, 1) AS i
  FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v FROM kept QUALIFY cluster < {k})),
{steps},
names AS (SELECT cluster, sha256(string_agg(c, ',' ORDER BY i)) AS centroid_sha256 FROM centroids{rounds} GROUP BY cluster)
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM best{rounds} JOIN kept USING (rid) JOIN names USING (cluster)
"""


SQL["op11_centroids"] = _clusters_sql()


@register
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_documents(spark, folder))


@register
def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(_documents(spark, folder))


SQL["op13_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS shingles
  FROM words),
named AS MATERIALIZED (SELECT doc_id, len(shingles) AS n, md5(array_to_string(shingles, chr(10))) AS name, shingles FROM shingled),
sets AS MATERIALIZED (SELECT min(doc_id) AS least, any_value(n) AS n, any_value(shingles) AS shingles FROM named WHERE n > 0 GROUP BY name),
tokens AS MATERIALIZED (SELECT least, n, unnest(shingles) AS token FROM sets),
pairs AS MATERIALIZED (
  SELECT a.least AS a, b.least AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.least < b.least
  GROUP BY a.least, b.least, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(a, b) AS (SELECT least, least FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a, min(b) AS root FROM reach GROUP BY a),
leads AS (SELECT name, min(doc_id) AS least FROM named WHERE n > 0 GROUP BY name)
SELECT d.doc_id, d.n AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
FROM named d LEFT JOIN leads l ON d.n > 0 AND d.name = l.name LEFT JOIN roots r ON r.a = l.least
"""
