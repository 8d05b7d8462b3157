"""Vector search over whole tables: every stored vector is also a query."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from marquee.functions.values import similarity
from marquee.operators.dense import dense_search, embed, knn, mean_pool
from marquee.operators.search import search
from marquee.plans import check_sql as sql
from marquee.plans.registry import query
from marquee.plans.views import table

K = 10
HASH_DIM = 64


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


_DISTANCES = (
    f"d AS MATERIALIZED (SELECT q.vec_id AS query_id, v.vec_id, {sql.squared_l2('q.embedding', 'v.embedding')} AS distance "
    "FROM embeddings q CROSS JOIN embeddings v)"
)


@query(
    "knn_l2",
    f"WITH {_DISTANCES}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) "
    f"SELECT query_id, rank, vec_id, round(1 / (1 + distance), 4) AS score FROM r WHERE rank <= {K}",
)
def knn_l2(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    hits = knn(vectors.withColumnRenamed("vec_id", "query_id"), vectors, K)
    return hits.select("query_id", "rank", "vec_id", similarity(F.col("distance")).alias("score"))


@query(
    "knn_batch_blocks",
    f"WITH {_DISTANCES}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) "
    "SELECT query_id, rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 5",
)
def knn_batch_blocks(spark, sf_dir):
    """Both sides in blocks: the path taken when the queries are too many for one broadcast."""
    vectors = _vectors(spark, sf_dir)
    hits = knn(vectors.withColumnRenamed("vec_id", "query_id"), vectors, 5, query_block=128, vector_block=256)
    return hits.withColumn("distance", F.round("distance", 6))


# A movie owns two neighbouring vectors; a query asks for the label after its own, label 0 for any.
_TAGGED = (
    "q AS (SELECT vec_id AS query_id, embedding, CASE WHEN label = 0 THEN NULL ELSE CAST((label + 1) % 10 AS VARCHAR) END AS country FROM embeddings), "
    "v AS (SELECT vec_id, embedding, vec_id // 2 AS movie_id, CAST(label % 10 AS VARCHAR) AS code FROM embeddings), "
    f"d AS MATERIALIZED (SELECT query_id, country, vec_id, movie_id, code, {sql.squared_l2('q.embedding', 'v.embedding')} AS distance FROM q CROSS JOIN v)"
)
_CUT = (
    f"f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM u) "
    f"SELECT query_id, rank, movie_id, round(1 / (1 + distance), 4) AS score FROM f WHERE rank <= {K}"
)


def _tagged(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    asked = rows.select(
        F.col("vec_id").alias("query_id"),
        "embedding",
        F.when(F.col("label") != 0, ((F.col("label") + 1) % 10).cast("string")).alias("country"),
    )
    stored = rows.select(
        "vec_id", "embedding", F.expr("vec_id div 2").alias("movie_id"),
        F.array((F.col("label") % 10).cast("string")).alias("origin_country"),
    )
    return asked, stored


@query(
    "knn_overfetch_filter",
    f"WITH {_TAGGED}, n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS near FROM d), "
    f"m AS (SELECT *, row_number() OVER (PARTITION BY query_id, movie_id ORDER BY near) AS copy FROM n "
    f"WHERE near <= CASE WHEN country IS NULL THEN {2 * K} ELSE {5 * K} END), "
    f"u AS (SELECT * FROM m WHERE copy = 1 AND (country IS NULL OR code = country)), {_CUT}",
)
def knn_overfetch_filter(spark, sf_dir):
    asked, stored = _tagged(spark, sf_dir)
    return dense_search(asked, stored, K).drop("distance")


@query(
    "knn_prefilter",
    f"WITH {_TAGGED}, m AS (SELECT *, row_number() OVER (PARTITION BY query_id, movie_id ORDER BY distance, vec_id) AS copy FROM d "
    f"WHERE country IS NULL OR code = country), u AS (SELECT * FROM m WHERE copy = 1), {_CUT}",
)
def knn_prefilter(spark, sf_dir):
    asked, stored = _tagged(spark, sf_dir)
    return dense_search(asked, stored, K, prefilter=True).drop("distance")


_POOLED = (
    "cells AS (SELECT label, CASE WHEN vec_id % 3 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS m, unnest(range(1, len(embedding) + 1)) AS pos, "
    "embedding FROM embeddings), "
    "pooled AS (SELECT label, pos, sum(CAST(embedding[pos] AS DOUBLE) * m) / greatest(sum(m), 1e-9) AS x FROM cells GROUP BY label, pos)"
)


def _pooled(spark, sf_dir):
    masked = table(spark, sf_dir, "embeddings").select("label", "embedding", (F.col("vec_id") % 3 > 0).cast("int").alias("mask"))
    return mean_pool(masked, "label")


@query("mean_pool_masked", f"WITH {_POOLED} SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(CAST(x AS FLOAT) AS DOUBLE), 6) AS x FROM pooled")
def mean_pool_masked(spark, sf_dir):
    pooled = _pooled(spark, sf_dir)
    cells = pooled.select("label", F.posexplode("embedding").alias("pos", "x"))
    return cells.withColumn("x", F.round(F.col("x").cast("double"), 6))


@query(
    "knn_centroids",
    f"WITH {_POOLED}, c AS (SELECT label, list(CAST(x AS FLOAT) ORDER BY pos) AS center FROM pooled GROUP BY label), "
    f"d AS (SELECT c.label AS query_id, v.vec_id, {sql.squared_l2('c.center', 'v.embedding')} AS distance FROM c CROSS JOIN embeddings v), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) "
    "SELECT query_id, rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 5",
)
def knn_centroids(spark, sf_dir):
    """Plain search: pooled label vectors as queries, the raw distance as the score."""
    centers = _pooled(spark, sf_dir).withColumnRenamed("label", "query_id")
    return knn(centers, _vectors(spark, sf_dir), 5).withColumn("distance", F.round("distance", 6))


def hashed_words():
    """Stand-in encoder for runs without a model: word counts hashed by MD5 into 64 cells.

    It has the interface of a real encoder and no semantic quality.
    """

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), HASH_DIM), dtype=np.float32)
        for row, text in enumerate(texts):
            for word in text.lower().split(" "):
                out[row, int(hashlib.md5(word.encode()).hexdigest()[:2], 16) % HASH_DIM] += 1
        return out

    return encode


_HASHED = (
    "words AS (SELECT {key} AS id, unnest(string_split(lower(text), ' ')) AS w FROM {table}), "
    "{name} AS MATERIALIZED (SELECT id, CAST('0x' || left(md5(w), 2) AS INTEGER) % 64 AS cell, count(*) AS n FROM words GROUP BY ALL)"
)


@query(
    "hashed_embed_search",
    "WITH " + _HASHED.format(key="doc_id", table="documents", name="dv") + ", "
    + _HASHED.format(key="item_id", table="benchmark", name="qv").replace("words", "qwords") + ", "
    "dn AS (SELECT id, sum(n * n) AS s FROM dv GROUP BY id), qn AS (SELECT id, sum(n * n) AS s FROM qv GROUP BY id), "
    "dots AS (SELECT q.id AS query_id, d.id AS doc_id, sum(q.n * d.n) AS dot FROM qv q JOIN dv d USING (cell) GROUP BY ALL), "
    "dist AS (SELECT qn.id AS query_id, dn.id AS doc_id, CAST(qn.s + dn.s - 2 * coalesce(dot, 0) AS DOUBLE) AS distance "
    "FROM qn CROSS JOIN dn LEFT JOIN dots ON dots.query_id = qn.id AND dots.doc_id = dn.id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id) AS rank FROM dist) "
    f"SELECT query_id, rank, doc_id, distance FROM r WHERE rank <= {K}",
)
def hashed_embed_search(spark, sf_dir):
    """Encode documents and queries with the same (stand-in) encoder, then search."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text").repartition("vec_id")
    stored = embed(docs, "text", hashed_words).select("vec_id", "embedding")
    asked = embed(table(spark, sf_dir, "benchmark"), "text", hashed_words).select(F.col("item_id").alias("query_id"), "embedding")
    return knn(asked, stored, K).withColumnRenamed("vec_id", "doc_id")


@query(
    "router_dense_topk",
    f"WITH {_DISTANCES}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) "
    "SELECT query_id, rank, vec_id, round(1 / (1 + distance), 4) AS score FROM r WHERE rank <= least(query_id % 40 + 1, 30)",
)
def router_dense_topk(spark, sf_dir):
    """The router hands each request's own k to the vectors."""
    vectors = _vectors(spark, sf_dir)
    own = F.least(F.col("vec_id") % 40 + 1, F.lit(30)).cast("int")
    requests = vectors.select(F.col("vec_id").alias("query_id"), F.concat(F.lit("vector "), "vec_id").alias("query"), own.alias("top_k"))
    encode = lambda valid: valid.join(vectors.withColumnRenamed("vec_id", "query_id"), "query_id")
    hits = search(requests, "dense", vectors=vectors.withColumn("movie_id", F.col("vec_id")), encode=encode)
    return hits.select("query_id", "rank", F.col("movie_id").alias("vec_id"), "score")
