"""Batch keyword search: BM25 over several boosted fields, the best field wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import analyze
from marquee.operators.dedup import top_per_query
from marquee.operators.fuzzy import expand_terms
from marquee.operators.postings import TextIndex
from marquee.schemas import FIELD_BOOSTS
from marquee.session import materialise, sent_if_few

K1, B = 1.2, 0.75
# Scores are compared at this many digits, so that summation order cannot split equal documents.
SCORE_DIGITS = 6
# Distinct terms that are named to the scan of the postings, which then skips what cannot hold them.
MOST_TERMS_NAMED = 500


def bm25_idf(n_docs: Column, df: Column) -> Column:
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


def bm25_tf(tf: Column, dl: Column, avgdl: Column, k1: float = K1, b: float = B) -> Column:
    return tf / (tf + k1 * (1.0 - b + b * dl / avgdl))


def query_terms(queries: DataFrame, option: str) -> DataFrame:
    """``(query_id, term, qtf)``; a query that analyses to nothing has no row."""
    terms = queries.select("query_id", F.explode(analyze(F.col("query"), option)).alias("term"))
    return terms.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def query_clauses(
    queries: DataFrame,
    index: TextIndex,
    boosts: dict[str, float],
    fuzzy: str | None = "AUTO",
    max_expansions: int | None = None,
) -> DataFrame:
    """Scored index terms of each query, as a small stored table.

    ``(query_id, field, term, weight, avgdl)``, where weight is query frequency x field
    boost x fuzzy similarity x idf.  Stored, its size is known before the large join is planned and
    it is not worked out twice.
    """
    terms = query_terms(queries, index.option)
    stats = index.term_stats.where(F.col("field").isin(*boosts))
    # At most one row per field.
    sizes = F.broadcast(index.field_stats.select("field", "n_docs", (F.col("sum_dl") / F.col("n_docs")).alias("avgdl")))
    if fuzzy:
        terms = materialise(terms, "query-terms")
        expanded = expand_terms(terms, stats, max_expansions, spelling=index.spelling)
        clauses = terms.withColumnRenamed("term", "query_term").join(expanded, "query_term")
        strength = F.col("qtf") * F.col("similarity")
    else:
        clauses = stats.join(materialise(terms, "query-terms"), "term").withColumn("df_used", F.col("df"))
        strength = F.col("qtf")
    boost = F.element_at(F.create_map(*[F.lit(x) for kv in boosts.items() for x in kv]), F.col("field"))
    weight = strength * boost * bm25_idf(F.col("n_docs"), F.col("df_used"))
    clauses = clauses.join(sizes, "field").select("query_id", "field", "term", weight.alias("weight"), "avgdl")
    return materialise(clauses, "clauses").where(F.col("weight") > 0)


def score_documents(clauses: DataFrame, index: TextIndex, boosts: dict[str, float], k1: float = K1, b: float = B) -> DataFrame:
    """``(query_id, doc_id, score)`` for every document that shares a term with a query.

    Few clauses go to all tasks; the postings are bucketed by document, so scores are added up where they
    are read and nothing is shuffled.  Very many clauses are joined by shuffle, splitting the postings of
    a common term.  The per-field sums and their maximum come from one aggregation.
    """
    postings = index.postings.where(F.col("field").isin(*boosts)).drop("head")
    named = [r["term"] for r in clauses.select("term").distinct().limit(MOST_TERMS_NAMED + 1).collect()]
    if len(named) <= MOST_TERMS_NAMED:
        postings = postings.where(F.col("term").isin(named))
    matched = postings.join(sent_if_few(clauses), ["field", "term"])
    part = F.col("weight") * bm25_tf(F.col("tf"), F.col("dl"), F.col("avgdl"), k1, b)
    fields = list(boosts)
    sums = [F.sum(F.when(F.col("field") == f, part)).alias(f"_{i}") for i, f in enumerate(fields)]
    totals = matched.groupBy("query_id", "doc_id").agg(*sums)
    best = [F.coalesce(F.col(f"_{i}"), F.lit(0.0)) for i in range(len(fields))]
    score = F.greatest(*best) if len(best) > 1 else best[0]
    return totals.select("query_id", "doc_id", score.alias("score"))


def in_country(scored: DataFrame, queries: DataFrame, documents: DataFrame, col: str = "origin_country") -> DataFrame:
    """Keep scored documents that carry the country asked for; queries without one keep all.

    Runs before ranking; an empty code asks for none.  Documents are joined by key alone and looked at for
    the code there: a country with very many documents is spread by document, and documents that are
    bucketed like the postings are not shuffled, nor are the scores.
    """
    asked = sent_if_few(materialise(queries.select("query_id", F.nullif("country", F.lit("")).alias("country")), "countries"))
    wanted = asked.where("country IS NOT NULL").select("country").distinct()
    codes = documents.select(F.col("doc_id").alias("_doc"), F.col(col).alias("_codes"))
    named = [r["country"] for r in wanted.limit(MOST_TERMS_NAMED + 1).collect()]
    if len(named) <= MOST_TERMS_NAMED:
        # Documents without any of few codes are left out where they are read.
        codes = codes.where(F.arrays_overlap("_codes", F.array(*[F.lit(c) for c in named]).cast("array<string>")))
    tagged = scored.join(asked, "query_id")
    free = tagged.where(F.col("country").isNull())
    carries = (F.col("doc_id") == F.col("_doc")) & F.array_contains(F.col("_codes"), F.col("country"))
    bound = tagged.where(F.col("country").isNotNull()).join(codes, carries, "left_semi")
    return free.unionByName(bound).drop("country")


def best_per_query(scored: DataFrame, queries: DataFrame, top_k: int = 10) -> DataFrame:
    """Ranked hits: score descending, then document key; k is the query's own where given."""
    order = [F.desc(F.round("score", SCORE_DIGITS)), F.col("doc_id")]
    return top_per_query(scored, queries, order, top_k)


def sparse_search(
    queries: DataFrame,
    index: TextIndex,
    documents: DataFrame | None = None,
    fields: dict[str, float] | None = None,
    fuzzy: str | None = "AUTO",
    top_k: int = 10,
    max_expansions: int | None = None,
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """Top hits ``(query_id, rank, doc_id, score)`` of every query.

    ``queries`` has ``query_id, query`` and may have ``top_k`` and ``country``; the country filter
    needs ``documents`` (``doc_id, origin_country``).
    """
    boosts = fields or FIELD_BOOSTS
    clauses = query_clauses(queries, index, boosts, fuzzy, max_expansions)
    scored = score_documents(clauses, index, boosts, k1, b)
    if "country" in queries.columns:
        if documents is None:
            raise ValueError("a country filter needs the documents")
        scored = in_country(scored, queries, documents)
    hits = best_per_query(scored, queries, top_k)
    return hits.select("query_id", "rank", "doc_id", F.round("score", 4).alias("score"))
