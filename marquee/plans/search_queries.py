"""Keyword search over whole tables: the benchmark texts are the queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators.dedup import top_n
from marquee.operators.fuzzy import expand_terms
from marquee.operators.postings import build_index
from marquee.operators.search import compare_rankings, overlap_at_k, response_summary, scoped_queries, side_by_side, validate_requests
from marquee.operators.sparse import query_terms, sparse_search
from marquee.plans import check_sql as sql
from marquee.plans.registry import query
from marquee.plans.views import page_documents, table

K = 10


def benchmark_queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


# -- check SQL ------------------------------------------------------------------------------

def _tables(toks, docs: str = "SELECT doc_id, 'text' AS field, text FROM documents", stem: bool = False) -> str:
    """CTEs postings(field, doc_id, term, tf, dl), sizes(field, n, avgdl), dfs(field, term, df), qt(query_id, term, qtf)."""
    raw = (
        f"docs AS ({docs}), "
        f"lists AS MATERIALIZED (SELECT field, doc_id, {toks('text')} AS toks FROM docs), "
        "sized AS MATERIALIZED (SELECT field, doc_id, toks, len(toks) AS dl FROM lists), "
        "draw AS MATERIALIZED (SELECT field, doc_id, dl, unnest(toks) AS term FROM sized), "
        f"qraw AS MATERIALIZED (SELECT item_id AS query_id, unnest({toks('text')}) AS term FROM benchmark), "
    )
    if stem:
        raw += f"words AS (SELECT term FROM draw UNION ALL SELECT term FROM qraw), {sql.stems('words')}, "
        d = "(SELECT field, doc_id, dl, stem AS term FROM draw JOIN stemmed USING (term))"
        q = "(SELECT query_id, stem AS term FROM qraw JOIN stemmed USING (term))"
    else:
        d, q = "draw", "qraw"
    return raw + (
        f"postings AS MATERIALIZED (SELECT field, doc_id, dl, term, count(*) AS tf FROM {d} AS x GROUP BY ALL), "
        "sizes AS (SELECT field, count(*) AS n, sum(dl) / count(*) AS avgdl FROM (SELECT DISTINCT field, doc_id, dl FROM postings) GROUP BY field), "
        "dfs AS MATERIALIZED (SELECT field, term, count(*) AS df FROM postings GROUP BY field, term), "
        f"qt AS MATERIALIZED (SELECT query_id, term, count(*) AS qtf FROM {q} AS x GROUP BY ALL)"
    )


_SCORES = (
    "scores AS (SELECT query_id, doc_id, field, sum(qtf * " + sql.bm25("n", "df", "tf", "dl", "avgdl") + ") AS s "
    "FROM qt JOIN postings USING (term) JOIN dfs USING (field, term) JOIN sizes USING (field) GROUP BY query_id, doc_id, field)"
)


def _ranked(scored: str, k: str = str(K)) -> str:
    return (
        f"ranked AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM {scored})"
    )


_HITS = f"SELECT query_id, rank, doc_id, round(score, 4) AS score FROM ranked WHERE rank <= {K}"
_ONE_FIELD = f"{_SCORES}, best AS (SELECT query_id, doc_id, s AS score FROM scores), {_ranked('best')}"

_PAGES = (
    r"SELECT page_id AS doc_id, 'title' AS field, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS text FROM pages UNION ALL "
    r"SELECT page_id, 'all_text', regexp_replace(regexp_replace(regexp_replace(html, "
    r"'(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') FROM pages"
)
_PAGE_BOOSTS = {"title": 3.0, "all_text": 1.0}


# -- queries --------------------------------------------------------------------------------

@query("bm25_batch_topk", f"WITH {_tables(sql.tokens)}, {_ONE_FIELD} {_HITS}")
def bm25_batch_topk(spark, sf_dir):
    index = build_index(table(spark, sf_dir, "documents"), ["text"], "standard")
    return sparse_search(benchmark_queries(spark, sf_dir), index, fields={"text": 1.0}, fuzzy=None, top_k=K)


@query(
    "bm25_topk",
    f"WITH {_tables(sql.tokens)}, {_SCORES}, total AS (SELECT 0 AS query_id, doc_id, sum(s) AS score FROM scores GROUP BY doc_id), "
    f"{_ranked('total')} SELECT rank, doc_id, round(score, 4) AS score FROM ranked WHERE rank <= 20",
)
def bm25_topk(spark, sf_dir):
    """One query: all benchmark texts joined into a single request."""
    texts = table(spark, sf_dir, "benchmark").select(F.lit(0).alias("query_id"), F.col("text").alias("query"))
    index = build_index(table(spark, sf_dir, "documents"), ["text"], "standard")
    hits = sparse_search(texts, index, fields={"text": 1.0}, fuzzy=None, top_k=20)
    return hits.select("rank", "doc_id", "score")


@query("bm25_stem_topk", f"WITH {_tables(sql.english, stem=True)}, {_ONE_FIELD} {_HITS}")
def bm25_stem_topk(spark, sf_dir):
    index = build_index(table(spark, sf_dir, "documents"), ["text"], "english_stem")
    return sparse_search(benchmark_queries(spark, sf_dir), index, fields={"text": 1.0}, fuzzy=None, top_k=K)


@query(
    "bm25_multifield_boosted",
    f"WITH {_tables(sql.tokens, _PAGES)}, {_SCORES}, best AS (SELECT query_id, doc_id, "
    "max(s * CASE field WHEN 'title' THEN 3.0 ELSE 1.0 END) AS score FROM scores GROUP BY query_id, doc_id), "
    f"{_ranked('best')} {_HITS}",
)
def bm25_multifield_boosted(spark, sf_dir):
    index = build_index(page_documents(spark, sf_dir), list(_PAGE_BOOSTS), "standard")
    return sparse_search(benchmark_queries(spark, sf_dir), index, fields=_PAGE_BOOSTS, fuzzy=None, top_k=K)


@query(
    "bm25_filtered",
    f"WITH {_tables(sql.tokens)}, {_SCORES}, best AS (SELECT query_id, doc_id, s AS score FROM scores "
    "JOIN documents USING (doc_id) WHERE lang = ['en', 'fr', 'de', 'es'][query_id % 4 + 1]), "
    f"{_ranked('best')} {_HITS}",
)
def bm25_filtered(spark, sf_dir):
    """Each query asks for one language; the filter comes before the ranking."""
    docs = table(spark, sf_dir, "documents")
    index = build_index(docs, ["text"], "standard")
    langs = F.array(*[F.lit(x) for x in ("en", "fr", "de", "es")])
    asked = benchmark_queries(spark, sf_dir).withColumn(
        "country", F.element_at(langs, (F.col("query_id") % 4 + 1).cast("int"))
    )
    tagged = docs.select("doc_id", F.array("lang").alias("origin_country"))
    return sparse_search(asked, index, tagged, fields={"text": 1.0}, fuzzy=None, top_k=K)


_NEAR = (
    "vocab AS MATERIALIZED (SELECT DISTINCT term FROM dfs), asked AS (SELECT DISTINCT term AS q, "
    "CASE WHEN length(term) <= 2 THEN 0 WHEN length(term) <= 5 THEN 1 ELSE 2 END AS k FROM qt), "
    "near AS MATERIALIZED (SELECT q, term, damerau_levenshtein(q, term) AS edits FROM asked JOIN vocab "
    "ON abs(length(q) - length(term)) <= k WHERE damerau_levenshtein(q, term) <= k)"
)
_EXPANDED = (
    "ranked_terms AS (SELECT field, q, term, df, edits, row_number() OVER (PARTITION BY field, q ORDER BY edits, term) AS r "
    "FROM near JOIN dfs USING (term)), "
    "expanded AS MATERIALIZED (SELECT field, q, term, df, edits, 1.0::DOUBLE - edits / least(length(q), length(term))::DOUBLE AS similarity, "
    "max(df) OVER (PARTITION BY field, q) AS df_used FROM ranked_terms)"
)


@query(
    "fuzzy_near_terms",
    f"WITH {_tables(sql.tokens)}, {_NEAR} SELECT q AS query_term, term, CAST(edits AS INTEGER) AS edits FROM near",
)
def fuzzy_near_terms(spark, sf_dir):
    """Every vocabulary term within reach of a query term, uncut."""
    from marquee.operators.fuzzy import near_terms

    words = lambda name: table(spark, sf_dir, name).select("text")
    from marquee.functions.text import analyze

    terms = lambda df: df.select(F.explode(analyze(F.col("text"), "standard")).alias("term")).distinct()
    return near_terms(terms(words("benchmark")), terms(words("documents").repartition("text")))


@query(
    "fuzzy_expand",
    f"WITH {_tables(sql.tokens, _PAGES)}, {_NEAR}, {_EXPANDED} SELECT field, q AS query_term, term, df, CAST(edits AS INTEGER) AS edits, "
    "round(similarity, 6) AS similarity, df_used FROM expanded",
)
def fuzzy_expand(spark, sf_dir):
    index = build_index(page_documents(spark, sf_dir), list(_PAGE_BOOSTS), "standard")
    terms = query_terms(benchmark_queries(spark, sf_dir), "standard")
    expanded = expand_terms(terms, index.term_stats)
    return expanded.withColumn("similarity", F.round("similarity", 6))


@query(
    "bm25_fuzzy_multifield",
    f"WITH {_tables(sql.tokens, _PAGES)}, {_NEAR}, {_EXPANDED}, "
    "scores AS (SELECT query_id, doc_id, e.field AS field, sum(qtf * similarity * "
    + sql.bm25("n", "df_used", "tf", "dl", "avgdl")
    + ") AS s FROM qt JOIN expanded e ON qt.term = e.q JOIN postings p ON p.field = e.field AND p.term = e.term "
    "JOIN sizes z ON z.field = e.field GROUP BY query_id, doc_id, e.field), "
    "best AS (SELECT query_id, doc_id, max(s * CASE field WHEN 'title' THEN 3.0 ELSE 1.0 END) AS score FROM scores GROUP BY query_id, doc_id), "
    f"{_ranked('best')} {_HITS}",
)
def bm25_fuzzy_multifield(spark, sf_dir):
    """The full keyword search: fuzzy terms, boosted fields, best field wins."""
    index = build_index(page_documents(spark, sf_dir), list(_PAGE_BOOSTS), "standard")
    return sparse_search(benchmark_queries(spark, sf_dir), index, fields=_PAGE_BOOSTS, top_k=K)


def _two_rankings(spark, sf_dir):
    """BM25, and plain term frequency, for the same queries."""
    docs = table(spark, sf_dir, "documents")
    index = build_index(docs, ["text"], "standard")
    asked = benchmark_queries(spark, sf_dir)
    bm25 = sparse_search(asked, index, fields={"text": 1.0}, fuzzy=None, top_k=K)
    terms = query_terms(asked, "standard")
    counts = index.postings.join(terms, "term").groupBy("query_id", "doc_id").agg(
        F.sum(F.col("tf") * F.col("qtf")).cast("double").alias("score")
    )
    plain = top_n(counts, ["query_id"], [F.desc("score"), F.col("doc_id")], K)
    return bm25, plain


_TWO = (
    f"WITH {_tables(sql.tokens)}, {_ONE_FIELD}, l AS (SELECT query_id, doc_id, rank, round(score, 4) AS score FROM ranked WHERE rank <= {K}), "
    "tfs AS (SELECT query_id, doc_id, CAST(sum(tf * qtf) AS DOUBLE) AS score FROM qt JOIN postings USING (term) GROUP BY query_id, doc_id), "
    f"r AS (SELECT * FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM tfs) WHERE rank <= {K}) "
)


@query(
    "compare_rankings",
    _TWO + "SELECT query_id, doc_id, l.rank AS left_rank, r.rank AS right_rank, l.rank - r.rank AS rank_change "
    "FROM l FULL JOIN r USING (query_id, doc_id)",
)
def compare(spark, sf_dir):
    return compare_rankings(*_two_rankings(spark, sf_dir), k=K)


@query(
    "side_by_side",
    _TWO + "SELECT query_id, rank, l.doc_id AS left_doc_id, l.score AS left_score, r.doc_id AS right_doc_id, r.score AS right_score "
    "FROM l FULL JOIN r USING (query_id, rank)",
)
def both_lists(spark, sf_dir):
    return side_by_side(*_two_rankings(spark, sf_dir))


@query(
    "overlap_at_k",
    _TWO + f"SELECT query_id, count(l.rank + r.rank) AS shared, round(count(l.rank + r.rank) / {K}, 4) AS overlap "
    "FROM l FULL JOIN r USING (query_id, doc_id) GROUP BY query_id",
)
def overlap(spark, sf_dir):
    return overlap_at_k(*_two_rankings(spark, sf_dir), k=K)


@query(
    "validate_requests",
    "SELECT conv_id, turn, trim(text, ' \t\n\r') AS query, least(coalesce(turn * 30, 10), 100) AS top_k, "
    "CASE WHEN trim(text, ' \t\n\r') = '' THEN 'Query cannot be empty.' WHEN turn * 30 < 1 THEN 'top_k must be at least 1.' END AS error FROM conversations",
)
def requests(spark, sf_dir):
    """Every conversation turn as a request; k is 30 times the turn number, so the first turn is refused."""
    asked = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.col("text").alias("query"), (F.col("turn") * 30).alias("top_k")
    )
    valid, errors = validate_requests(asked)
    return valid.withColumn("error", F.lit(None).cast("string")).unionByName(errors)


@query(
    "response_summary",
    f"WITH {_tables(sql.tokens)}, {_ONE_FIELD} SELECT item_id AS query_id, text AS query, 'sparse' AS index_type, "
    f"count(rank) AS result_count FROM benchmark LEFT JOIN (SELECT * FROM ranked WHERE rank <= {K}) h ON h.query_id = item_id GROUP BY item_id, text",
)
def summary(spark, sf_dir):
    asked = benchmark_queries(spark, sf_dir)
    index = build_index(table(spark, sf_dir, "documents"), ["text"], "standard")
    hits = sparse_search(asked, index, fields={"text": 1.0}, fuzzy=None, top_k=K)
    return response_summary(asked, hits, "sparse")


@query(
    "country_scoped_search",
    "SELECT lang AS query_id, CAST(0 AS BIGINT) AS hits FROM documents GROUP BY lang",
)
def country_scoped(spark, sf_dir):
    """A blank query in the scope of each language: ``*`` analyses to no term and finds nothing."""
    docs = table(spark, sf_dir, "documents")
    index = build_index(docs, ["text"], "standard")
    scopes = docs.select("lang").distinct()
    asked = scoped_queries(scopes, "", "lang")
    tagged = docs.select("doc_id", F.array("lang").alias("origin_country"))
    hits = sparse_search(asked, index, tagged, fields={"text": 1.0}, fuzzy=None)
    counts = hits.groupBy("query_id").agg(F.count("*").alias("n"))
    return asked.select("query_id").join(counts, "query_id", "left").select(
        "query_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("hits")
    )


@query(
    "search_k_over_100",
    f"WITH {_tables(sql.tokens)}, {_ONE_FIELD} SELECT query_id, rank, doc_id, round(score, 4) AS score FROM ranked "
    "WHERE rank <= CASE WHEN query_id % 2 = 0 THEN 150 ELSE 3 END",
)
def search_k_over_100(spark, sf_dir):
    """The operator itself has no largest k (a request has), and every query has its own."""
    index = build_index(table(spark, sf_dir, "documents"), ["text"], "standard")
    own = F.when(F.col("query_id") % 2 == 0, 150).otherwise(3)
    return sparse_search(benchmark_queries(spark, sf_dir).withColumn("top_k", own), index, fields={"text": 1.0}, fuzzy=None)


@query(
    "empty_country",
    f"WITH {_tables(sql.tokens)}, {_SCORES}, best AS (SELECT query_id, doc_id, s AS score FROM scores "
    "JOIN documents USING (doc_id) WHERE query_id % 2 = 0 OR lang = 'fr'), "
    f"{_ranked('best')} {_HITS}",
)
def empty_country(spark, sf_dir):
    """An empty country is no filter."""
    docs = table(spark, sf_dir, "documents")
    index = build_index(docs, ["text"], "standard")
    asked = benchmark_queries(spark, sf_dir).withColumn("country", F.when(F.col("query_id") % 2 == 0, "").otherwise("fr"))
    tagged = docs.select("doc_id", F.array("lang").alias("origin_country"))
    return sparse_search(asked, index, tagged, fields={"text": 1.0}, fuzzy=None, top_k=K)
