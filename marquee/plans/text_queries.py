"""Text analysis and index statistics over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.edits import allowed_edits
from marquee.functions.text import (
    analyze, ascii_fold, drop_possessive, drop_stop_words, fold_tokens, raw_keyword, tokenize, truncate,
)
from marquee.operators.postings import build_index, build_postings
from marquee.plans import check_sql as sql
from marquee.plans.registry import query
from marquee.plans.views import page_documents, table

_COUNTS = "SELECT doc_id, len(toks) AS n_tokens, len(list_distinct(toks)) AS n_terms, md5(array_to_string(toks, ' ')) AS digest"


def _token_summary(docs, tokens):
    rows = docs.select("doc_id", tokens.alias("toks"))
    return rows.select(
        "doc_id",
        F.size("toks").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("toks")).cast("bigint").alias("n_terms"),
        F.md5(F.array_join("toks", " ")).alias("digest"),
    )


@query("tokens_per_doc", f"{_COUNTS} FROM (SELECT doc_id, {sql.tokens('text')} AS toks FROM documents)")
def tokens_per_doc(spark, sf_dir):
    return _token_summary(table(spark, sf_dir, "documents"), analyze(F.col("text"), "standard"))


_ODD = " 90 m² x³ ﬁne ﬂow 5½ O’Neil’s"


@query(
    "tokens_before_folding",
    f"{_COUNTS} FROM (SELECT doc_id, {sql.tokens(f"(text || '{_ODD}')")} AS toks FROM documents)",
)
def tokens_before_folding(spark, sf_dir):
    """Words end before characters that only folding would turn into letters or digits."""
    return _token_summary(table(spark, sf_dir, "documents"), analyze(F.concat("text", F.lit(_ODD)), "standard"))


@query(
    "stopword_filter",
    f"{_COUNTS} FROM (SELECT doc_id, {sql.no_stops(sql.tokens('text'))} AS toks FROM documents)",
)
def stopword_filter(spark, sf_dir):
    return _token_summary(table(spark, sf_dir, "documents"), analyze(F.col("text"), "english_no_stem"))


@query("ascii_fold", f"SELECT doc_id, md5({sql.folded('text')}) AS digest FROM documents")
def fold_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(ascii_fold(F.lower("text"))).alias("digest"))


@query(
    "possessive",
    f"{_COUNTS} FROM (SELECT doc_id, {sql.english('text')} AS toks FROM documents)",
)
def possessive(spark, sf_dir):
    tokens = drop_stop_words(drop_possessive(fold_tokens(tokenize(F.col("text")))))
    return _token_summary(table(spark, sf_dir, "documents"), tokens)


@query(
    "stem_terms",
    f"WITH words AS (SELECT DISTINCT unnest({sql.english('text')}) AS term FROM documents), {sql.stems('words')} "
    "SELECT stem, count(*) AS n_words, min(term) AS first_word FROM stemmed GROUP BY stem",
)
def stem_terms(spark, sf_dir):
    """Vocabulary with its stems: how many distinct words share each stem."""
    from marquee.functions.text import stem_tokens

    tokens = drop_stop_words(drop_possessive(fold_tokens(tokenize(F.col("text")))))
    words = table(spark, sf_dir, "documents").select(F.explode(tokens).alias("term")).distinct()
    stems = words.select("term", F.element_at(stem_tokens(F.array("term")), 1).alias("stem"))
    return stems.groupBy("stem").agg(F.count("*").alias("n_words"), F.min("term").alias("first_word"))


@query(
    "analyze_english_stem",
    f"WITH rows AS (SELECT doc_id, unnest({sql.english('text')}) AS term FROM documents), {sql.stems('rows')} "
    "SELECT doc_id, count(*) AS n_tokens, count(DISTINCT stem) AS n_terms FROM rows JOIN stemmed USING (term) GROUP BY doc_id",
)
def analyze_english_stem(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", analyze(F.col("text"), "english_stem").alias("t"))
    return rows.where(F.size("t") > 0).select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.size(F.array_distinct("t")).cast("bigint").alias("n_terms")
    )


@query(
    "postings",
    f"WITH rows AS MATERIALIZED (SELECT doc_id, {sql.tokens('text')} AS toks FROM documents), "
    "terms AS (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM rows) "
    "SELECT doc_id, term, CAST(dl AS INTEGER) AS dl, CAST(count(*) AS INTEGER) AS tf FROM terms GROUP BY ALL",
)
def postings(spark, sf_dir):
    return build_postings(table(spark, sf_dir, "documents"), ["text"], "standard").select("doc_id", "term", "dl", "tf")


@query(
    "term_df",
    f"WITH rows AS (SELECT DISTINCT doc_id, unnest({sql.tokens('text')}) AS term FROM documents) "
    "SELECT 'text' AS field, term, count(*) AS df FROM rows GROUP BY term",
)
def term_df(spark, sf_dir):
    return build_index(table(spark, sf_dir, "documents"), ["text"], "standard").term_stats


@query(
    "field_stats",
    r"WITH p AS (SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, "
    r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), "
    r"'(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS body FROM pages), "
    f"t AS (SELECT 'title' AS field, len({sql.tokens('title')}) AS dl FROM p UNION ALL "
    f"SELECT 'all_text', len({sql.tokens('body')}) FROM p) "
    "SELECT field, count(*) AS n_docs, CAST(sum(dl) AS BIGINT) AS sum_dl FROM t WHERE dl > 0 GROUP BY field",
)
def field_stats(spark, sf_dir):
    return build_index(page_documents(spark, sf_dir), ["title", "all_text"], "standard").field_stats


@query("raw_keyword", "SELECT doc_id, CASE WHEN length(text) <= 512 THEN text END AS raw FROM documents")
def raw_keywords(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", raw_keyword(F.col("text")).alias("raw"))


@query(
    "text_truncation",
    "SELECT conv_id, turn, left(text, 2000) AS review, left(text, 300) AS overview, left(text, 200) AS snippet FROM conversations",
)
def text_truncation(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", truncate(text, 2000).alias("review"), truncate(text, 300).alias("overview"),
        truncate(text, 200).alias("snippet"),
    )


@query(
    "fuzzy_allowance",
    f"WITH rows AS (SELECT DISTINCT unnest({sql.tokens('text')}) AS term FROM benchmark) "
    "SELECT term, CASE WHEN length(term) <= 2 THEN 0 WHEN length(term) <= 5 THEN 1 ELSE 2 END AS edits FROM rows",
)
def fuzzy_allowance(spark, sf_dir):
    terms = table(spark, sf_dir, "benchmark").select(F.explode(analyze(F.col("text"), "standard")).alias("term"))
    return terms.distinct().select("term", allowed_edits(F.col("term")).alias("edits"))
