"""Record preparation, facets, discovery, merging, reports, sources and sinks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.text import analyze
from marquee.functions.values import (
    as_int, bucket, count_band, external_links, fallback_id, ordered_distinct, passage, utc_text,
)
from marquee.operators import discover as disco
from marquee.operators.dedup import dedup_first, limit_first
from marquee.operators.facets import (
    band_histogram, facet_counts, index_status, matched_shapes, shape_counts, translate_codes,
)
from marquee.operators.merge import gather_first, merge_entities, pending
from marquee.operators.postings import build_index
from marquee.operators.records import catalogue_slice, dense_metadata, is_movie_record, key_crew, normalize, to_sparse_json, write_rejects
from marquee.operators.report import (
    build_counters, crawl_stats, discovery_counters, fetch_counters, progress_checkpoints, runtime_sweep, stored_size, throughput,
)
from marquee.operators.search import sparse_hits, with_links
from marquee.operators.sparse import sparse_search
from marquee.plans import check_sql as sql
from marquee.plans import views
from marquee.plans.build import prepare
from marquee.plans.registry import query
from marquee.plans.search_queries import _SCORES, _ranked, _tables
from marquee.plans.views import table
from marquee.schemas import FIELD_BOOSTS
from marquee.session import materialise, scratch_path
from marquee.sources import catalogue as store
from marquee.sources import files, sinks
from marquee.streaming import ledger

# -- check SQL for the movie-shaped view ------------------------------------------------------

_LANG = "['en', 'es', 'fr', 'de', 'ja'][o_custkey % 5 + 1]"
_JOB = "['Director', 'Producer', 'Grip'][o_custkey % 3 + 1]"
_WS = "' \t\n\r'"

_VIEW = (
    "lines AS (SELECT l_orderkey AS id, l_linenumber, s_suppkey, s_name, l_returnflag, n_name, p_size, p_type FROM lineitem "
    "JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey), "
    "casted AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY l_linenumber, s_suppkey, s_name, l_returnflag) AS rn FROM lines) WHERE rn <= 20), "
    "cast_n AS (SELECT id, string_agg(s_name, '|' ORDER BY r) AS cast_names FROM (SELECT id, s_name, min(rn) AS r FROM casted GROUP BY ALL) GROUP BY id), "
    "cast_five AS (SELECT id, string_agg(s_name, ' ' ORDER BY rn) AS five FROM casted WHERE rn <= 5 GROUP BY id), "
    "cast_c AS (SELECT id, string_agg(l_returnflag, '|' ORDER BY r) AS cast_characters FROM (SELECT id, l_returnflag, min(rn) AS r FROM casted GROUP BY ALL) GROUP BY id), "
    "genre_n AS (SELECT id, string_agg(p_type, '|' ORDER BY s, p_type) AS genres FROM (SELECT id, p_type, min(p_size) AS s FROM lines GROUP BY ALL) GROUP BY id), "
    "genre_i AS (SELECT id, string_agg(CAST(p_size AS VARCHAR), '|' ORDER BY p_size, p_type) AS genre_ids, "
    "string_agg(p_type, ' ' ORDER BY p_size, p_type) AS genre_all FROM (SELECT DISTINCT id, p_size, p_type FROM lines) GROUP BY id), "
    "country AS (SELECT id, string_agg(n_name, '|' ORDER BY n_name) AS origin_country FROM (SELECT DISTINCT id, n_name FROM lines) GROUP BY id), "
    f"turns AS (SELECT conv_id AS id, role, trim(text, {_WS}) AS content, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM conversations), "
    "review AS (SELECT id, string_agg(left(content, 2000), ' ' ORDER BY rn) AS reviews_text, count(*) AS n_reviews FROM turns WHERE rn <= 10 AND content <> '' GROUP BY id), "
    "author AS (SELECT id, string_agg(role, '|' ORDER BY r) AS review_authors FROM (SELECT id, role, min(rn) AS r FROM turns WHERE rn <= 10 GROUP BY ALL) GROUP BY id), "
    f"movies AS (SELECT o_orderkey AS id, 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS imdb_id, o_orderpriority AS title, c_mktsegment AS tagline, "
    f"strftime(o_orderdate, '%Y-%m-%d') AS release_date, o_orderstatus AS status, {_LANG} AS original_language, o_totalprice AS popularity, "
    f"CAST(floor(o_totalprice) % 2000 AS INTEGER) AS vote_count, c_name, {_JOB} AS job, genres, genre_ids, genre_all, cast_names, cast_characters, five, "
    "origin_country, reviews_text, coalesce(n_reviews, 0) AS n_reviews, coalesce(review_authors, '') AS review_authors "
    "FROM orders JOIN customer ON c_custkey = o_custkey JOIN genre_n g ON g.id = o_orderkey JOIN genre_i USING (id) JOIN cast_n USING (id) JOIN cast_c USING (id) "
    "JOIN cast_five USING (id) JOIN country USING (id) LEFT JOIN review USING (id) LEFT JOIN author USING (id))"
)
_ALL_TEXT = "concat_ws(' ', title, tagline, replace(genres, '|', ' '), replace(cast_names, '|', ' '), c_name, reviews_text)"


def _bars(df, *columns):
    """Array columns as bar-joined text, so that rows compare alike in every engine."""
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


# -- records ----------------------------------------------------------------------------------

@query(
    "normalize_movie",
    f"WITH {_VIEW} SELECT CAST(id AS VARCHAR) AS doc_id, id AS movie_id, imdb_id, title, tagline, release_date, "
    "CAST(left(release_date, 4) AS INTEGER) AS release_year, status, original_language, popularity, vote_count, genres, genre_ids, "
    f"cast_names, cast_characters, c_name AS crew_names, job AS crew_jobs, review_authors, CAST(n_reviews AS INTEGER) AS review_count, "
    f"false AS adult, origin_country, md5({_ALL_TEXT}) AS all_text_digest, 'orders' AS source_path FROM movies",
)
def normalize_movie(spark, sf_dir):
    """Raw JSON text of every movie to its normalised document."""
    docs = normalize(views.records(spark, sf_dir))
    docs = _bars(docs, "genres", "genre_ids", "cast_names", "cast_characters", "crew_names", "crew_jobs", "review_authors", "origin_country")
    return docs.select(
        "doc_id", "movie_id", "imdb_id", "title", "tagline", "release_date", "release_year", "status", "original_language",
        "popularity", "vote_count", "genres", "genre_ids", "cast_names", "cast_characters", "crew_names", "crew_jobs",
        "review_authors", "review_count", "adult", "origin_country", F.md5("all_text").alias("all_text_digest"), "source_path",
    )


@query("all_text", f"WITH {_VIEW} SELECT id AS movie_id, {_ALL_TEXT} AS all_text FROM movies")
def all_text(spark, sf_dir):
    return normalize(views.records(spark, sf_dir)).select("movie_id", "all_text")


@query(
    "passage_text",
    f"WITH {_VIEW} SELECT id, 'Title: ' || title || ' ' || title || ' ' || title || '\n    Overview: \n    Tagline: ' || tagline || "
    "'\n    Genres: ' || genre_all || '\n    Cast: ' || five || '\n    Director:' || CASE WHEN job = 'Director' THEN ' ' || c_name ELSE '' END AS passage FROM movies",
)
def passage_text(spark, sf_dir):
    text = passage(F.col("title"), F.lit(None).cast("string"), F.col("tagline"), F.col("genres"), F.col("cast"), F.col("crew"))
    return views.movies(spark, sf_dir).select("id", text.alias("passage"))


_BODIES = (
    "bodies AS (SELECT 'events' AS source_path, props AS body FROM events UNION ALL SELECT 'documents', text FROM documents "
    "UNION ALL SELECT 'benchmark', '{\"title\":\"' || item_id || '\",\"imdb_id\":\"tt' || item_id || '\",\"cast\":null}' FROM benchmark)"
)


def _bodies(spark, sf_dir):
    """Valid JSON that is no movie, text that is no JSON, and minimal movies without an id."""
    parts = [
        table(spark, sf_dir, "events").select(F.lit("events").alias("source_path"), F.col("props").alias("body")),
        table(spark, sf_dir, "documents").select(F.lit("documents").alias("source_path"), F.col("text").alias("body")),
        table(spark, sf_dir, "benchmark").select(
            F.lit("benchmark").alias("source_path"),
            F.format_string('{"title":"%d","imdb_id":"tt%d","cast":null}', "item_id", "item_id").alias("body"),
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "movie_shape_filter",
    f"WITH {_BODIES} SELECT source_path, count(*) AS rows, count(CASE WHEN source_path = 'benchmark' THEN 1 END) AS movies FROM bodies GROUP BY source_path",
)
def movie_shape_filter(spark, sf_dir):
    rows = _bodies(spark, sf_dir).withColumn("record", F.try_parse_json("body"))
    movie = F.coalesce(is_movie_record(F.col("record")), F.lit(False))
    return rows.groupBy("source_path").agg(F.count("*").alias("rows"), F.count_if(movie).alias("movies"))


@query(
    "json_errors",
    f"WITH {_BODIES} SELECT source_path, count(*) AS rows, count(CASE WHEN NOT json_valid(body) THEN 1 END) AS errors FROM bodies GROUP BY source_path",
)
def json_errors(spark, sf_dir):
    records = files.decode_json(_bodies(spark, sf_dir))
    return records.groupBy("source_path").agg(F.count("*").alias("rows"), F.count_if(F.col("record").isNull()).alias("errors"))


@query("json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("source_path"), F.col("props").alias("body"))
    return files.decode_json(rows).select(F.col("source_path").cast("bigint").alias("event_id"), as_int(F.col("record"), "$.k").alias("k"))


@query(
    "json_array_rows",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(e AS BIGINT) AS element FROM events, (VALUES (0), (2)) t(e)",
)
def json_array_rows(spark, sf_dir):
    """A top-level array opens to one row per object; the number between them vanishes."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("source_path"), F.concat(F.lit("["), "props", F.lit(",7,"), "props", F.lit("]")).alias("body")
    )
    return files.decode_json(rows).select(
        F.col("source_path").cast("bigint").alias("event_id"), as_int(F.col("record"), "$.k").alias("k"), F.col("pos.minor").alias("element")
    )


@query(
    "jsonl_lines",
    "WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM documents) "
    f"SELECT doc_id, count(*) AS lines FROM l WHERE trim(line, {_WS}) <> '' AND NOT json_valid(line) GROUP BY doc_id",
)
def jsonl_lines(spark, sf_dir):
    """Documents read as JSONL: each non-blank line that does not parse is one error."""
    rows = table(spark, sf_dir, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".jsonl")).alias("source_path"), F.col("text").alias("body")
    )
    bad = files.parse_errors(files.decode_json(files.split_lines(rows)))
    counts = bad.groupBy("source_path").agg(F.count("*").alias("lines"))
    return counts.select(F.substring_index("source_path", ".", 1).cast("bigint").alias("doc_id"), "lines")


@query(
    "fallback_id",
    "SELECT page_id, 'sha1_' || sha1(url || '|' || '' || '|' || '' || '|' || CAST(page_id AS VARCHAR)) AS doc_id FROM pages",
)
def fallback_ids(spark, sf_dir):
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "pages").select(
        "page_id", fallback_id(F.col("url"), none, none, F.col("page_id").cast("string")).alias("doc_id")
    )


@query(
    "ordered_distinct",
    f"WITH t AS MATERIALIZED (SELECT conv_id, turn, {sql.tokens('text')} AS toks FROM conversations), "
    "u AS (SELECT conv_id, turn, unnest(toks) AS w, unnest(range(len(toks))) AS i FROM t), "
    "f AS (SELECT conv_id, turn, w, min(i) AS i FROM u GROUP BY ALL) SELECT conv_id, turn, string_agg(w, ' ' ORDER BY i) AS words FROM f GROUP BY conv_id, turn",
)
def ordered_distinct_words(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", analyze(F.col("text"), "standard").alias("t"))
    return rows.where(F.size("t") > 0).select("conv_id", "turn", F.array_join(ordered_distinct(F.col("t")), " ").alias("words"))


@query(
    "sparse_json",
    f"WITH {_VIEW} SELECT CAST(id AS VARCHAR) AS doc_id, 0 AS has_null, 1 AS has_genres, 0 AS has_overview FROM movies",
)
def sparse_json(spark, sf_dir):
    """Stored JSON has no null or empty-text keys; arrays stay even when empty."""
    body = to_sparse_json(normalize(views.records(spark, sf_dir)))
    return body.select(
        "doc_id",
        F.col("body").contains(":null").cast("int").alias("has_null"),
        F.col("body").contains('"genres":[').cast("int").alias("has_genres"),
        F.col("body").contains('"overview"').cast("int").alias("has_overview"),
    )


@query(
    "dense_metadata",
    f"WITH {_VIEW} SELECT id, imdb_id, title, genre_all AS genres, release_date, origin_country, CAST(n_reviews AS INTEGER) AS n_reviews FROM movies",
)
def metadata(spark, sf_dir):
    none = F.lit(None).cast("string")
    typed = views.movies(spark, sf_dir).withColumns(
        {"overview": none, "vote_average": F.lit(None).cast("double"), "production_countries": F.lit(None).cast("array<struct<iso_3166_1:string,name:string>>")}
    )
    rows = dense_metadata(typed)
    return rows.select(
        "id", "imdb_id", "title", F.array_join("genres", " ").alias("genres"), "release_date",
        F.array_join("origin_country", "|").alias("origin_country"), F.size("reviews").alias("n_reviews"),
    )


@query(
    "write_rejects",
    "SELECT url, page_id, CASE WHEN try_cast(left(split_part(url, '/', 5), 10) AS DATE) IS NULL THEN 'release_date' END AS reject_reason FROM pages",
)
def rejects(spark, sf_dir):
    """URL path parts as dates: a typed index refuses what is no date."""
    rows = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.substring(F.split_part("url", F.lit("/"), F.lit(5)), 1, 10).alias("release_date"), F.lit(None).cast("string").alias("crawled_at")
    )
    return write_rejects(rows).select("url", "page_id", "reject_reason")


@query(
    "crew_filter",
    f"SELECT o_orderkey AS id, CASE WHEN {_JOB} = 'Grip' THEN '' ELSE {_JOB} END AS jobs, CASE WHEN {_JOB} = 'Grip' THEN '' ELSE c_name END AS names "
    "FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)",
)
def crew_filter(spark, sf_dir):
    rows = views.movies(spark, sf_dir).select("id", key_crew(F.col("crew")).alias("crew"))
    joined = lambda f: F.array_join(F.transform("crew", lambda c: c[f]), "|")
    return rows.select("id", joined("job").alias("jobs"), joined("name").alias("names"))


@query(
    "external_links",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'https://www.imdb.com/title/tt' || o_custkey || '/' END AS imdb_url, "
    "'https://www.themoviedb.org/movie/' || o_orderkey AS page_url FROM orders",
)
def links(spark, sf_dir):
    imdb = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("tt"), F.col("o_custkey").cast("string"))).otherwise("")
    imdb_url, page_url = external_links(imdb, F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", imdb_url.alias("imdb_url"), page_url.alias("page_url"))


@query("utc_text", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS crawled_at FROM events")
def crawl_times(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", utc_text(F.col("ts").cast("timestamp")).alias("crawled_at"))


# -- deduplication, limits ----------------------------------------------------------------------

@query("dedup_first", "SELECT md5(text) AS key, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def first_copies(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.md5("text").alias("key"), "doc_id")
    return dedup_first(rows, ["key"], ["doc_id"])


@query(
    "max_docs",
    "SELECT min(doc_id) AS doc_id, md5(text) AS key FROM documents GROUP BY 2 ORDER BY 1 LIMIT 100",
)
def max_docs(spark, sf_dir):
    """The document limit counts after deduplication, in reading order."""
    rows = table(spark, sf_dir, "documents").select(F.md5("text").alias("key"), "doc_id")
    return limit_first(dedup_first(rows, ["key"], ["doc_id"]), 100, ["doc_id"])


@query(
    "build_counters",
    f"WITH {_BODIES}, m AS (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey), "
    "b AS (SELECT count(CASE WHEN json_valid(body) THEN 1 END) AS ok, count(CASE WHEN NOT json_valid(body) THEN 1 END) AS bad FROM bodies), "
    "i AS (SELECT count(*) AS n FROM benchmark) "
    "SELECT 4 AS files_seen, CAST(b.ok + 2 * m.n AS BIGINT) AS docs_seen, CAST(b.ok - i.n AS BIGINT) AS docs_skipped_non_movie, "
    "CAST(b.bad AS BIGINT) AS parse_errors, CAST(m.n + i.n AS BIGINT) AS docs_prepared, CAST(m.n AS BIGINT) AS docs_skipped_duplicate FROM m, b, i",
)
def counters(spark, sf_dir):
    """Build counters over clean movies (twice), JSON that is no movie, and text that is no JSON."""
    movies = views.records(spark, sf_dir)
    records = movies.unionByName(movies).unionByName(files.decode_json(_bodies(spark, sf_dir)))
    return build_counters(records, prepare(records))


# -- facets ---------------------------------------------------------------------------------------

_FACET = "facet AS (SELECT n_name AS country_code, count(DISTINCT l_orderkey) AS count FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1)"


def _line_countries(spark, sf_dir):
    """Orders with the distinct nations of their suppliers."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").join(supplier, "l_suppkey").join(nation, "s_nationkey")
    return lines.groupBy("l_orderkey").agg(F.collect_set("n_name").alias("origin_country"))


@query("facet_docs", f"WITH {_FACET} SELECT * FROM facet")
def facet_docs(spark, sf_dir):
    return facet_counts(_line_countries(spark, sf_dir))


@query(
    "facet_occurrences",
    f"SELECT term AS country_code, count(*) AS count FROM (SELECT unnest({sql.tokens('text')}) AS term FROM documents) GROUP BY term",
)
def facet_occurrences(spark, sf_dir):
    """Occurrences over an array with repeats: the words of every document."""
    words = table(spark, sf_dir, "documents").select(analyze(F.col("text"), "standard").alias("words"))
    return facet_counts(words, "words", per="occurrence")


_BAND = (
    "CASE WHEN count > 10000 THEN 8 WHEN count > 5000 THEN 7 WHEN count > 2000 THEN 6 WHEN count > 1000 THEN 5 "
    "WHEN count > 500 THEN 4 WHEN count > 100 THEN 3 WHEN count > 10 THEN 2 WHEN count > 0 THEN 1 ELSE 0 END"
)


@query(
    "facet_bins",
    f"WITH f AS (SELECT term, count(*) AS count FROM (SELECT unnest({sql.tokens('text')}) AS term FROM documents) GROUP BY term) "
    f"SELECT {_BAND} AS band, count(*) AS n FROM f GROUP BY 1",
)
def facet_bins(spark, sf_dir):
    return band_histogram(facet_occurrences(spark, sf_dir))


@query(
    "index_status",
    f"WITH {_FACET} SELECT 'l_orderkey|origin_country' AS fields, true AS has_facet, count(*) AS country_total, "
    "(SELECT string_agg(country_code || '=' || count, '|') FROM (SELECT * FROM facet ORDER BY count DESC, country_code LIMIT 10)) AS country_sample FROM facet",
)
def status(spark, sf_dir):
    row = index_status(_line_countries(spark, sf_dir))
    sample = F.array_join(F.transform("country_sample", lambda b: F.concat_ws("=", b["country_code"], b["count"].cast("string"))), "|")
    return row.select(F.array_join("fields", "|").alias("fields"), "has_facet", "country_total", sample.alias("country_sample"))


_SHAPES = (
    "shapes AS (SELECT n_name AS a3, CASE WHEN n_nationkey % 3 = 0 THEN 'F' || n_nationkey END AS iso_a2, n_nationkey FROM nation), "
    "codes AS (SELECT n_name AS a3, CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'N' || n_nationkey END AS a2 FROM nation WHERE n_nationkey % 2 = 0), "
    "tr AS (SELECT s.a3, coalesce(nullif(c.a2, ''), nullif(iso_a2, ''), s.a3) AS a2, n_nationkey FROM shapes s LEFT JOIN codes c ON c.a3 = s.a3)"
)


def _shapes(spark, sf_dir):
    """Nations as map shapes: some coded, some with an empty code, some only with a fallback."""
    nation = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    shapes = nation.select(
        F.col("n_name").alias("a3"), F.when(key % 3 == 0, F.concat(F.lit("F"), key.cast("string"))).alias("iso_a2"), key
    )
    codes = nation.where(key % 2 == 0).select(
        F.col("n_name").alias("a3"), F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("N"), key.cast("string"))).alias("a2")
    )
    return translate_codes(shapes, codes)


@query("facet_code_join", f"WITH {_SHAPES} SELECT a3, a2 FROM tr")
def facet_code_join(spark, sf_dir):
    return _shapes(spark, sf_dir).select("a3", "a2")


_COUNTED = (
    f"WITH {_SHAPES}, cc AS (SELECT a2 AS country_code, count(DISTINCT o_orderkey) AS count FROM orders JOIN customer ON c_custkey = o_custkey "
    "JOIN tr ON tr.n_nationkey = c_nationkey WHERE n_nationkey % 4 > 0 GROUP BY a2) "
)


def _shape_facets(spark, sf_dir):
    """Orders per customer nation code; nations divisible by 4 have no orders on the map."""
    shapes = _shapes(spark, sf_dir)
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(customer, "o_custkey")
    coded = orders.join(shapes.where(F.col("n_nationkey") % 4 > 0), "n_nationkey")
    return shapes, facet_counts(coded.select(F.array("a2").alias("origin_country")))


@query("facet_shapes", _COUNTED + f"SELECT a3, tr.a2, coalesce(count, 0) AS count, {_BAND} AS band FROM tr LEFT JOIN cc ON cc.country_code = tr.a2")
def facet_shapes(spark, sf_dir):
    return shape_counts(*_shape_facets(spark, sf_dir)).select("a3", "a2", "count", "band")


@query("facet_matched", _COUNTED + "SELECT count(*) AS matched FROM tr WHERE a2 IN (SELECT country_code FROM cc)")
def facet_matched(spark, sf_dir):
    return matched_shapes(*_shape_facets(spark, sf_dir))


# -- discovery --------------------------------------------------------------------------------------

_GENRES = ", ".join(map(str, disco.GENRES))
_CATALOGUE = (
    f"cat AS (SELECT o_orderkey AS id, o_totalprice AS popularity, CAST(floor(o_totalprice) % 2000 AS INTEGER) AS vote_count, "
    f"CAST(year(o_orderdate) AS INTEGER) AS y, {_LANG} AS lang FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)), "
    "gen AS (SELECT DISTINCT l_orderkey AS id, p_size AS g FROM lineitem JOIN part ON p_partkey = l_partkey), "
    "ranges(lo, hi) AS (VALUES (0, 10), (10, 100), (100, 1000), (1000, 100000)), "
    "slices AS (SELECT 'genre_' || g || '_vote_' || lo || '_' || hi AS slice, id, vote_count, popularity FROM cat JOIN gen USING (id) "
    f"JOIN ranges ON vote_count BETWEEN lo AND hi WHERE g IN ({_GENRES}) "
    "UNION ALL SELECT 'year_' || y, id, vote_count, popularity FROM cat WHERE y BETWEEN 1970 AND 2026 "
    "UNION ALL SELECT 'lang_' || lang, id, vote_count, popularity FROM cat WHERE lang IN ('en', 'es', 'fr', 'de', 'ja', 'ko', 'zh', 'hi', 'it', 'pt')), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY slice ORDER BY popularity DESC, id) AS rank FROM slices)"
)


@query("discover_slices", f"WITH {_CATALOGUE} SELECT slice, id, rank, CAST(ceil(rank / 20.0) AS INTEGER) AS page FROM ranked WHERE rank <= 40")
def discover_slices(spark, sf_dir):
    """First two pages of every slice."""
    return disco.listed(views.catalogue(spark, sf_dir), pages=2).select("slice", "id", "rank", "page")


@query(
    "discover",
    f"WITH {_CATALOGUE} SELECT DISTINCT id AS movie_id, vote_count, popularity FROM ranked WHERE rank <= 10000 AND id <> 0",
)
def discover_all(spark, sf_dir):
    """All strategies at full depth (500 pages of 20 per slice), overlap removed."""
    return disco.discover(views.catalogue(spark, sf_dir))


@query(
    "discover_counters",
    f"WITH {_CATALOGUE} SELECT count(*) AS total_discovered, count(DISTINCT id) AS unique_discovered, count(*) - count(DISTINCT id) AS duplicates_skipped "
    "FROM ranked WHERE rank <= 10000 AND id <> 0",
)
def discover_counts(spark, sf_dir):
    return discovery_counters(disco.listed(views.catalogue(spark, sf_dir)))


@query(
    "catalogue_slice",
    f"WITH {_CATALOGUE} SELECT id, vote_count, popularity FROM cat WHERE id IN (SELECT id FROM gen WHERE g = 28) AND vote_count BETWEEN 100 AND 1000 AND lang = 'en'",
)
def one_slice(spark, sf_dir):
    rows = catalogue_slice(views.catalogue(spark, sf_dir), genre=28, votes=(100, 1000), language="en")
    return rows.select("id", "vote_count", "popularity")


@query(
    "slice_plan",
    f"WITH {_CATALOGUE}, n AS (SELECT slice, CAST(least(ceil(count(*) / 20.0), 500) AS INTEGER) AS pages FROM slices GROUP BY slice) "
    "SELECT slice, CAST(unnest(range(1, pages + 1)) AS INTEGER) AS page FROM n",
)
def slice_plan(spark, sf_dir):
    return disco.page_plan(views.catalogue(spark, sf_dir))


# -- merge, resume, statistics ------------------------------------------------------------------------

@query(
    "entity_merge",
    "WITH c AS (SELECT * FROM (SELECT l_orderkey AS id, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS rn FROM lineitem) WHERE rn <= 20), "
    "cs AS (SELECT id, string_agg(CAST(l_suppkey AS VARCHAR), '|' ORDER BY rn) AS members FROM c GROUP BY id), "
    "r AS (SELECT * FROM (SELECT conv_id AS id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS rn FROM conversations) WHERE rn <= 10), "
    "rs AS (SELECT id, string_agg(role, '|' ORDER BY rn) AS roles, CAST(count(*) AS INTEGER) AS n FROM r GROUP BY id) "
    f"SELECT o_orderkey AS movie_id, coalesce(members, '') AS cast_ids, CASE WHEN members IS NULL OR {_JOB} = 'Grip' THEN '' ELSE {_JOB} END AS crew_jobs, "
    "coalesce(roles, '') AS usernames, coalesce(n, 0) AS review_count FROM orders LEFT JOIN cs ON cs.id = o_orderkey LEFT JOIN rs ON rs.id = o_orderkey",
)
def entity_merge(spark, sf_dir):
    """Orders as details, their lines as credits, conversations as reviews."""
    orders = table(spark, sf_dir, "orders")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("movie_id"), "l_linenumber", F.col("l_suppkey").alias("id"))
    cast = gather_first(rows, "movie_id", ["l_linenumber", "id"], ["id"], 20, "cast")
    job = F.element_at(F.array(*[F.lit(j) for j in views.VIEW_JOBS]), (F.col("o_custkey") % 3 + 1).cast("int"))
    crew = orders.select(
        F.col("o_orderkey").alias("movie_id"),
        F.array(F.struct(F.col("o_custkey").alias("id"), F.lit("").alias("name"), job.alias("job"), F.lit("").alias("department"))).alias("crew"),
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("movie_id"), "turn", F.col("turn").cast("string").alias("id"), F.col("role").alias("author"),
        F.struct(F.col("role").alias("username"), F.lit(None).cast("double").alias("rating")).alias("author_details"),
        F.col("text").alias("content"), F.lit("").alias("created_at"),
    )
    reviews = gather_first(turns, "movie_id", ["turn", "author"], ["id", "author", "author_details", "content", "created_at"], 10, "results")
    merged = merge_entities(orders.select(F.col("o_orderkey").alias("movie_id")), cast.join(crew, "movie_id"), reviews)
    names = lambda c, f: F.array_join(F.transform(c, lambda x: x[f]), "|")
    return merged.select(
        "movie_id", F.array_join(F.transform("cast", lambda x: x["id"].cast("string")), "|").alias("cast_ids"),
        names("crew", "job").alias("crew_jobs"), names("reviews", "author_username").alias("usernames"), "review_count",
    )


@query("resume_antijoin", "SELECT o_orderkey AS movie_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def resume(spark, sf_dir):
    stored = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("movie_id"))
    return pending(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("movie_id")), stored)


@query(
    "fetch_counters",
    "WITH s AS (SELECT DISTINCT conv_id FROM conversations), f AS (SELECT DISTINCT l_orderkey FROM lineitem) "
    "SELECT count(*) AS total_ids, count(s.conv_id) AS skipped_existing, count(CASE WHEN s.conv_id IS NULL AND l_orderkey IS NOT NULL THEN 1 END) AS fetched, "
    "count(CASE WHEN s.conv_id IS NULL AND l_orderkey IS NULL THEN 1 END) AS failed FROM orders LEFT JOIN s ON conv_id = o_orderkey LEFT JOIN f ON l_orderkey = o_orderkey",
)
def fetches(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("movie_id"))
    stored = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("movie_id"))
    return fetch_counters(ids, stored, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("movie_id")))


@query(
    "crawl_stats",
    f"WITH {_VIEW}, n AS (SELECT count(*) AS cast_rows FROM casted JOIN movies USING (id)), t AS (SELECT count(*) AS turns FROM turns JOIN movies USING (id) WHERE rn <= 10) "
    "SELECT count(*) AS movies_processed, count(CASE WHEN n_reviews > 0 THEN 1 END) AS movies_with_reviews, any_value(turns) AS total_reviews, "
    "any_value(cast_rows) AS total_cast, count(*) AS total_crew FROM movies, n, t",
)
def crawl(spark, sf_dir):
    return crawl_stats(views.movies(spark, sf_dir))


@query("stored_size")
def size(spark, sf_dir):
    """Bytes of the stored order files (file metadata; not visible to SQL)."""
    return stored_size(table(spark, sf_dir, "orders"))


@query(
    "throughput",
    "SELECT event_type, count(*) AS indexed_docs, CAST(epoch(max(ts)) - epoch(min(ts)) AS DOUBLE) AS duration_sec, "
    "round(count(*) / greatest(epoch(max(ts)) - epoch(min(ts)), 1e-6), 2) AS docs_per_sec FROM events GROUP BY event_type",
)
def rates(spark, sf_dir):
    seconds = lambda c: F.col(c).cast("timestamp").cast("double")
    runs = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count("*").alias("indexed_docs"), (F.max(seconds("ts")) - F.min(seconds("ts"))).alias("duration_sec")
    )
    return throughput(runs)


@query(
    "progress_checkpoints",
    "WITH e AS (SELECT event_type, epoch(ts) - epoch(min(ts) OVER (PARTITION BY event_type)) AS elapsed, "
    "row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n, count(*) OVER (PARTITION BY event_type) AS total FROM events) "
    "SELECT event_type, n, round(elapsed, 3) AS elapsed FROM e WHERE n % 500 = 0 OR n = total",
)
def checkpoints(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    starts = events.groupBy("event_type").agg(F.min("ts").alias("started"))
    log = events.join(starts, "event_type")
    return progress_checkpoints(log, "event_type", ["ts", "event_id"], "started", "ts", every=500)


@query(
    "runtime_sweep",
    "WITH n AS (SELECT count(*) AS n FROM documents), p AS (SELECT n * k // 4 AS max_docs FROM n, (VALUES (1), (2), (4)) t(k)) "
    "SELECT max_docs, max_docs AS prepared_docs, max_docs AS indexed_docs, CAST(0 AS BIGINT) AS failed_docs FROM p",
)
def sweep(spark, sf_dir):
    """The same index build at a quarter, half and all of the documents (times left out of the result)."""
    docs = table(spark, sf_dir, "documents")
    total = docs.count()

    def build(limit: int) -> dict:
        stored = materialise(limit_first(docs, limit, ["doc_id"]), "sweep")
        build_index(stored, ["text"], "standard")
        kept = stored.count()
        return {"prepared": kept, "indexed": kept}

    return runtime_sweep(spark, build, [total // 4, total // 2, total]).drop("duration_sec", "docs_per_sec")


# -- end to end ---------------------------------------------------------------------------------------

_MOVIE_FIELDS = " UNION ALL ".join(
    f"SELECT CAST(id AS VARCHAR) AS doc_id, '{field}' AS field, {text} AS text FROM movies"
    for field, text in (
        ("title", "title"), ("tagline", "tagline"), ("cast_names", "replace(cast_names, '|', ' ')"),
        ("crew_names", "c_name"), ("all_text", _ALL_TEXT),
    )
)
_BOOST = "CASE field " + " ".join(f"WHEN '{f}' THEN {b}" for f, b in FIELD_BOOSTS.items()) + " END"


def _movie_tables() -> str:
    analysed = lambda text: sql.no_stops(sql.tokens(text))
    body = _tables(analysed, _MOVIE_FIELDS)
    return body.replace("FROM benchmark", "FROM (SELECT n_nationkey AS item_id, 'Supplier#00000000' || n_nationkey || ' economy 5-LOW ' || n_name AS text FROM nation)")


@query(
    "movie_search_hits",
    f"WITH {_VIEW}, {_movie_tables()}, {_SCORES}, best AS (SELECT query_id, doc_id, max(s * {_BOOST}) AS score FROM scores GROUP BY query_id, doc_id), "
    f"{_ranked('best')} SELECT query_id, rank, r.doc_id AS movie_id, title, '' AS overview, round(score, 4) AS score, genres, origin_country AS countries, "
    "0.0::DOUBLE AS rating, left(release_date, 4) AS release_year, imdb_id, '' AS poster_path, 'https://www.imdb.com/title/' || imdb_id || '/' AS imdb_url, "
    "'https://www.themoviedb.org/movie/' || r.doc_id AS page_url FROM ranked r JOIN movies m ON CAST(m.id AS VARCHAR) = r.doc_id WHERE rank <= 10",
)
def movie_search_hits(spark, sf_dir):
    """JSON records to documents to index to ranked hits with their shown fields; one query per nation."""
    docs = prepare(views.records(spark, sf_dir)).drop("pos")
    index = build_index(docs, list(FIELD_BOOSTS), "english_no_stem")
    asked = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("query_id"),
        F.concat(F.lit("Supplier#00000000"), F.col("n_nationkey").cast("string"), F.lit(" economy 5-LOW "), F.col("n_name")).alias("query"),
    )
    hits = sparse_search(asked, index, fuzzy=None, top_k=10)
    return _bars(with_links(sparse_hits(hits, docs)), "genres", "countries").drop("cast")


# -- sinks and streams --------------------------------------------------------------------------------

@query("bucketed_write_read", "SELECT o_orderkey AS id, o_orderstatus AS status, o_orderkey // 1000 AS bucket FROM orders WHERE o_orderkey <> 0")
def bucketed(spark, sf_dir):
    path = scratch_path(spark, "movies")
    sinks.write_movies(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")), path)
    return spark.read.schema("id bigint, status string, bucket bigint").json(path)


@query(
    "keyed_upsert",
    "SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CASE WHEN o_orderstatus = 'F' THEN 'second' ELSE 'first' END AS run FROM orders "
    "UNION ALL SELECT 'new-' || c_custkey, 'second' FROM customer",
)
def upsert(spark, sf_dir):
    """Two runs into one keyed table: stored keys are replaced, others stay, new ones arrive."""
    path = scratch_path(spark, "documents")
    none = F.lit(None).cast("string")
    keyed = lambda df, key, run: df.select(key.alias("doc_id"), F.lit(run).alias("run"), none.alias("release_date"), none.alias("crawled_at"))
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    store.write_documents(keyed(orders, key, "first"), path)
    fresh = keyed(orders.where(F.col("o_orderstatus") == "F"), key, "second").unionByName(
        keyed(table(spark, sf_dir, "customer"), F.concat(F.lit("new-"), F.col("c_custkey").cast("string")), "second")
    )
    store.write_documents(fresh, path)
    return store.stored_documents(spark, path).select("doc_id", "run")


@query(
    "ledger_roundtrip",
    "SELECT o_orderkey AS movie_id, CAST(floor(o_totalprice) % 2000 AS INTEGER) AS vote_count, o_totalprice AS popularity FROM orders WHERE o_orderkey <> 0",
)
def ledger_roundtrip(spark, sf_dir):
    """Two appends of the same ids, read back once each."""
    path = scratch_path(spark, "ledger")
    ids = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("movie_id"), (F.floor("o_totalprice") % 2000).cast("int").alias("vote_count"), F.col("o_totalprice").alias("popularity")
    )
    sinks.append_ledger(ids, path)
    sinks.append_ledger(ids, path)
    return files.read_ledger(spark, path)


@query("stream_dedup", "SELECT DISTINCT user_id FROM events WHERE user_id <> 0")
def stream_dedup(spark, sf_dir):
    """Events as a file stream: each user id once."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    stream = ledger.stream_ids(spark, sf_dir, schema, "parquet", "user_id", pathGlobFilter="events.parquet")
    target = scratch_path(spark, "stream")
    ledger.run_available(stream.select("user_id"), target, scratch_path(spark, "stream-state"))
    return spark.read.schema("user_id bigint").parquet(target)


@query("stream_replay", "SELECT DISTINCT user_id FROM events WHERE user_id <> 0")
def stream_replay(spark, sf_dir):
    """A stream run twice from one checkpoint into numbered batches: each user once."""
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    target, state = scratch_path(spark, "batches"), scratch_path(spark, "batches-state")
    for _ in range(2):
        stream = ledger.stream_ids(spark, sf_dir, schema, "parquet", "user_id", pathGlobFilter="events.parquet")
        ledger.run_batches(stream.select("user_id"), target, state)
    return spark.read.schema("user_id bigint").parquet(target).select("user_id")


@query("bucket_sizes", "SELECT o_orderkey // 1000 AS bucket, count(*) AS n FROM orders GROUP BY 1")
def bucket_sizes(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(bucket(F.col("o_orderkey")).alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "count_bands",
    "SELECT o_orderkey, CASE WHEN c > 10000 THEN 8 WHEN c > 5000 THEN 7 WHEN c > 2000 THEN 6 WHEN c > 1000 THEN 5 WHEN c > 500 THEN 4 "
    "WHEN c > 100 THEN 3 WHEN c > 10 THEN 2 WHEN c > 0 THEN 1 ELSE 0 END AS band FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) % 20000 AS c FROM orders)",
)
def bands(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", count_band(F.floor("o_totalprice") % 20000).alias("band"))


@query(
    "rewrite_bucket",
    "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE o_orderstatus END AS title "
    "FROM orders WHERE o_orderkey <> 0 AND o_orderkey % 4 <> 1 OR o_orderkey <> 0 AND o_orderkey % 3 = 0",
)
def rewrite_bucket(spark, sf_dir):
    """Two overlapping runs of the record store: the second replaces its ids and leaves all others."""
    path = scratch_path(spark, "store")
    orders = table(spark, sf_dir, "orders")
    first = orders.where("o_orderkey % 4 <> 1").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("title"))
    second = orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"))
    sinks.write_movies(first, path)
    sinks.write_movies(second, path)
    return spark.read.schema("id bigint, title string").json(path).select("id", "title")
