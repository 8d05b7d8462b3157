"""Record, index and ledger schemas, as DDL strings (every Spark reader takes these)."""

from __future__ import annotations

# Raw nested movie record, one JSON document each.
MOVIE_DDL = """
id bigint, imdb_id string, title string, original_title string, original_language string,
overview string, tagline string, release_date string, status string, vote_average double,
vote_count int, popularity double, runtime int, budget bigint, revenue bigint, adult boolean,
genres array<struct<id:int,name:string>>,
`cast` array<struct<id:bigint,name:string,character:string,order:int>>,
crew array<struct<id:bigint,name:string,job:string,department:string>>,
reviews array<struct<id:string,author:string,author_username:string,content:string,rating:double,created_at:string>>,
review_count int, poster_path string, backdrop_path string,
production_countries array<struct<iso_3166_1:string,name:string>>,
origin_country array<string>, homepage string, crawled_at string
"""

# Discovered-id ledger line.
LEDGER_DDL = "movie_id bigint, vote_count int, popularity double"

# Columns of a normalised document, in index order (the document key `doc_id` comes first).
INDEX_FIELDS = (
    "movie_id", "imdb_id", "title", "original_title", "overview", "tagline", "all_text",
    "release_date", "release_year", "status", "original_language", "genres", "genre_ids",
    "cast_names", "cast_characters", "crew_names", "crew_jobs", "review_authors",
    "reviews_text", "review_count", "vote_average", "vote_count", "popularity", "runtime",
    "budget", "revenue", "adult", "poster_path", "backdrop_path", "homepage",
    "origin_country", "crawled_at", "source_path",
)

# Searched fields and their boosts (fixed values).
FIELD_BOOSTS = {
    "title": 3.0,
    "original_title": 2.0,
    "overview": 2.0,
    "tagline": 1.5,
    "cast_names": 1.5,
    "crew_names": 1.0,
    "all_text": 1.0,
}

TERM_STATS_DDL = "field string, term string, df bigint"
FIELD_STATS_DDL = "field string, n_docs bigint, sum_dl bigint"
SPELLING_DDL = "size int, key bigint, term string"


def postings_ddl(key_type: str = "string") -> str:
    return f"doc_id {key_type}, field string, dl int, term string, tf int, head boolean"
