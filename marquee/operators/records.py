"""Record filters and the normalising projection of raw movie records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import truncate
from marquee.functions.values import (
    as_float,
    as_int,
    as_text,
    combined_text,
    fallback_id,
    get,
    int_list,
    key_present,
    passage,
    release_date,
    release_year,
    text_list,
    truthy,
)
from marquee.schemas import INDEX_FIELDS

# Fixed values.
SHAPE_KEYS = ("release_date", "vote_average", "runtime", "genres", "cast")
KEY_JOBS = ("Director", "Writer", "Screenplay", "Producer", "Executive Producer")
CAST_HEAD = 20
_TEXT_KEYS = (
    "imdb_id", "title", "original_title", "overview", "tagline", "status", "original_language",
    "poster_path", "backdrop_path", "homepage", "crawled_at",
)
_NUMBER_KEYS = (
    "id", "review_count", "vote_average", "vote_count", "popularity", "runtime", "budget", "revenue", "adult",
)
_LISTS = {"genres": ("id", "name"), "cast": ("name", "character"), "crew": ("name", "job"), "reviews": ("author", "content")}
_TEXTS = "struct<{}>".format(
    ", ".join(
        [f"`{k}`: string" for k in (*_TEXT_KEYS, "release_date", *_NUMBER_KEYS)]
        + [f"`{k}`: array<struct<{', '.join(f'`{f}`: string' for f in fields)}>>" for k, fields in _LISTS.items()]
        + ["origin_country: array<string>"]
    )
)
REVIEW_HEAD = 10


def is_movie_record(record: Column) -> Column:
    """A non-blank title, an id or a non-blank imdb id, and at least one of five keys present."""
    has_id = F.coalesce(F.schema_of_variant(get(record, "$.id")), F.lit("VOID")) != "VOID"
    shaped = key_present(record, SHAPE_KEYS[0])
    for key in SHAPE_KEYS[1:]:
        shaped |= key_present(record, key)
    return (as_text(record, "$.title") != "") & (has_id | (as_text(record, "$.imdb_id") != "")) & shaped


def is_api_error(record: Column) -> Column:
    """An error answer: a status code present and ``success`` false."""
    return key_present(record, "status_code") & (
        F.coalesce(get(record, "$.success", "string"), F.lit("")) == "false"
    )


def has_id(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is neither null nor zero."""
    return df.where(F.col(key).isNotNull() & (F.col(key) != 0))


def normalize(
    records: DataFrame, max_review_chars: int = 2000, max_cast: int = CAST_HEAD, max_reviews: int = REVIEW_HEAD, combined: bool = True,
    all_kinds: bool = False,
) -> DataFrame:
    """One flat document per movie record: ``doc_id`` plus `INDEX_FIELDS` (and ``pos``).

    Empty strings become NULL; empty arrays, zero and false stay.  The first ``max_cast`` cast entries and
    ``max_reviews`` reviews count, reviews up to ``max_review_chars``.  ``all_text`` repeats the other
    texts; without ``combined`` it is left out, to be added (`with_all_text`) after rows were shuffled.
    With ``all_kinds`` no row is left out and ``kind`` tells them apart: ``movie``, ``other`` (parsed, but no
    movie) and ``error`` (not parsed), so that one pass serves documents and counters.
    """
    rec = F.col("record")
    # One pass over the record: every value as text, lists as lists of texts.  A value of another
    # shape is NULL here, and the coercions look at the record itself where text does not decide.
    movie = F.coalesce(is_movie_record(rec), F.lit(False))
    kind = F.when(rec.isNull(), "error").when(movie, "movie").otherwise("other").alias("kind")
    rows = (records if all_kinds else records.where(movie)).withColumn("_t", get(rec, "$", _TEXTS))
    value = lambda key: F.col(f"_t.{key}")
    text = lambda key: as_text(rec, f"$.{key}", value(key))
    number = lambda key, kind: as_int(rec, f"$.{key}", kind, value(key)).alias(key)
    decimal = lambda key: as_float(rec, f"$.{key}", value(key)).alias(key)
    texts = lambda path, key, head=0, distinct=True: text_list(
        rec, f"$.{path}", key, F.col(f"_t.{path}.{key}"), head, distinct
    )
    flat = rows.select(
        "source_path",
        "pos",
        *([kind] if all_kinds else []),
        as_int(rec, "$.id", "bigint", value("id")).alias("movie_id"),
        *[text(key).alias(key) for key in _TEXT_KEYS],
        text("release_date").alias("_date_text"),
        texts("genres", "name").alias("genres"),
        int_list(rec, "$.genres", "id", F.col("_t.genres.id")).alias("genre_ids"),
        texts("cast", "name", max_cast).alias("cast_names"),
        texts("cast", "character", max_cast).alias("cast_characters"),
        texts("crew", "name").alias("crew_names"),
        texts("crew", "job").alias("crew_jobs"),
        texts("reviews", "author", max_reviews).alias("review_authors"),
        F.transform(
            texts("reviews", "content", max_reviews, False), lambda t: truncate(t, max_review_chars)
        ).alias("reviews_text"),
        as_int(rec, "$.review_count", "int", value("review_count")).alias("_review_count"),
        decimal("vote_average"),
        number("vote_count", "int"),
        decimal("popularity"),
        number("runtime", "int"),
        number("budget", "bigint"),
        number("revenue", "bigint"),
        truthy(rec, "$.adult", value("adult")).alias("adult"),
        F.coalesce(value("origin_country"), F.array().cast("array<string>")).alias("origin_country"),
    )
    done = flat.withColumns(
        {
            "doc_id": F.coalesce(
                F.col("movie_id").cast("string"), fallback_id(*map(F.col, ("title", "original_title", "_date_text", "imdb_id")))
            ),
            "release_date": release_date(F.col("_date_text")),
            "release_year": release_year(release_date(F.col("_date_text"))),
            "review_count": F.coalesce(F.col("_review_count"), F.size("reviews_text")),
        }
    )
    types = dict(done.dtypes)
    names = [c for c in INDEX_FIELDS if c != "all_text"]
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) if types[c] == "string" else F.col(c) for c in names]
    documents = done.select("doc_id", *fields, "pos", *(["kind"] if all_kinds else []))
    return with_all_text(documents) if combined else documents


def with_all_text(documents: DataFrame) -> DataFrame:
    """Documents with ``all_text``, in the order of `INDEX_FIELDS`."""
    joined = lambda c: F.array_join(c, " ")
    text = combined_text(
        *[F.coalesce(F.col(c), F.lit("")) for c in ("title", "original_title", "overview", "tagline")],
        *map(joined, ("genres", "cast_names", "crew_names", "reviews_text")),
    )
    whole = documents.withColumn("all_text", F.nullif(text, F.lit("")))
    return whole.select("doc_id", *INDEX_FIELDS, *[c for c in documents.columns if c not in ("doc_id", *INDEX_FIELDS)])


def to_sparse_json(documents: DataFrame) -> DataFrame:
    """``(doc_id, body)``: each document as JSON without its NULL fields."""
    return documents.select("doc_id", F.to_json(F.struct(*[c for c in INDEX_FIELDS if c in documents.columns])).alias("body"))


def write_rejects(documents: DataFrame) -> DataFrame:
    """Documents whose date fields an index with typed dates would refuse, with the reason."""
    date, stamp = F.col("release_date"), F.col("crawled_at")
    # Written out in full: a loose reading would also take "2020-1-1" or a bare time.
    shaped = date.rlike(r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$")
    bad_date = date.isNotNull() & ~(shaped & F.try_to_timestamp(date).isNotNull())
    bad_stamp = stamp.isNotNull() & F.try_to_timestamp(stamp).isNull()
    reason = F.when(bad_date, F.lit("release_date")).when(bad_stamp, F.lit("crawled_at"))
    return documents.withColumn("reject_reason", reason)


def embedding_passages(movies: DataFrame) -> DataFrame:
    """``(id, passage)`` of typed movie rows (`MOVIE_DDL`)."""
    text = passage(*(F.col(c) for c in ("title", "overview", "tagline", "genres", "cast", "crew")))
    return movies.select("id", text.alias("passage"))


def dense_metadata(movies: DataFrame) -> DataFrame:
    """The fields shown with a vector hit."""
    names = lambda c, f: F.coalesce(F.transform(c, lambda x: x[f]), F.array().cast("array<string>"))
    return movies.select(
        "id",
        "imdb_id",
        "title",
        "overview",
        names("genres", "name").alias("genres"),
        "release_date",
        "vote_average",
        names("production_countries", "name").alias("countries"),
        names("production_countries", "iso_3166_1").alias("country_codes"),
        F.coalesce("origin_country", F.array().cast("array<string>")).alias("origin_country"),
        "reviews",
    )


def key_crew(crew: Column) -> Column:
    """Crew entries with one of five jobs, four sub-fields kept."""
    kept = F.filter(crew, lambda c: c["job"].isin(*KEY_JOBS))
    return F.transform(kept, lambda c: F.struct(*[c[f].alias(f) for f in ("id", "name", "job", "department")]))


def find_by_id(documents: DataFrame, movie_id: str | int) -> DataFrame:
    """Point lookup by document key; no row when absent."""
    return documents.where(F.col("doc_id") == str(movie_id)).limit(1)


def catalogue_slice(
    movies: DataFrame,
    genre: int | None = None,
    votes: tuple[int, int] | None = None,
    year: int | None = None,
    language: str | None = None,
) -> DataFrame:
    """Catalogue filter; the vote range includes both ends."""
    if genre is not None:
        movies = movies.where(F.array_contains("genre_ids", genre))
    if votes is not None:
        movies = movies.where(F.col("vote_count").between(*votes))
    if year is not None:
        movies = movies.where(F.col("release_year") == year)
    if language is not None:
        movies = movies.where(F.col("original_language") == language)
    return movies
