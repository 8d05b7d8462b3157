"""Tolerant coercion of JSON values (VARIANT) and the record-level expressions built on it.

Every function is a Column expression that never raises on dirty input: a bad value becomes its
default and the rest of the record survives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import strip

_INTEGER = r"^[+-]?[0-9]+(_[0-9]+)*$"
_DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_SPECIAL = r"^(?i)[+-]?(nan|inf|infinity)$"

IMDB_PREFIX = "https://www.imdb.com/title/"
CATALOGUE_PREFIX = "https://www.themoviedb.org/movie/"


def get(record: Column, path: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(record, path, as_type)


def key_present(record: Column, key: str) -> Column:
    """The key exists, even with a JSON null as its value."""
    return get(record, f"$.{key}").isNotNull()


def _kind(record: Column, path: str) -> Column:
    return F.schema_of_variant(get(record, path))


def as_text(record: Column, path: str, text: Column | None = None) -> Column:
    """Stripped text of a JSON value; missing and null give ``''``, booleans print capitalised.

    ``text`` is the value as a string where the caller has it already; the record is then only
    consulted for the rare words that could be booleans.
    """
    text = get(record, path, "string") if text is None else text
    boolean = text.isin("true", "false") & (_kind(record, path) == "BOOLEAN")
    return F.coalesce(F.when(boolean, F.initcap(text)).otherwise(strip(text)), F.lit(""))


def as_int(record: Column, path: str, as_type: str = "bigint", text: Column | None = None) -> Column:
    """Whole number of a JSON value.

    Numbers truncate, booleans are 0/1, text must be an optionally signed digit string; anything
    else, and values outside the type, give NULL.
    """
    text = strip(get(record, path, "string") if text is None else text)
    return (
        F.when(text.rlike(_INTEGER), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))
        .when(text.isNotNull() & (_kind(record, path) != "STRING"), get(record, path, "bigint"))
        .try_cast(as_type)
    )


def as_float(record: Column, path: str, text: Column | None = None) -> Column:
    """Double of a JSON number, boolean or numeric text; anything else gives NULL."""
    text = strip(get(record, path, "string") if text is None else text)
    return (
        F.when(text.rlike(_DECIMAL) | text.rlike(_SPECIAL), text.try_cast("double"))
        .when(text.isin("true", "false") & (_kind(record, path) == "BOOLEAN"), get(record, path, "double"))
    )


def truthy(record: Column, path: str, text: Column | None = None) -> Column:
    """Truth of a JSON value: empty text, zero, empty containers, null and missing are false."""
    text = get(record, path, "string") if text is None else text
    kind = _kind(record, path)
    return F.coalesce(
        F.when(text.isNull(), False)
        .when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", text != "")
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(get(record, path, "double") != 0.0),
        F.lit(False),
    )


def as_list(record: Column, path: str) -> Column:
    """Elements of a JSON array; any other value is an empty list."""
    return F.coalesce(get(record, path, "array<variant>"), F.array().cast("array<variant>"))


def _head(items: Column, n: int) -> Column:
    return F.slice(items, 1, n) if n > 0 else items


def text_list(record: Column, path: str, key: str, texts: Column, head: int = 0, distinct: bool = True) -> Column:
    """Non-blank texts under ``key`` of the objects in a list.

    The head cut comes first, then blanks and non-objects go, then repeats (first position stays).
    ``texts`` holds the same values as plain strings (NULL for non-objects); only a list with a word
    that could be a boolean is looked up element by element.
    """
    plain = F.transform(_head(texts, head), strip)
    exact = F.transform(_head(as_list(record, path), head), lambda item: as_text(item, f"$.{key}"))
    values = F.when(F.exists(plain, lambda t: t.isin("true", "false")), exact).otherwise(plain)
    kept = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))
    return F.array_distinct(kept) if distinct else kept


def int_list(record: Column, path: str, key: str, texts: Column) -> Column:
    """Whole numbers under ``key`` of the objects in a list, repeats kept."""
    plain = F.transform(texts, lambda t: t.try_cast("int"))
    exact = F.transform(as_list(record, path), lambda item: as_int(item, f"$.{key}", "int"))
    odd = F.exists(texts, lambda t: ~t.rlike("^[0-9]+$"))
    numbers = F.coalesce(F.when(odd, exact).otherwise(plain), F.array().cast("array<int>"))
    return F.filter(numbers, lambda n: n.isNotNull())


def ordered_distinct(col: Column) -> Column:
    """Distinct non-empty strings, first occurrence order."""
    return F.array_distinct(F.filter(col, lambda v: v.isNotNull() & (v != "")))


def release_date(text: Column) -> Column:
    """A date text needs four characters at least; shorter ones are dropped."""
    return F.when(F.length(text) >= 4, text)


def release_year(date: Column) -> Column:
    head = F.substring(date, 1, 4)
    return F.when(head.rlike("^[0-9]{4}$"), head.try_cast("int"))


def hit_year(year: Column, date: Column) -> Column:
    return F.coalesce(year.cast("string"), F.substring(date, 1, 4), F.lit(""))


def fallback_id(*parts: Column) -> Column:
    """``sha1_`` plus the SHA-1 of the identifying texts joined by a bar."""
    return F.concat(F.lit("sha1_"), F.sha1(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])))


def combined_text(*parts: Column) -> Column:
    """Non-empty parts joined by one space."""
    return strip(F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts]))


def passage(title: Column, overview: Column, tagline: Column, genres: Column, cast: Column, crew: Column) -> Column:
    """Embedding passage: the title three times, then overview, tagline, genres, cast and directors.

    ``genres`` and ``cast`` are structs with ``name``; ``crew`` also has ``job``.  The line layout
    (labels, four leading blanks on continuation lines) is a fixed format.
    """
    text = lambda c: F.coalesce(c, F.lit(""))
    names = lambda a: F.coalesce(F.array_join(F.transform(a, lambda x: x["name"]), " "), F.lit(""))
    directors = F.filter(crew, lambda c: c["job"] == "Director")
    lines = [
        ("Title: ", F.concat_ws(" ", text(title), text(title), text(title))),
        ("Overview: ", text(overview)),
        ("Tagline: ", text(tagline)),
        ("Genres: ", names(genres)),
        ("Cast: ", names(F.slice(cast, 1, 5))),
        ("Director: ", names(directors)),
    ]
    return strip(F.concat_ws("\n    ", *[F.concat(F.lit(label), value) for label, value in lines]))


def similarity(squared_distance: Column) -> Column:
    """``1 / (1 + d)`` to four digits; ``d`` is the squared L2 distance."""
    return F.round(1.0 / (1.0 + squared_distance), 4)


def external_links(imdb_id: Column, movie_id: Column) -> tuple[Column, Column]:
    """Public page links, NULL where the id is missing."""
    imdb = F.when(imdb_id.isNotNull() & (imdb_id != ""), F.concat(F.lit(IMDB_PREFIX), imdb_id, F.lit("/")))
    page = F.when(
        movie_id.isNotNull() & (movie_id.cast("string") != ""),
        F.concat(F.lit(CATALOGUE_PREFIX), movie_id.cast("string")),
    )
    return imdb, page


# Lower bounds of the count bands, widest first.
COUNT_BANDS = (10_000, 5_000, 2_000, 1_000, 500, 100, 10, 0)


def count_band(count: Column) -> Column:
    """Band index of a count: 8 above 10,000 down to 1 above 0, else 0."""
    band = F
    for index, bound in enumerate(COUNT_BANDS):
        band = band.when(count > bound, len(COUNT_BANDS) - index)
    return band.otherwise(0)


def bucket(movie_id: Column) -> Column:
    """Storage bucket: floor of id / 1000."""
    return F.floor(movie_id / 1000).cast("bigint")


def utc_text(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
