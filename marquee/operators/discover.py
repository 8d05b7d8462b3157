"""Stratified discovery: slices of a catalogue, the most popular pages of each, united."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.dedup import dedup_first, top_n

# The slice axes.
GENRES = (28, 12, 16, 35, 80, 99, 18, 10751, 14, 36, 27, 10402, 9648, 10749, 878, 10770, 53, 10752, 37)
VOTE_RANGES = ((0, 10), (10, 100), (100, 1000), (1000, 100000))
YEARS = (1970, 2026)
LANGUAGES = ("en", "es", "fr", "de", "ja", "ko", "zh", "hi", "it", "pt")
PAGES = 500
PAGE_SIZE = 20
STRATEGIES = ("genre", "year", "language")


def _strategies(strategy: str) -> tuple[str, ...]:
    if strategy != "all" and strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    return STRATEGIES if strategy == "all" else (strategy,)


def vote_slices(votes, ranges=VOTE_RANGES):
    """Every range that holds the vote count; both ends belong to a range, so 10 is in two."""
    table = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in ranges])
    return F.filter(table, lambda r: votes.between(r["lo"], r["hi"]))


def slice_rows(catalogue: DataFrame, strategy: str = "all", genres=GENRES, years=YEARS, languages=LANGUAGES) -> DataFrame:
    """``(slice, id, vote_count, popularity)``: each movie once per slice that lists it.

    Slices are found row by row from the movie's own values, all in one array: no join is needed, and the
    catalogue is read once.
    """
    chosen = _strategies(strategy)
    none = F.array().cast("array<string>")
    labels = []
    if "genre" in chosen:
        wanted = F.array_intersect("genre_ids", F.array(*[F.lit(g) for g in genres]))
        ranges = F.transform(vote_slices(F.col("vote_count")), lambda r: F.concat_ws("_", r["lo"].cast("string"), r["hi"].cast("string")))
        each = lambda g: F.transform(ranges, lambda r: F.concat(F.lit("genre_"), g.cast("string"), F.lit("_vote_"), r))
        labels.append(F.flatten(F.transform(wanted, each)))
    if "year" in chosen:
        labels.append(F.when(F.col("release_year").between(*years), F.array(F.format_string("year_%d", "release_year"))))
    if "language" in chosen:
        labels.append(F.when(F.col("original_language").isin(*languages), F.array(F.concat(F.lit("lang_"), "original_language"))))
    all_labels = F.concat(*[F.coalesce(c, none) for c in labels])
    return catalogue.select(F.explode(all_labels).alias("slice"), "id", "vote_count", "popularity")


def listed(catalogue: DataFrame, strategy: str = "all", pages: int = PAGES, page_size: int = PAGE_SIZE, **axes) -> DataFrame:
    """The most popular ``pages * page_size`` movies of each slice, with rank and page number."""
    rows = slice_rows(catalogue, strategy, **axes)
    ranked = top_n(rows, ["slice"], [F.desc("popularity"), F.col("id")], pages * page_size)
    return ranked.withColumn("page", F.ceil(F.col("rank") / page_size).cast("int"))


def discover(catalogue: DataFrame, strategy: str = "all", pages: int = PAGES, page_size: int = PAGE_SIZE, **axes) -> DataFrame:
    """Distinct discovered movies, ``(movie_id, vote_count, popularity)``; null and zero ids are skipped."""
    rows = listed(catalogue, strategy, pages, page_size, **axes)
    rows = rows.where(F.col("id").isNotNull() & (F.col("id") != 0))
    first = dedup_first(rows, ["id"], ["slice", "rank"])
    return first.select(F.col("id").alias("movie_id"), "vote_count", "popularity")


def slice_plan(
    spark, strategy: str = "all", pages: int = PAGES, genres=GENRES, vote_ranges=VOTE_RANGES, years=YEARS, languages=LANGUAGES
) -> DataFrame:
    """Every ``(slice, page)`` to request: the product of the slice axes and the pages."""
    labels = []
    chosen = _strategies(strategy)
    if "genre" in chosen:
        labels += [f"genre_{g}_vote_{lo}_{hi}" for g in genres for lo, hi in vote_ranges]
    if "year" in chosen:
        labels += [f"year_{y}" for y in range(years[0], years[1] + 1)]
    if "language" in chosen:
        labels += [f"lang_{language}" for language in languages]
    slices = spark.createDataFrame([(label,) for label in labels], "slice string")
    return slices.select("slice", F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("page"))


def page_plan(catalogue: DataFrame, strategy: str = "all", pages: int = PAGES, page_size: int = PAGE_SIZE, **axes) -> DataFrame:
    """`slice_plan` cut to the pages that exist in a catalogue: ``(slice, page)``."""
    sizes = slice_rows(catalogue, strategy, **axes).groupBy("slice").agg(F.count("*").alias("n"))
    last = F.least(F.ceil(F.col("n") / page_size).cast("int"), F.lit(pages))
    return sizes.select("slice", F.explode(F.sequence(F.lit(1), last)).alias("page"))
