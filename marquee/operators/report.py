"""Counters, run reports, throughput and progress tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.records import is_movie_record

MAX_ERROR_SAMPLES = 20


def one_row(*rows: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row."""
    united = rows[0]
    for row in rows[1:]:
        united = united.unionByName(row, allowMissingColumns=True)
    return united.agg(*[F.any_value(c, F.lit(True)).alias(c) for c in united.columns])


def build_counters(records: DataFrame, documents: DataFrame, limited: bool = False) -> DataFrame:
    """One row of build counters.

    ``records`` are decoded rows (NULL record = parse error), ``documents`` the deduplicated
    result with its ``source_path`` and ``pos``.  When a document limit stopped the build
    (``limited``), records after the last document kept were never seen.  Always
    seen = prepared + skipped non-movie + skipped duplicate.
    """
    if limited:
        last = documents.agg(F.max(F.struct("source_path", "pos")).alias("last"))
        records = records.join(F.broadcast(last), F.struct("source_path", "pos") <= F.col("last")).drop("last")
    ok = F.col("record").isNotNull()
    movie = F.coalesce(is_movie_record(F.col("record")), F.lit(False))
    per_file = records.groupBy("source_path").agg(
        F.count_if(ok).alias("seen"), F.count_if(~ok).alias("bad"), F.count_if(ok & ~movie).alias("other"),
    )
    seen = per_file.agg(
        F.count("*").alias("files_seen"),
        F.coalesce(F.sum("seen"), F.lit(0)).alias("docs_seen"),
        F.coalesce(F.sum("other"), F.lit(0)).alias("docs_skipped_non_movie"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("parse_errors"),
    )
    both = one_row(seen, documents.agg(F.count("*").alias("docs_prepared")))
    return both.withColumn(
        "docs_skipped_duplicate", F.col("docs_seen") - F.col("docs_skipped_non_movie") - F.col("docs_prepared")
    )


def crawl_stats(movies: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row: movies, movies with reviews, totals of reviews, cast and crew, and the stored size.

    ``files`` is any scan of the stored files; its file metadata gives the bytes.
    """
    total = lambda c: F.coalesce(F.sum(F.coalesce(F.size(c), F.lit(0))), F.lit(0))
    stats = movies.agg(
        F.count("*").alias("movies_processed"),
        F.count_if(F.size("reviews") > 0).alias("movies_with_reviews"),
        total("reviews").alias("total_reviews"),
        total("cast").alias("total_cast"),
        total("crew").alias("total_crew"),
    )
    if files is None:
        return stats
    return one_row(stats, stored_size(files))


def stored_size(files: DataFrame) -> DataFrame:
    """``(total_size_bytes, total_size_mb)`` of the distinct files behind a scan."""
    each = files.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b"))
    total = each.groupBy("p").agg(F.max("b").alias("b")).agg(F.coalesce(F.sum("b"), F.lit(0)).alias("total_size_bytes"))
    return total.withColumn("total_size_mb", F.round(F.col("total_size_bytes") / 1048576, 2))


def discovery_counters(listed: DataFrame, key: str = "id") -> DataFrame:
    """``(total_discovered, unique_discovered, duplicates_skipped)``.

    Ids are counted per key first, so a very common id is added up before the shuffle.
    """
    per_id = listed.where(F.col(key).isNotNull() & (F.col(key) != 0)).groupBy(key).agg(F.count("*").alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_discovered"),
        F.count("*").alias("unique_discovered"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_skipped"),
    )


def fetch_counters(ids: DataFrame, stored: DataFrame, fetched: DataFrame, key: str = "movie_id") -> DataFrame:
    """``(total_ids, skipped_existing, fetched, failed)``; failed = asked for and not fetched."""
    mark = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    rows = ids.select(key).join(mark(stored, "_stored"), key, "left").join(mark(fetched, "_fetched"), key, "left")
    is_stored, is_fetched = F.col("_stored").isNotNull(), F.col("_fetched").isNotNull()
    return rows.agg(
        F.count("*").alias("total_ids"),
        F.count_if(is_stored).alias("skipped_existing"),
        F.count_if(~is_stored & is_fetched).alias("fetched"),
        F.count_if(~is_stored & ~is_fetched).alias("failed"),
    )


def throughput(runs: DataFrame) -> DataFrame:
    """Adds ``docs_per_sec``: indexed documents over seconds, two digits."""
    return runs.withColumn(
        "docs_per_sec", F.round(F.col("indexed_docs") / F.greatest("duration_sec", F.lit(1e-6)), 2)
    )


def progress_checkpoints(run_log: DataFrame, group: str, order_by: list[str | Column], started: str, at: str, every: int = 5000) -> DataFrame:
    """Progress of each run every ``every`` rows and at its end: ``(group, n, elapsed)``.

    The running count is split in two so that no task sorts a whole run: rows are counted per time
    bucket, the buckets (few) are summed in order, and a row's number is the bucket offset plus its
    place inside the bucket.
    """
    from pyspark.sql import Window

    rows = run_log.withColumn("_bucket", F.date_trunc("minute", at))
    sizes = rows.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    ordered = Window.partitionBy(group).orderBy("_bucket")
    offsets = sizes.select(
        group,
        "_bucket",
        (F.sum("_n").over(ordered) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(group)).alias("_total"),
    )
    place = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order_by))
    numbered = rows.withColumn("_place", place).join(offsets, [group, "_bucket"])
    numbered = numbered.withColumn("n", F.col("_before") + F.col("_place"))
    kept = numbered.where((F.col("n") % every == 0) | (F.col("n") == F.col("_total")))
    elapsed = F.col(at).cast("double") - F.col(started).cast("double")
    return kept.select(group, "n", F.round(elapsed, 3).alias("elapsed"))


def stored_counters(stored: DataFrame, files_seen: int, kept: DataFrame | None = None) -> DataFrame:
    """One row of build counters from the stored result of one pass (``kind, doc_id, source_path, pos``).

    ``kept`` names the first ``(source_path, pos)`` of each key where a document limit stopped the build:
    rows after the last of them were never seen.  Files are counted by their listing, so a file without any
    record was seen too.  Always seen = prepared + skipped non-movie + skipped duplicate.
    """
    rows = stored.select("kind", "doc_id", "source_path", "pos")
    if kept is not None:
        last = kept.agg(F.max(F.struct("source_path", "pos")).alias("last"))
        rows = rows.join(F.broadcast(last), F.struct("source_path", "pos") <= F.col("last"))
    is_movie = F.col("kind") == "movie"
    # Keys are counted one by one, each added up before the shuffle.
    keys = rows.groupBy(F.when(is_movie, F.col("doc_id")).alias("key"), "kind").agg(F.count("*").alias("n"))
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    return keys.agg(
        F.lit(files_seen).cast("bigint").alias("files_seen"),
        (total("movie") + total("other")).alias("docs_seen"),
        F.count_if(is_movie).alias("docs_prepared"),
        total("other").alias("docs_skipped_non_movie"),
        (total("movie") - F.count_if(is_movie)).alias("docs_skipped_duplicate"),
        total("error").alias("parse_errors"),
    )


def run_report(counters: DataFrame, args: dict, source: str, index_name: str, option: str,
               dry_run: bool = False, final_count: int | None = None, started: float | None = None,
               errors: DataFrame | None = None) -> DataFrame:
    """One report row: times, source, options, counters and at most 20 error samples.

    Of the documents prepared some may be refused (``errors``): those failed, the rest was indexed.  A dry
    run counts all as indexed.
    """
    ended = time.time()
    failed = 0 if errors is None else errors.count()
    utc = lambda at: datetime.fromtimestamp(at, timezone.utc).isoformat()
    stats = counters.withColumns({
        "docs_indexed": F.col("docs_prepared") - F.lit(failed),
        "docs_failed": F.lit(failed).cast("bigint"),
        "started_at": F.lit(None if started is None else utc(started)).cast("string"),
        "ended_at": F.lit(utc(ended)),
        "duration_sec": F.lit(None if started is None else round(ended - started, 2)).cast("double"),
    })
    report = stats.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp_utc"),
        F.lit(source).alias("source"),
        F.lit(index_name).alias("index_name"),
        F.lit(option).alias("analyzer_option"),
        F.lit(dry_run).alias("dry_run"),
        F.lit(final_count).cast("bigint").alias("final_count"),
        F.struct(*[F.lit(v).alias(k) for k, v in sorted(args.items())]).alias("args"),
        F.struct(*stats.columns).alias("stats"),
    )
    if errors is None:
        return report.withColumn("error_samples", F.array().cast("array<string>"))
    samples = errors.select(F.to_json(F.struct("*")).alias("e")).limit(MAX_ERROR_SAMPLES)
    return one_row(report, samples.agg(F.collect_list("e").alias("error_samples")))


def observed(df: DataFrame, name: str):
    """``(df, observation)``: rows counted while another action writes them."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def runtime_sweep(spark: SparkSession, build: Callable[[int], dict], points: list[int]) -> DataFrame:
    """Run ``build(limit)`` at each size and time it.

    ``build`` returns counters (``prepared``, ``indexed``, ``failed``); the result is one row per point.
    """
    rows = []
    for limit in points:
        start = time.time()
        done = build(limit)
        rows.append(
            (limit, done["prepared"], done["indexed"], done.get("failed", 0), round(time.time() - start, 2))
        )
    ddl = "max_docs bigint, prepared_docs bigint, indexed_docs bigint, failed_docs bigint, duration_sec double"
    return throughput(spark.createDataFrame(rows, ddl))
