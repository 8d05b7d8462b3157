"""Writers: record store, ledger, reports, vectors.  The keyed document table is in ``catalogue``."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.values import bucket
from marquee.operators.dedup import dedup_first
from marquee.operators.records import has_id
from marquee.session import materialise

def write_movies(movies: DataFrame, path: str) -> None:
    """Records as JSON lines under ``bucket=<id div 1000>``; null and zero ids are left out.

    Records that are stored already stay, unless one with their id is written: of equal ids in ``movies``
    the first by content is taken, and it replaces the stored one.  Only the buckets that receive records
    are read; the result is staged in shared storage before it replaces them, because a table cannot be
    overwritten while it is read.  Rows are spread by bucket *and* a rebalance, so a bucket with very many
    records is written by several tasks.
    """
    spark = movies.sparkSession
    fresh = dedup_first(has_id(movies), ["id"], [F.to_json(F.struct(*movies.columns))]).withColumn("bucket", bucket(F.col("id")))
    rows = fresh
    if path_exists(spark, path):
        stored = spark.read.schema(fresh.schema).json(path)
        rows = fresh.unionByName(stored.join(fresh.select("bucket").distinct(), "bucket", "left_semi").join(fresh.select("id"), "id", "left_anti"))
    staged = materialise(rows, "movies")
    staged.hint("rebalance", "bucket").write.option("partitionOverwriteMode", "dynamic").partitionBy("bucket").mode("overwrite").json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def append_ledger(ids: DataFrame, path: str) -> None:
    """Append discovered ids as JSON lines."""
    ids.select("movie_id", "vote_count", "popularity").write.mode("append").json(path)


def write_files(rows: DataFrame, path: str) -> int:
    """One file below ``path`` for each row of ``rows (name, body)``; the number written.

    A task that is repeated writes the same files again.  Rows are spread first: a small table with very many
    names would otherwise be one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path)
        made: set[str] = set()
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                folder = f"{root}/{name}".rsplit("/", 1)[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{root}/{name}") as out:
                    out.write((body.as_py() or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    spread = rows.select("name", "body").repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, "name")
    return spread.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_archives(rows: DataFrame, path: str) -> int:
    """One ZIP archive below ``path`` for each ``archive`` of ``rows (archive, name, body)``; the number of members.

    An archive's members come to one task in name order and are streamed into it; it gets its name when it
    is whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        current, out, archive = None, None, None

        def close() -> None:
            if archive is not None:
                archive.close()
                out.close()
                system.move(f"{root}/{current}.part", f"{root}/{current}")

        for batch in batches:
            for name, member, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if name != current:
                    close()
                    current, out = name, system.open_output_stream(f"{root}/{name}.part")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                archive.writestr(member, body or "")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])
        close()

    spread = rows.select("archive", "name", "body").repartition("archive").sortWithinPartitions("archive", "name")
    return spread.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def error_samples(rejects: DataFrame, n: int = 20) -> DataFrame:
    return rejects.limit(n)


def dry_run(documents: DataFrame) -> None:
    """Do all the work, store nothing."""
    documents.write.format("noop").mode("overwrite").save()


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def write_runs(runs: DataFrame, csv_path: str, summary_path: str, **facts: str) -> None:
    """The sweep as CSV with a header and as one JSON summary row (the run table is a few rows)."""
    runs.coalesce(1).write.mode("overwrite").option("header", "true").csv(csv_path)
    summary = runs.agg(F.array_sort(F.collect_list(F.struct(*runs.columns))).alias("runs"))
    stamped = summary.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssxxx").alias("timestamp_utc"),
        *[F.lit(v).alias(k) for k, v in facts.items()],
        "runs",
    )
    stamped.coalesce(1).write.mode("overwrite").json(summary_path)


def write_vectors(vectors: DataFrame, path: str) -> int:
    """Store vectors with their metadata on the same row; re-read and return the checked count."""
    from marquee.operators.report import observed

    watched, seen = observed(vectors, "vectors")
    watched.write.mode("overwrite").parquet(path)
    stored = vectors.sparkSession.read.parquet(path).count()
    if stored != seen.get["rows"]:
        raise RuntimeError(f"wrote {seen.get['rows']} vectors, found {stored}")
    return stored
