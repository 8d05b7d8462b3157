"""Incremental ingest of discovered ids with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.merge import pending


def stream_ids(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", key: str = "movie_id",
    watermark: tuple[str, str] | None = None, **options: str,
) -> DataFrame:
    """Ids as they arrive, each once; null and zero ids are skipped.

    With ``watermark=(column, delay)`` the seen-set forgets ids older than the delay; without it the
    state grows with the number of distinct ids.
    """
    rows = spark.readStream.schema(schema).options(**options).format(fmt).load(path)
    rows = rows.where(F.col(key).isNotNull() & (F.col(key) != 0))
    if watermark:
        return rows.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    return rows.dropDuplicates([key])


def run_batches(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write each batch to a folder of its own number below ``target``, then stop.

    A batch that is repeated after a failure replaces its folder, so its rows are stored once.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_available(stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet", name: str = "ids") -> StreamingQuery:
    """Process everything that is there and stop; a restart goes on after the last finished batch."""
    counted = stream.observe(name, F.count(F.lit(1)).alias("rows"))
    query = (
        counted.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(target)
    )
    query.awaitTermination()
    return query


def run_pending(
    stream: DataFrame, stored: Callable[[], DataFrame], fetch: Callable[[DataFrame], None], checkpoint: str,
    key: str = "movie_id",
) -> StreamingQuery:
    """Hand each batch's not-yet-stored ids to ``fetch``; ``stored`` is read anew per batch."""

    def step(batch: DataFrame, _: int) -> None:
        fetch(pending(batch, stored(), key))

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def progress_rows(query: StreamingQuery, name: str = "ids") -> list[tuple[int, int]]:
    """``(batch, rows)`` of each finished batch, from the observed counters."""
    return [
        (p["batchId"], p["observedMetrics"][name]["rows"])
        for p in query.recentProgress
        if name in p.get("observedMetrics", {})
    ]
