"""First-wins deduplication, ranking and ordered limits.

``row_number() <= k`` filters are planned with a per-partition limit ahead of the shuffle, so a key
that holds a large share of the rows sends at most k rows from each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise


def dedup_first(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """One row per key: the first in ``order_by``."""
    return top_n(df, keys, order_by, 1).drop("rank")


def add_rank(df: DataFrame, partition: list[str], order_by: list[str | Column], name: str = "rank") -> DataFrame:
    window = Window.partitionBy(*partition).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(window))


def top_n(df: DataFrame, partition: list[str], order_by: list[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of each group with their rank from 1; exact for any ``n``."""
    return add_rank(df, partition, order_by).where(F.col("rank") <= n)


def top_per_query(df: DataFrame, queries: DataFrame, order_by: list[str | Column], top_k: int, factor: int = 1) -> DataFrame:
    """First ``factor`` x k rows of each query, where k is its ``top_k`` if it has one, else the argument.

    The largest k asked for (one number) bounds what each task hands on; the queries' own follow.
    """
    if "top_k" not in queries.columns:
        return top_n(df, ["query_id"], order_by, factor * top_k)
    wanted = queries.select("query_id", F.coalesce("top_k", F.lit(top_k)).alias("_k"))
    most = wanted.agg(F.max("_k")).first()[0] or 0
    ranked = top_n(df, ["query_id"], order_by, factor * most).join(wanted, "query_id")
    return ranked.where(F.col("rank") <= factor * F.col("_k")).drop("_k")


def limit_first(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows overall; 0 or less keeps all.

    Only the columns of the order are sorted, in ranges that number their own rows: the sizes of the ranges
    give the place of the n-th row, and rows are kept where they are read by comparing with it.  Rows that
    tie in ``order_by`` are ordered by a hash of all columns, so the same rows are kept whatever the
    partitions.
    """
    if n <= 0:
        return df
    order = [*order_by, "_tie"]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_tie", F.xxhash64(*df.columns))
    ranged = keyed.select(*order).repartitionByRange(width, *order).sortWithinPartitions(*order)
    # The low 33 bits of this id are the row's place in its partition.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = materialise(ranged.withColumns({"_part": F.spark_partition_id(), "_place": place}), "ordered")
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))
    last = numbered.join(offsets, "_part").where(F.col("_before") + F.col("_place") == n - 1)
    last = materialise(last.select(F.struct(*order).alias("_last"), F.lit(0).alias("_one")), "last")
    if last.isEmpty():
        return df
    key, cut = F.struct(*order), F.broadcast(last)
    earlier = numbered.withColumn("_one", F.lit(0)).join(cut, "_one").where(key < F.col("_last")).count()
    rows = keyed.withColumn("_one", F.lit(0)).join(cut, "_one")
    # Rows with the key of the n-th are equal in all columns.
    equal = rows.where(key == F.col("_last")).limit(n - earlier)
    return rows.where(key < F.col("_last")).union(equal).select(*df.columns)
