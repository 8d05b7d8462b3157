"""Movie-shaped records derived from the order tables, one per order that has lines.

Arrays are whole: the cast is every line of the order, reviews are all turns; the record operators cut
them.  Genres and countries are distinct values of small dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.merge import all_in_order, gather_all
from marquee.session import sent_if_few
from marquee.sources.files import parse_once

# How an order's customer number picks a language and a job.
VIEW_LANGUAGES = ("en", "es", "fr", "de", "ja")
VIEW_JOBS = ("Director", "Producer", "Grip")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the supplier, its nation and the part, the lines of an order in one partition.

    Names of suppliers and nations come last: where they are few enough to be sent, no shuffle carries them.
    """
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    lines = lines.join(part, "l_partkey").drop("l_partkey").repartition("l_orderkey")
    return lines.join(sent_if_few(supplier), "l_suppkey").join(F.broadcast(nation), "s_nationkey")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed movie rows (the columns of the raw record that the order tables can fill)."""
    lines = credits(spark, sf_dir).select(
        F.col("l_orderkey").alias("id"), "n_name", "p_size", "p_type",
        F.struct(
            F.col("l_suppkey").alias("id"), F.col("s_name").alias("name"),
            F.col("l_returnflag").alias("character"), F.col("l_linenumber").alias("order"),
        ).alias("c"),
        "l_linenumber",
    )
    sets = lines.groupBy("id").agg(
        F.array_sort(F.collect_set(F.struct(F.col("p_size").alias("id"), F.col("p_type").alias("name")))).alias("genres"),
        F.array_sort(F.collect_set("n_name")).alias("origin_country"),
        F.transform(all_in_order(["l_linenumber", "c"], ["c"]), lambda x: x["c"]).alias("cast"),
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), "turn", F.col("role").alias("author"), F.col("text").alias("content")
    )
    reviews = gather_all(turns, "id", ["turn", "author", "content"], ["author", "content"], "reviews")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("o_custkey") % len(values) + 1).cast("int"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus", "o_totalprice"
    ).join(customer, "o_custkey").withColumnRenamed("o_orderkey", "id")
    none = F.array().cast(dict(reviews.dtypes)["reviews"])
    # What a record shows of an order is made behind the joins, which then shuffle the order's own columns.
    return orders.join(sets, "id").join(reviews, "id", "left").select(
        "id",
        F.concat(F.lit("tt"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("imdb_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("c_mktsegment").alias("tagline"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        F.col("o_orderstatus").alias("status"),
        pick(VIEW_LANGUAGES).alias("original_language"),
        F.col("o_totalprice").alias("popularity"),
        (F.floor("o_totalprice") % 2000).cast("int").alias("vote_count"),
        F.array(
            F.struct(
                F.col("o_custkey").alias("id"), F.col("c_name").alias("name"),
                pick(VIEW_JOBS).alias("job"), F.col("c_mktsegment").alias("department"),
            )
        ).alias("crew"),
        "genres",
        "origin_country",
        "cast",
        F.coalesce("reviews", none).alias("reviews"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movies as decoded JSON records, as a source reader would give them."""
    rows = movies(spark, sf_dir)
    body = rows.select(
        F.lit("orders").alias("source_path"),
        F.struct(F.col("id").cast("bigint").alias("major"), F.lit(0).cast("bigint").alias("minor")).alias("pos"),
        F.to_json(F.struct(*rows.columns)).alias("body"),
    )
    return parse_once(body)


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns discovery slices by."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    sizes = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey")
    genres = sizes.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_set("p_size")).alias("genre_ids"))
    languages = F.element_at(F.array(*[F.lit(v) for v in VIEW_LANGUAGES]), (F.col("o_custkey") % len(VIEW_LANGUAGES) + 1).cast("int"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("popularity"),
        (F.floor("o_totalprice") % 2000).cast("int").alias("vote_count"),
        F.year("o_orderdate").alias("release_year"),
        languages.alias("original_language"),
    )
    return orders.join(genres, "id")


def page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as two-field documents: the title tag and the visible text."""
    html = F.col("html")
    plain = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    plain = F.regexp_replace(plain, r"(?s)<!--.*?-->", " ")
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("doc_id"),
        F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_replace(plain, r"(?s)<[^>]*>", " ").alias("all_text"),
    )
