"""Inverted index as tables: postings by document shard, term and field statistics, spelling keys.

Postings are bucketed by document, so the terms of one document lie together: a search adds up scores and
takes the best of each shard where the postings are read, and only those best are shuffled.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import term_counts, words
from marquee.operators.fuzzy import spelling_keys
from marquee.schemas import FIELD_STATS_DDL, SPELLING_DDL, TERM_STATS_DDL, postings_ddl
from marquee.session import passing_shuffles, scratch_path, sent_or_hashed

# What one task sorts before it writes a file of a bucket: rows, and the text that postings are made of.
MOST_ROWS_SORTED = 2_000_000
MOST_TEXT_SORTED = 24 << 20


def bucketed_table(spark: SparkSession, path: str, ddl: str, by: str, order: str, shards: int) -> DataFrame:
    """A table that Spark knows to be bucketed; the catalogue entry only names the folder."""
    name = f"marquee_{hashlib.md5(path.encode()).hexdigest()}"
    spec = f"USING parquet CLUSTERED BY ({by}) SORTED BY ({order}) INTO {shards} BUCKETS LOCATION '{path}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) {spec}")
    return spark.table(name)


@dataclass(frozen=True)
class IndexPart:
    """One folder of index tables, and the tables that name documents replaced since (``segment, doc_id``)."""

    path: str
    name: str = ""
    removed: tuple[str, ...] = ()


@dataclass(frozen=True)
class TextIndex:
    """An index of one or more parts, all built with one analyser and one number of shards."""

    spark: SparkSession
    parts: tuple[IndexPart, ...]
    option: str = "english_stem"
    shards: int = 8
    key_type: str = "string"

    def _bucketed(self, path: str, ddl: str, by: str, order: str) -> DataFrame:
        return bucketed_table(self.spark, path, ddl, by, order, self.shards)

    def _live(self, part: IndexPart) -> DataFrame:
        rows = self._bucketed(f"{part.path}/postings", postings_ddl(self.key_type), "doc_id", "field, term")
        if not part.removed:
            return rows
        gone = self.spark.read.parquet(*part.removed).where(F.col("segment") == part.name).select("doc_id")
        return rows.join(gone, "doc_id", "left_anti")

    def _all(self, name: str, ddl: str) -> DataFrame:
        return self.spark.read.schema(ddl).parquet(*[f"{p.path}/{name}" for p in self.parts])

    def _minus(self, name: str, ddl: str) -> DataFrame | None:
        """What replaced documents had added to the statistics, as negative numbers, beside each part that replaced any."""
        found = {table.rsplit("/", 1)[0] for p in self.parts for table in p.removed}
        return self.spark.read.schema(ddl).parquet(*[f"{at}/{name}" for at in sorted(found)]) if found else None

    def _summed(self, name: str, ddl: str, keys: list[str]) -> DataFrame:
        rows, less = self._all(name, ddl), self._minus(f"removed_{name}", ddl)
        if len(self.parts) == 1 and less is None:
            return rows
        rows = rows if less is None else rows.union(less)
        counted = [c for c in rows.columns if c not in keys]
        summed = rows.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in counted])
        return summed.where(F.col(counted[0]) > 0)

    def _dealt(self, part: IndexPart, width: int) -> DataFrame:
        """Live postings of a part in ``width`` partitions by document.

        Read as plain files: Spark drops a repartition of what it takes for bucketed by the same key, then
        reads that by file pieces, and a task would sort all rows of a piece.
        """
        ddl = postings_ddl(self.key_type)
        rows = self.spark.read.schema(ddl).parquet(f"{part.path}/postings").repartition(width, "doc_id")
        if not part.removed:
            return rows
        gone = self.spark.read.parquet(*part.removed).where(F.col("segment") == part.name).select("doc_id")
        return rows.join(sent_or_hashed(gone), "doc_id", "left_anti")

    def dealt_postings(self) -> DataFrame:
        """`postings`, dealt to be written as buckets again."""
        stored = sum(self.spark.read.parquet(f"{p.path}/postings").count() for p in self.parts)
        width = deal_width(self.shards, stored, MOST_ROWS_SORTED)
        return reduce(DataFrame.unionByName, [self._dealt(p, width) for p in self.parts])

    @property
    def postings(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._live(p) for p in self.parts])

    @property
    def term_stats(self) -> DataFrame:
        return self._summed("term_stats", TERM_STATS_DDL, ["field", "term"])

    @property
    def field_stats(self) -> DataFrame:
        return self._summed("field_stats", FIELD_STATS_DDL, ["field"])

    @property
    def spelling(self) -> DataFrame:
        """Spelling keys of all parts; a term of several parts has them several times."""
        tables = [self._bucketed(f"{p.path}/spelling", SPELLING_DDL, "key", "size, key") for p in self.parts]
        return reduce(DataFrame.unionByName, tables)


def shard_width(spark: SparkSession, shards: int | None = None) -> int:
    """Shards of an index: as many as asked for, else the session's shuffle partitions."""
    return shards or int(spark.conf.get("spark.sql.shuffle.partitions"))


def deal_width(shards: int, size: int, most: int) -> int:
    """Tasks that write ``shards`` buckets, each at most about ``most`` of ``size``.

    A multiple of the buckets: rows dealt by the bucket key are then of one bucket in each task, and a
    bucket gets a file from each of its tasks.
    """
    return shards * max(1, -(-size // (shards * most)))


def _text_of(docs: DataFrame, field: str) -> Column:
    return F.array_join(field, " ") if dict(docs.dtypes)[field].startswith("array") else F.col(field)


def text_size(docs: DataFrame, fields: list[str]) -> int:
    """Bytes of text in the fields; reads them, so for stored documents."""
    sizes = [F.coalesce(F.octet_length(_text_of(docs, f)), F.lit(0)).cast("bigint") for f in fields]
    return docs.agg(F.sum(reduce(lambda a, b: a + b, sizes))).first()[0] or 0


def _field_texts(docs: DataFrame, fields: list[str], key: str, shards: int) -> DataFrame:
    """``(doc_id, field, text)``: one row per document and non-empty field; arrays are joined."""
    stacked = F.array(*[F.struct(F.lit(f).alias("field"), _text_of(docs, f).alias("text")) for f in fields])
    # Documents are hashed by key before the analysis: text is smaller than the postings made of
    # it, the work spreads evenly, and the postings are written by shard without another shuffle.
    docs = docs.select(F.col(key).alias("doc_id"), *fields).repartition(shards, "doc_id")
    rows = docs.select("doc_id", F.explode(stacked).alias("f")).select("doc_id", "f.field", "f.text")
    return rows.where(F.col("text") != "")


def build_postings(docs: DataFrame, fields: list[str], option: str = "english_stem", key: str = "doc_id", shards: int | None = None) -> DataFrame:
    """``(doc_id, field, dl, term, tf, head)``: one row per document, field and term.

    ``head`` marks the one posting that holds a document's first token, so documents can be counted
    from postings alone.  No step gathers the rows of a term, however common it is.
    """
    texts = _field_texts(docs, fields, key, shard_width(docs.sparkSession, shards))
    counted = texts.select("doc_id", "field", term_counts(words(F.col("text"), option), option == "english_stem").alias("c"))
    # The outer form keeps the planner from evaluating the counts twice for an emptiness test.
    rows = counted.select("doc_id", "field", "c.dl", F.explode_outer("c.terms").alias("t"))
    return rows.select("doc_id", "field", "dl", "t.term", "t.tf", "t.head").where(F.col("term").isNotNull())


def term_statistics(postings: DataFrame) -> DataFrame:
    """``(field, term, df)``; a posting is one document, so counting rows is counting documents."""
    return postings.groupBy("field", "term").agg(F.count("*").alias("df"))


def field_statistics(postings: DataFrame) -> DataFrame:
    """``(field, n_docs, sum_dl)`` over documents that have at least one token in the field."""
    return postings.groupBy("field").agg(
        F.count_if("head").alias("n_docs"), F.sum("tf").cast("bigint").alias("sum_dl")
    )


def shares(rows: DataFrame, shards: int, passes: int, by: str = "doc_id") -> list[DataFrame]:
    """``rows`` in ``passes`` shares of whole buckets, to be shuffled one after another; for rows that are stored."""
    bucket = F.pmod(F.hash(by), F.lit(shards))
    return [rows.where(bucket % passes == i) for i in range(passes)] if passes > 1 else [rows]


def write_bucketed(parts: list[DataFrame], path: str, shards: int, by: str, order: list[str], **options: str) -> None:
    """Files of one bucket each, from ``parts`` one after another, the shuffles of which go when they are written.

    The entry in the session's catalogue is dropped again; the files stay.
    """
    spark, name = parts[0].sparkSession, f"marquee_{hashlib.md5(path.encode()).hexdigest()}"
    with passing_shuffles(spark):
        for i, rows in enumerate(parts):
            writer = rows.write.format("parquet").mode("append" if i else "errorifexists").options(compression="zstd", **options)
            writer.option("path", path).bucketBy(shards, by).sortBy(*order).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def write_index(
    docs: DataFrame,
    fields: list[str],
    path: str,
    option: str = "english_stem",
    key: str = "doc_id",
    shards: int | None = None,
    text_bytes: int = 0,
    passes: int = 1,
) -> TextIndex:
    """Build the four tables under ``path``.

    ``text_bytes`` is the size of the text where it is known: of much text more tasks than shards write postings.
    With ``passes`` so many shares of the text are shuffled one after another; for documents that are stored.

    Postings are bucketed by document and sorted by field and term inside a file, so a scan for terms
    skips row groups.  Statistics come from the written postings, spelling keys from the statistics, so
    the text is analysed once and shuffled once.
    """
    width = shard_width(docs.sparkSession, shards)
    tasks = deal_width(width, text_bytes, MOST_TEXT_SORTED)
    return _write_tables([build_postings(part, fields, option, key, tasks) for part in shares(docs, width, passes, key)], path, option, width)


def merge_index(index: TextIndex, path: str) -> TextIndex:
    """An index of one part with all that is live in ``index``, made from its postings."""
    return _write_tables([index.dealt_postings()], path, index.option, index.shards)


def _write_tables(parts: list[DataFrame], path: str, option: str, shards: int) -> TextIndex:
    """The tables of one part, from postings that are dealt by document."""
    postings = parts[0]
    write_bucketed(parts, f"{path}/postings", shards, "doc_id", ["field", "term"])
    index = TextIndex(postings.sparkSession, (IndexPart(path),), option, shards, dict(postings.dtypes)["doc_id"])
    stats = term_statistics(index.postings.select("field", "term"))
    with passing_shuffles(postings.sparkSession):
        stats.sortWithinPartitions("term").write.mode("errorifexists").parquet(f"{path}/term_stats")
    terms = index.term_stats.select("term")
    keys = spelling_keys(terms.distinct())
    # A term has at most two keys more than characters.
    most = terms.agg(F.sum(F.length("term") + 2)).first()[0] or 0
    write_bucketed([keys.repartition(deal_width(shards, most, MOST_ROWS_SORTED), "key")], f"{path}/spelling", shards, "key", ["size", "key"])
    field_statistics(index.postings.select("field", "head", "tf")).coalesce(1).write.mode("errorifexists").parquet(f"{path}/field_stats")
    return index


def build_index(
    docs: DataFrame, fields: list[str], option: str = "english_stem", key: str = "doc_id", shards: int | None = None
) -> TextIndex:
    """`write_index` into the shared scratch folder."""
    return write_index(docs, fields, scratch_path(docs.sparkSession, "index"), option, key, shards)
