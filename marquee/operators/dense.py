"""Batch text encoding, mean pooling and exact nearest-neighbour search."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.values import similarity
from marquee.operators.dedup import dedup_first, top_n, top_per_query
from marquee.session import materialise

ENCODE_BATCH = 64
# Bytes of queries sent to every task at once, and rows of a block when there are more than that.
QUERY_BYTES = 16 << 20
QUERY_BLOCK = 2048
VECTOR_BLOCK = 65_536
# Bytes (as doubles) of a tile of queries or vectors, and of the vectors that stream past a tile in one task.
TILE_BYTES = 4 << 20
STREAM_BYTES = 128 << 20
# Queries and vectors of one matrix product, vectors of the first, and bytes of differences taken at once.
_QUERY_SLICE = 256
_VECTOR_SLICE = 512
_FIRST_STEP = 64
_PAIR_BYTES = 8 << 20


def embed(df: DataFrame, text_col: str, encoder: Callable[[], Callable[[list[str]], np.ndarray]],
          batch_size: int = ENCODE_BATCH, out: str = "embedding") -> DataFrame:
    """Adds float32 vectors of a text column.

    ``encoder`` is a factory called once per task: it loads the model and returns a function from
    a list of texts to a matrix.  Texts are encoded ``batch_size`` at a time.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = encoder()
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            rows: list = []
            for start in range(0, len(texts), batch_size):
                rows.extend(np.asarray(model(texts[start : start + batch_size]), dtype=np.float32))
            yield pa.array([r.tolist() for r in rows], pa.list_(pa.float32()))

    return df.withColumn(out, encode(F.col(text_col)))


def mean_pool(tokens: DataFrame, key: str = "id", vector: str = "embedding", mask: str = "mask") -> DataFrame:
    """``(key, embedding)``: masked mean of the token vectors of each key, position by position.

    Each task adds up the vectors of a key in a batch; one row per key and batch is shuffled and added
    again, so a key with very many tokens is never gathered.  Null vectors count for nothing, null numbers
    as zero; of vectors of different lengths each counts for the positions it has.
    """
    rows = tokens.select(F.col(key).alias("key"), F.coalesce(F.col(mask).cast("double"), F.lit(0.0)).alias("m"), F.col(vector).cast("array<double>").alias("v"))
    schema = rows.where("v IS NOT NULL").schema

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy()
            for length in np.unique(lengths):
                own = batch.take(pa.array(np.flatnonzero(lengths == length)))
                coded = own.column(0).dictionary_encode(null_encoding="encode")
                codes, m = coded.indices.to_numpy(), own.column(1).to_numpy()
                x = own.column(2).flatten().fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(codes), -1)
                sums = np.zeros((len(coded.dictionary), x.shape[1]))
                np.add.at(sums, codes, x * m[:, None])
                weights = np.bincount(codes, m, len(sums))
                yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(weights), pa.array(list(sums), pa.list_(pa.float64()))], names=["key", "m", "v"])

    def total(group: pa.Table) -> pa.Table:
        width = max(len(v) for v in group["v"])
        sums, weights = np.zeros(width), np.zeros(width)
        for m, v in zip(group["m"].to_pylist(), group["v"], strict=True):
            sums[: len(v)] += v.values.to_numpy(zero_copy_only=False)
            weights[: len(v)] += m
        mean = (sums / np.maximum(weights, 1e-9)).astype(np.float32)
        return pa.table({"key": group["key"].slice(0, 1), "embedding": pa.array([mean], pa.list_(pa.float32()))})

    parts = rows.where("v IS NOT NULL").mapInArrow(partial, schema)
    kind = schema["key"].dataType.simpleString()
    pooled = parts.groupBy("key").applyInArrow(total, f"key {kind}, embedding array<float>")
    return pooled.withColumnRenamed("key", key)


def squared_l2(a, b):
    """Squared L2 distance of two array columns, summed in position order."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
        F.lit(0.0),
        lambda s, d: s + d,
    )


def _flat(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _matrix(column) -> np.ndarray:
    column = _flat(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _keys(column) -> np.ndarray:
    """Sortable ids: numbers as they are, anything else as text; a null number is the smallest."""
    flat = _flat(column)
    if flat.null_count and pa.types.is_integer(flat.type):
        flat = flat.fill_null(-(2 ** (flat.type.bit_width - 1)))
    values = flat.to_numpy(zero_copy_only=False)
    return values.astype(str) if values.dtype == object else values


def _first_k(found: dict[str, np.ndarray], k: int) -> dict[str, np.ndarray]:
    """Nearest k rows per query, one per group when groups are given; ties to the smaller id."""
    order = np.lexsort((found["vec_id"], found["distance"], found["query"]))
    found = {name: values[order] for name, values in found.items()}
    if "group" in found and len(order):
        _, code = np.unique(found["group"], return_inverse=True)
        _, first = np.unique(found["query"] * (code.max() + 1) + code, return_index=True)
        first.sort()
        found = {name: values[first] for name, values in found.items()}
    place = np.arange(len(found["query"])) - np.searchsorted(found["query"], found["query"])
    return {name: values[place < k] for name, values in found.items()}


class _Block:
    """Vectors that are compared at once, with their ids, groups and country codes; what is not finite is left out."""

    def __init__(self, rows) -> None:
        vectors = _matrix(rows["embedding"])
        norms = (vectors**2).sum(1)
        sound = np.isfinite(norms)
        names = rows.schema.names
        self.vectors, self.ids = vectors[sound], _keys(rows["vec_id"])[sound]
        self.groups = _keys(rows["group"])[sound] if "group" in names else None
        self.codes = _flat(rows["codes"]).filter(pa.array(sound)) if "codes" in names else None
        self.most = norms[sound].max(initial=0.0)
        # One product gives |v|^2 - 2qv.
        self.product = np.hstack([self.vectors, norms[sound][:, None]]) if len(vectors) else np.zeros((0, 1))

    def carrying(self, country: str) -> _Block:
        """The vectors that carry a country."""
        flat = np.asarray(self.codes.flatten().to_pylist(), dtype=object)
        owner = np.repeat(np.arange(len(self.codes)), self.codes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        rows = np.unique(owner[flat == country])
        part = _Block.__new__(_Block)
        part.vectors, part.ids, part.product, part.most, part.codes = self.vectors[rows], self.ids[rows], self.product[rows], self.most, None
        part.groups = None if self.groups is None else self.groups[rows]
        return part


class _Nearest:
    """The k nearest vectors met so far by some queries, one per group when vectors have groups.

    A matrix product finds the candidates, with a margin above its rounding error; their distances are then
    computed by difference.  What lies beyond the k-th met so far is dropped at once, so of many vectors few
    are candidates; the first are compared in small steps until there are k.
    """

    def __init__(self, query: np.ndarray, rows: np.ndarray, k: int, width: int) -> None:
        self.query, self.rows, self.k, self.width = query, rows, k, width
        self.norm = (query**2).sum(1)
        self.product = np.hstack([-2.0 * query, np.ones((len(query), 1))])
        self.bound = np.full(len(query), np.inf)
        self.found: list[dict[str, np.ndarray]] = []
        self.met = self.waiting = 0

    def meet(self, block: _Block) -> None:
        margin = 1e-12 * (self.norm + block.most) * self.query.shape[1]
        at = 0
        while at < len(block.ids):
            step = slice(at, at + min(self.width, max(2 * self.k, _FIRST_STEP, self.met)))
            at = step.stop
            rough = self.product @ block.product[step].T
            limit = np.minimum(self.bound + margin - self.norm, np.finfo(float).max)
            q_rows, v_rows = np.divmod(np.flatnonzero(rough <= limit[:, None]), rough.shape[1])
            self.met += rough.shape[1]
            if len(q_rows):
                self._take(q_rows, v_rows + step.start, block)

    def _take(self, q_rows: np.ndarray, v_rows: np.ndarray, block: _Block) -> None:
        pairs = max(1, _PAIR_BYTES // (8 * self.query.shape[1]))
        exact = [
            ((self.query[q_rows[i : i + pairs]] - block.vectors[v_rows[i : i + pairs]]) ** 2).sum(1) for i in range(0, len(q_rows), pairs)
        ]
        found = {"query": q_rows, "vec_id": block.ids[v_rows], "distance": np.concatenate(exact)}
        if block.groups is not None:
            found["group"] = block.groups[v_rows]
        self.found.append(found)
        self.waiting += len(q_rows)
        if self.waiting >= self.k * len(self.query):
            self.settle()

    def settle(self) -> None:
        """Cut what was found to the k nearest."""
        if not self.waiting:
            return
        best = _first_k({name: np.concatenate([f[name] for f in self.found]) for name in self.found[0]}, self.k)
        counts = np.bincount(best["query"], minlength=len(self.query))
        last = best["distance"][np.maximum(counts.cumsum() - 1, 0)]
        self.bound = np.where(counts >= self.k, last, np.inf)
        self.found, self.waiting = [best], 0


class _Asked:
    """Queries of one task in blocks, those of a country together: they are compared with what carries it."""

    def __init__(self, queries, k: int, query_block: int, vector_block: int) -> None:
        query = _matrix(queries["embedding"])
        self.ids = _flat(queries["query_id"])
        countries = queries["country"].to_pylist() if "country" in queries.schema.names else [None] * len(query)
        rows_of: dict = {}
        for row, country in enumerate(countries):
            rows_of.setdefault(country, []).append(row)
        size = min(query_block, _QUERY_SLICE)
        self.parts = [
            (country, [_Nearest(query[r], r, k, min(vector_block, _VECTOR_SLICE)) for r in np.split(np.array(rows), range(size, len(rows), size))])
            for country, rows in rows_of.items()
        ]

    def meet(self, rows) -> None:
        block = _Block(rows)
        for country, parts in self.parts:
            carried = block if country is None or block.codes is None else block.carrying(country)
            for part in parts:
                part.meet(carried)

    def answers(self, vec_type: pa.DataType, group_type: pa.DataType | None) -> Iterator[pa.RecordBatch]:
        for _, parts in self.parts:
            for part in parts:
                part.settle()
                for found in part.found:
                    out = _as_batch(found | {"query": part.rows[found["query"]]}, self.ids, vec_type, group_type)
                    yield from out.to_batches(max_chunksize=50_000)


def _as_batch(found: dict[str, np.ndarray], query_ids: pa.Array, vec_type: pa.DataType, group_type) -> pa.Table:
    columns = {
        "query_id": query_ids.take(pa.array(found["query"])),
        "vec_id": pa.array(found["vec_id"].tolist(), vec_type),
        "distance": pa.array(found["distance"], pa.float64()),
    }
    if "group" in found:
        columns["group"] = pa.array(found["group"].tolist(), group_type)
    return pa.table(columns)


def _scan(queries: DataFrame, vectors: DataFrame, k: int, ddl: str) -> DataFrame:
    """Every task compares its own vectors with the whole (bounded) query block.

    Nothing is shuffled but the answers: a task keeps the best k per query over all its batches.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(queries.toArrow())

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = None
        for batch in batches:
            if batch.num_rows and len(shared.value):
                asked = asked or _Asked(shared.value, k, QUERY_BLOCK, VECTOR_BLOCK)
                asked.meet(batch)
                vec_type, group_type = _types(batch.schema)
        if asked:
            yield from asked.answers(vec_type, group_type)

    return vectors.mapInArrow(nearest, ddl)


def _types(schema: pa.Schema) -> tuple[pa.DataType, pa.DataType | None]:
    return schema.field("vec_id").type, schema.field("group").type if "group" in schema.names else None


def _tiles(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """``(tile, <name>)``: rows dealt by hash into ``n`` lists, stored."""
    tile = F.pmod(F.xxhash64(key, "embedding"), F.lit(n)).cast("int")
    packed = rows.groupBy(tile.alias("tile")).agg(F.collect_list(F.struct(*rows.columns)).alias(name))
    return materialise(packed, name)


def _blocks(queries: DataFrame, vectors: DataFrame, k: int, ddl: str, query_block: int, vector_block: int, width: int) -> DataFrame:
    """Both sides stored as tiles of bounded size; every tile of queries meets all tiles of vectors.

    A task streams a part of the vectors (128 MB at most) past one tile of queries and hands on k rows per
    query.  Inside, blocks of at most ``query_block`` x ``vector_block`` are multiplied.  Vectors are read
    once per tile of queries; a single row stands for a tile, so pairs are never rows.
    """
    spark = vectors.sparkSession
    fits = max(1, TILE_BYTES // (8 * width))
    n_queries, n_vectors = queries.count(), vectors.count()
    few = min(spark.sparkContext.defaultParallelism, -(-n_queries // query_block))
    n_q, n_v = max(1, few, -(-n_queries // fits)), max(1, -(-n_vectors // fits))
    left = _tiles(queries, "query_id", n_q, "asked").repartition(n_q)
    right = _tiles(vectors, "vec_id", n_v, "stored").coalesce(max(1, -(-n_v * TILE_BYTES // STREAM_BYTES)))
    met = left.crossJoin(right.select("stored").hint("shuffle_replicate_nl"))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = asked = None
        for batch in batches:
            for tile, some, stored in zip(*[batch.column(c) for c in ("tile", "asked", "stored")], strict=True):
                block = pa.RecordBatch.from_struct_array(stored.values)
                if tile.as_py() != held:
                    if asked:
                        yield from asked.answers(vec_type, group_type)
                    held, asked = tile.as_py(), _Asked(pa.RecordBatch.from_struct_array(some.values), k, query_block, vector_block)
                    vec_type, group_type = _types(block.schema)
                asked.meet(block)
        if asked:
            yield from asked.answers(vec_type, group_type)

    return met.mapInArrow(nearest, ddl)


def _compare(queries: DataFrame, vectors: DataFrame, k: int, query_block: int, vector_block: int) -> DataFrame:
    """Candidates ``(query_id, vec_id, distance[, group])`` that contain the k nearest of each query.

    Rows without a vector (or an id of one) are compared with nothing.
    """
    types = dict(queries.dtypes) | dict(vectors.dtypes)
    ddl = f"query_id {types['query_id']}, vec_id {types['vec_id']}, distance double"
    if "group" in types:
        ddl += f", group {types['group']}"
    queries, vectors = queries.where("embedding IS NOT NULL"), vectors.where("embedding IS NOT NULL AND vec_id IS NOT NULL")
    rows, width = queries.agg(F.count("*"), F.max(F.size("embedding"))).first()
    width = max(1, width or 1)
    query_block = max(1, min(query_block, QUERY_BYTES // (8 * width)))
    if rows <= query_block:
        return _scan(queries, vectors, k, ddl)
    return _blocks(queries, vectors, k, ddl, query_block, vector_block, width)


def knn(
    query_vectors: DataFrame, vectors: DataFrame, k: int = 5,
    query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """Exact k nearest vectors of each query: ``(query_id, rank, vec_id, distance)``.

    ``distance`` is the squared L2 distance; ties go to the smaller id.  Up to ``query_block``
    queries are sent to all tasks; more are compared block by block.
    """
    pairs = _compare(
        query_vectors.select("query_id", "embedding"), vectors.select("vec_id", "embedding"), k, query_block, vector_block
    )
    ranked = top_n(pairs, ["query_id"], [F.col("distance"), F.col("vec_id")], k)
    return ranked.select("query_id", "rank", "vec_id", "distance")


def attach_metadata(hits: DataFrame, metadata: DataFrame, key: str = "vec_id") -> DataFrame:
    """Metadata of each hit; a position without metadata drops the hit."""
    return hits.join(metadata, key)


def dense_search(
    query_vectors: DataFrame,
    vectors: DataFrame,
    top_k: int = 10,
    movie_key: str = "movie_id",
    country_col: str = "origin_country",
    prefilter: bool = False,
) -> DataFrame:
    """Top hits ``(query_id, rank, movie_id, distance, score)`` of vector queries.

    ``vectors`` has ``vec_id, embedding``, the movie key and the country array; ``query_vectors``
    has ``query_id, embedding`` and may have ``country`` (empty is none) and its own ``top_k``.  As in the
    contract of the search, 5k neighbours are fetched for a query with a country and 2k without, then cut
    to the first per movie, filtered and cut to k, so fewer than k may return.  ``prefilter=True`` filters before
    the comparison instead and always fills k when it can.
    """
    meta = [c for c in (movie_key, country_col) if c in vectors.columns]
    has_country = "country" in query_vectors.columns
    own_k = F.coalesce("top_k", F.lit(top_k)) if "top_k" in query_vectors.columns else F.lit(top_k)
    asked = query_vectors.withColumn("top_k", own_k)
    if has_country:
        asked = asked.withColumn("country", F.nullif("country", F.lit("")))
    k = asked.agg(F.max("top_k")).first()[0] or 0
    if prefilter and has_country:
        return _prefiltered(asked, vectors, k, movie_key, country_col)
    near = knn(asked, vectors, 5 * k if has_country else 2 * k)
    hits = attach_metadata(near, vectors.select("vec_id", *meta))
    fetched = F.when(F.col("country").isNotNull(), 5).otherwise(2) if has_country else F.lit(2)
    hits = hits.join(asked.drop("embedding"), "query_id").where(F.col("rank") <= fetched * F.col("top_k")).drop("top_k")
    first = dedup_first(hits.withColumnRenamed("rank", "near"), ["query_id", movie_key], ["near"])
    if has_country:
        first = first.where(F.col("country").isNull() | F.array_contains(country_col, F.col("country")))
    return _cut(first, asked, movie_key)


def _cut(hits: DataFrame, asked: DataFrame, movie_key: str) -> DataFrame:
    ranked = top_per_query(hits, asked.select("query_id", "top_k"), [F.col("distance"), F.col("vec_id")], 0)
    return ranked.select("query_id", "rank", movie_key, "distance", similarity(F.col("distance")).alias("score"))


def _prefiltered(query_vectors: DataFrame, vectors: DataFrame, k: int, movie_key: str, country_col: str) -> DataFrame:
    """The k nearest distinct movies among those that carry the country asked for."""
    pool = vectors.select(
        "vec_id", "embedding", F.col(movie_key).alias("group"), F.col(country_col).alias("codes")
    )
    near = _compare(query_vectors.select("query_id", "embedding", "country"), pool, k, QUERY_BLOCK, VECTOR_BLOCK)
    near = near.withColumnRenamed("group", movie_key)
    return _cut(dedup_first(near, ["query_id", movie_key], ["distance", "vec_id"]), query_vectors, movie_key)
