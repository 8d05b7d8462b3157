"""Near duplicates by b-bit MinHash.

Texts become sets of word shingles.  Bands of minima propose pairs; the low bits of all minima, packed,
estimate their similarity from bit counts corrected for chance collisions, and what may reach the
threshold is confirmed on the full sets.  A band bucket is compared with one representative first; only
members that this leaves in other components are compared with the rest of their bucket, so the pairs
made follow the rows and not the square of a bucket, and no link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ROW, components, mix64, numbered, text_blocks
from marquee.session import materialise, scratch_scope, sent_if_few

# Minima per text, and low bits kept of each: a signature is 96 bytes.
MINIMA = 192
BITS = 4
BAND_ROWS = 5
# Chance that a pair at the threshold shares no band, and that its packed minima speak against it.
MISS = 1e-6
# Words of more bytes get a cryptographic hash; the fast one could be made to collide there.
LONG_WORD = 64
# Bits of the filter that tells which texts must be read again.
FILTER_BITS = 1 << 23
# Rows of a bucket that are compared in one task; a larger bucket is cut.
CHUNK_ROWS = 2_048
SEED = 77


@dataclass(frozen=True)
class Near:
    """Words of a shingle, and the similarity (percent) from which texts are linked."""

    words: int = 5
    percent: int = 80

    def __post_init__(self) -> None:
        if self.bands * BAND_ROWS > MINIMA:
            raise ValueError(f"{MINIMA} minima have too few bands of {BAND_ROWS} for {self.percent} percent")

    @property
    def bands(self) -> int:
        """As many bands as keep a pair at the threshold from being missed."""
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** BAND_ROWS))

    @property
    def least_equal(self) -> int:
        """Equal packed minima below which a pair is taken not to reach the threshold.

        By chance 1 in 2**BITS minima agree: P = c + (1 - c) J.  At the threshold fewer minima are equal with
        a chance of at most ``MISS`` (the tail of the binomial distribution).
        """
        chance = 1 / (1 << BITS)
        p = chance + (1 - chance) * self.percent / 100
        tail = 0.0
        for equal in range(MINIMA + 1):
            tail += math.comb(MINIMA, equal) * p**equal * (1 - p) ** (MINIMA - equal)
            if tail > MISS:
                return equal
        return MINIMA


def shingle_sets(block: list[bytes], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct shingles of lower-cased (A-Z) words.

    A text with fewer words has its whole sequence as one; one without words has none.
    """
    data = np.frombuffer(b" ".join(block) + b" ", np.uint8)
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + np.uint8(32), data)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    # A word's hash is the sum of its bytes' random values, each times a power for its place.
    power = np.full(int((ends - starts).max(initial=0)) + 1, 1, np.uint64)
    power[1:] = np.cumprod(np.full(len(power) - 1, 0x9E3779B97F4A7C15, np.uint64))
    letter = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    inside = ~blank
    values = np.zeros(len(data), np.uint64)
    values[inside] = letter[data[inside]] * power[place[inside]]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    hashes = mix64(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = int.from_bytes(blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    # First word of each text: the first that starts at or after the text does.
    lengths = np.array([len(b) + 1 for b in block])
    first = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
    for i in range(len(block)):
        own = hashes[first[i] : first[i + 1]]
        n = max(1, len(own) - words + 1) if len(own) else 0
        span = min(words, len(own))
        total = np.full(n, span, np.uint64)
        for k in range(span):
            total = mix64(total * np.uint64(0x9E3779B97F4A7C15) + own[k : k + n])
        yield np.unique(total)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = lambda: rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(), draw()


def sign(sets: list[np.ndarray], bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed low bits (rows x bytes) and band keys (rows x bands) of sets that are not empty."""
    a, b = _multipliers()
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    minima = np.empty((len(sets), MINIMA), np.uint64)
    for i in range(MINIMA):
        minima[:, i] = np.minimum.reduceat((flat ^ b[i]) * a[i], at)
    minima = mix64(minima)
    low = (minima & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    packed = low[:, 0::2] | low[:, 1::2] << np.uint8(4)
    keys = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), band + 1, np.uint64)
        for row in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, row])
        keys[:, band] = key
    return packed, keys


def set_id(items: np.ndarray) -> bytes:
    """128 bits that name a set: equal sets, and only these, share it."""
    if not len(items):
        return bytes(16)
    return np.array([np.bitwise_xor.reduce(mix64(items)), np.add.reduce(mix64(items ^ np.uint64(SEED)))], np.uint64).tobytes()


def signatures(docs: DataFrame, near: Near, text: str, key: str, carry: list[str]) -> DataFrame:
    """Stored, one row per row of ``docs``: its place ``row``, ``key``, size and name of its set, signature, bands."""
    own = F.struct(*carry).alias("_carry")
    rows = docs.select(own, F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"), F.col(text).alias("_t"))
    # The carried columns go through as they are.
    kept = rows.drop("_t").schema
    schema = rows.select("_carry", "row", "key", F.lit(0).cast("long").alias("n"), F.lit(b"").alias("cid"),
                         F.array().cast("array<long>").alias("sig"), F.array().cast("array<long>").alias("bands")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for _, block in text_blocks(batch.column(3)):
                sets = list(shingle_sets(block, near.words))
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = np.zeros((len(sets), MINIMA * BITS // 64), np.int64)
                bands: list = [[]] * len(sets)
                if full:
                    packed, keys = sign([sets[i] for i in full], near.bands)
                    sig[full] = packed.view(np.int64)
                    for i, row in zip(full, keys.view(np.int64), strict=True):
                        bands[i] = row
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(i).slice(done, len(sets)) for i in range(len(kept))],
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.binary()),
                    pa.array(list(sig), pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64())),
                ], names=schema.names)
                done += len(sets)

    return materialise(rows.mapInArrow(run, schema), "signatures")


def equal_minima(a: str, b: str) -> Column:
    """Equal 4-bit fields of two signatures, by bit counts of the folded exclusive or."""
    total = F.lit(0)
    ones = F.lit(0x1111111111111111)
    for i in range(MINIMA * BITS // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        total = total + (F.lit(64 // BITS) - F.bit_count(x.bitwiseAND(ones)))
    return total


def estimated(equal: Column) -> Column:
    """Similarity from equal minima, less what chance alone makes equal."""
    chance = 1 / (1 << BITS)
    return (equal / F.lit(MINIMA) - chance) / (1 - chance)


def _may_link(near: Near, a: str, b: str) -> Column:
    """Sizes allow the threshold, and the signatures do not speak against it."""
    na, nb = F.col(f"n_{a}"), F.col(f"n_{b}")
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * near.percent) & (equal_minima(f"sig_{a}", f"sig_{b}") >= near.least_equal)


def sets_of(ids: DataFrame, classes: DataFrame, docs: DataFrame, near: Near, text: str, key: str) -> DataFrame:
    """Stored ``(cid, items)``: the full sets of the classes in ``ids (cid)``, distinct.

    Sets are made again, only for texts whose key a fixed-size filter lets through: little else is
    shuffled.  The filter passes one key of each class asked for, and some others.
    """
    place = lambda k: F.pmod(F.xxhash64(k), F.lit(FILTER_BITS))
    spots = ids.join(classes.select("cid", place(F.col("first.key")).alias("p")), "cid")
    words = spots.select((F.col("p") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p % 64 AS int))").alias("m"))
    known = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.groupBy("w").agg(F.bit_or("m").alias("m")).toLocalIterator():
        known[r["w"]] = r["m"]
    sent = ids.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            at = batch.column(1).to_numpy()
            chosen = batch.column(0).take(pa.array(np.flatnonzero((bits[at >> 6] >> (at & 63)) & 1)))
            for _, block in text_blocks(chosen):
                sets = [s for s in shingle_sets(block, near.words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["cid", "items"],
                )

    made = docs.select(F.col(text), place(F.col(key).cast("long")).alias("place")).mapInArrow(run, "cid binary, items array<long>")
    return materialise(made.join(ids, "cid", "left_semi").dropDuplicates(["cid"]), "sets")


def reaches(near: Near, a: str, b: str) -> Column:
    """Whether two full sets reach the threshold."""
    shared = F.size(F.array_intersect(a, b))
    return shared * 100 >= (F.size(a) + F.size(b) - shared) * near.percent


def likely_pairs(cell: pa.Table, near: Near) -> list[tuple[int, int, int]]:
    """``(- equal minima, row, row)`` of one cell: in different components, and the signatures allow a link.

    Pairs are those of two chunks, or of one with itself, whose first shared bucket this is.
    """
    rows = lambda name: np.stack([v.values.to_numpy() for v in cell[name].combine_chunks()]).astype(np.int64)
    i, j, place = (cell[name][0].as_py() for name in ("i", "j", "place"))
    chunk, n = cell["chunk"].to_numpy(), cell["n"].to_numpy()
    sig, bands = rows("sig").view(np.uint64), rows("bands")
    part = _codes(cell["part"])
    found: list[tuple[int, int, int]] = []
    for p in range(len(n)):
        q = np.flatnonzero((part != part[p]) & (np.minimum(n, n[p]) * 100 >= np.maximum(n, n[p]) * near.percent))
        q = q[q > p] if i == j else q[chunk[q] == j] if chunk[p] == i else q[:0]
        x = sig[q] ^ sig[p]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        equal = MINIMA - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)
        q, equal = q[equal >= near.least_equal], equal[equal >= near.least_equal]
        first = (bands[q] == bands[p]).argmax(axis=1) == place
        found += [(-int(e), p, int(o)) for e, o in zip(equal[first], q[first], strict=True)]
    return sorted(found)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def needed_rows(cell: pa.Table, near: Near) -> pa.Table:
    """The rows of one cell that are in any likely pair."""
    rows = sorted({r for _, p, q in likely_pairs(cell, near) for r in (p, q)})
    return cell.select(["band", "cid"]).take(pa.array(rows, pa.int64()))


def compare_cell(cell: pa.Table, near: Near) -> pa.Table:
    """Links between different components of one cell, enough to connect what they connect.

    Likely pairs first, and none between components that a link found here has joined already.
    """
    n, cid, part, items = cell["n"].to_numpy(), cell["cid"].to_pylist(), _codes(cell["part"]), cell["items"].combine_chunks()
    joined = list(range(int(part.max(initial=0)) + 1))

    def root(c: int) -> int:
        while joined[c] != c:
            joined[c] = joined[joined[c]]
            c = joined[c]
        return c

    links = []
    for _, p, q in likely_pairs(cell, near):
        a, b = root(int(part[p])), root(int(part[q]))
        if a != b:
            shared = len(np.intersect1d(items[p].values.to_numpy(), items[q].values.to_numpy(), assume_unique=True))
            if shared * 100 >= (int(n[p]) + int(n[q]) - shared) * near.percent:
                joined[a] = b
                links.append((cid[p], cid[q]))
    return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})


def _sided(classes: DataFrame, side: str) -> DataFrame:
    return classes.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("sig").alias(f"sig_{side}"))


def link_classes(classes: DataFrame, docs: DataFrame, near: Near, text: str, key: str) -> DataFrame:
    """``(id, component)`` of the classes that link with another.

    First every member of a bucket against the bucket's representative (the smallest by a hash of bucket
    and class, so that buckets of one group ask different ones).  Buckets that this leaves in several
    components are compared across them, signatures first, then the full sets of rows that these leave,
    in cells of bounded size (a large bucket is cut into chunks, and every two chunks meet).  Rows and
    links leave a cell, never its pairs.  Two classes meet in the first bucket they share, nowhere else.
    """
    with scratch_scope(classes.sparkSession) as scope:
        return scope.keep(_link_classes(classes, docs, near, text, key))


def _link_classes(classes: DataFrame, docs: DataFrame, near: Near, text: str, key: str) -> DataFrame:
    banded = classes.select("cid", F.posexplode("bands").alias("place", "band"))
    buckets = banded.groupBy("band").agg(F.min(F.struct(F.xxhash64("band", "cid").alias("h"), "cid")).alias("rep"), F.count("*").alias("n"))
    members = materialise(banded.join(buckets.where("n > 1").select("band", F.col("rep.cid").alias("rep")), "band"), "members")
    stars = members.where("cid <> rep").select(F.least("cid", "rep").alias("a"), F.greatest("cid", "rep").alias("b")).distinct()
    likely = stars.join(_sided(classes, "a"), "a").join(_sided(classes, "b"), "b").where(_may_link(near, "a", "b"))
    pairs = materialise(likely.select("a", "b"), "pairs")
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct(), classes, docs, near, text, key)
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("items").alias("x")), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("items").alias("y")), "b"
    )
    links = materialise(both.where(reaches(near, "x", "y")).select("a", "b"), "links")
    found = components(links).withColumnRenamed("id", "cid")

    own = members.join(found, "cid", "left").select("band", "place", "cid", F.coalesce("component", "cid").alias("part"))
    parts = own.groupBy("band", "part").agg(F.count("*").alias("n")).groupBy("band").agg(
        F.sum("n").alias("size"), F.count("*").alias("n_parts")
    )
    open_bands = parts.where("n_parts > 1").select("band", F.ceil(F.col("size") / F.lit(CHUNK_ROWS)).cast("int").alias("chunks"))
    open_rows = materialise(own.join(open_bands, "band").join(classes.select("cid", "n", "sig", "bands"), "cid"), "open")

    chunk = F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")

    def cells(rows: DataFrame):
        pieces = rows.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        pieces = pieces.withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")})
        return pieces.drop("chunks", "other").groupBy("band", "i", "j")

    asked = cells(open_rows).applyInArrow(lambda cell: needed_rows(cell, near), "band long, cid binary").distinct()
    few = materialise(open_rows.join(asked, ["band", "cid"], "left_semi"), "needed")
    whole = few.join(sets_of(few.select("cid").distinct(), classes, docs, near, text, key), "cid")
    across = cells(whole).applyInArrow(lambda cell: compare_cell(cell, near), "a binary, b binary")
    return components(links.union(across))


def find(docs: DataFrame, near: Near = Near(), text: str = "text", key: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """``_carry`` (a struct of the columns named), ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``first``.

    ``component_id`` is the smallest key reachable over links (similarity of the shingle sets at the
    threshold or above), itself included; ``kept`` says that it is the row's own key.  ``first`` marks one
    row of each component, also where keys repeat.  Texts with equal sets are one class, and classes are
    linked.  Null and empty texts have no shingles and link with nothing: each is kept and first.  A null
    key is larger than any other; a component of nulls only has a null id and keeps them all.
    """
    carry = [key] if carry is None else carry
    signed = signatures(docs, near, text, key, carry)
    top = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "row")).alias("first")
    classes = materialise(signed.where("n > 0").groupBy("cid").agg(
        top, F.any_value("n").alias("n"), F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands")
    ), "classes")
    found = link_classes(classes, docs, near, text, key).withColumnRenamed("id", "cid")
    placed = classes.select("cid", "first").join(found, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    heads = placed.groupBy("component").agg(F.min("first").alias("head"))
    named = placed.join(heads, "component").select("cid", "head")
    rows = signed.where("n > 0").join(named, "cid").select(
        "_carry", F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("head.key").alias("component_id"),
        F.col("key").eqNullSafe(F.col("head.key")).alias("kept"), (F.col("row") == F.col("head.row")).alias("first"),
    )
    lone = signed.where("n = 0").select(
        "_carry", F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("key").alias("component_id"),
        F.lit(True).alias("kept"), F.lit(True).alias("first"),
    )
    return rows.union(lone)


def deduplicated(docs: DataFrame, near: Near = Near(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component; same columns.

    Null and empty texts link with nothing and stay, as in ``find``.  Only names of rows are stored, never
    their texts: those that go are few and are taken out where the table is read.
    """
    rows = numbered(docs)
    with scratch_scope(docs.sparkSession) as scope:
        found = find(rows, near, text, key, ROW)
        gone = materialise(found.where("NOT first").select(*[F.col("_carry").getField(c).alias(c) for c in ROW]), "gone")
        scope.keep(gone)
    return rows.join(sent_if_few(gone), ROW, "left_anti").select(*docs.columns)
