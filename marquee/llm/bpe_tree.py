"""Byte-level BPE by tree reduction.

Encodings form a monoid: the encoding of two neighbours follows from theirs by re-encoding a small
window at the seam.  A piece is halved down to a few bytes and joined upwards; decoding concatenates
token bytes up the same tree.  Texts are first cut where no piece can reach across, so a long text is
a sum of short ones.

Why a window is enough: a byte sequence has exactly one tokenisation in which every pair of neighbouring
tokens is its own encoding, and that is its encoding.  Inside either side all pairs are already such.
So once the pairs at both ends of the re-encoded window are, nothing outside it can change; until then
the window grows by a token on the side that is not.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.common import text_blocks

CUT_CHARS = 1 << 14
MEMO_PIECES = 1 << 17
LEAF_BYTES = 16
NO_RANK = 1 << 62

# A plain blank after a non-blank: the next one ahead, and the last one before.
_SEAM = regex.compile(r"(?<=\S) ")
_SEAM_BACK = regex.compile(r"(?r)(?<=\S) ")


def read_ranks(path: str) -> bytes:
    """The rank file as it is (one vocabulary, under a few MB), to be sent to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class TreeCodec:
    """Encoder and decoder of one vocabulary; ``pattern`` cuts a text into pieces that are encoded alone."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.written = {rank: str(rank) for rank in self.bytes_of}
        self.pieces = regex.compile(pattern)
        # Pieces met lately, and those before them: what is still in use moves over when the first is full.
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE of a few bytes: the lowest rank merges first, the leftmost of equals."""
        parts = [data[i : i + 1] for i in range(len(data))]
        get = self.ranks.get
        ranks = [get(data[i : i + 2], NO_RANK) for i in range(len(data) - 1)]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            ranks.pop(i)
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], NO_RANK)
        return [self.ranks[p] for p in parts]

    def settled(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        pair = (left, right)
        known = self.pairs.get(pair)
        if known is None:
            known = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            if len(self.pairs) >= MEMO_PIECES:
                self.pairs.clear()
            self.pairs[pair] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours from their encodings."""
        if not left or not right or self.settled(left[-1], right[0]):
            return left + right
        i, j = len(left) - 1, 1
        while True:
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[i:] + right[:j])))
            open_left = i > 0 and not self.settled(left[i - 1], window[0])
            open_right = j < len(right) and not self.settled(window[-1], right[j])
            if not open_left and not open_right:
                return left[:i] + window + right[j:]
            i -= open_left
            j += open_right

    def encode_piece(self, data: bytes) -> list[int]:
        """A whole vocabulary entry is its own encoding; else the join of the halves' encodings."""
        rank = self.ranks.get(data)
        if rank is not None:
            return [rank]
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode_piece(data[:half]), self.encode_piece(data[half:]))

    def cuts(self, text: str) -> Iterator[str]:
        """The text in parts of about ``CUT_CHARS``, halved where a blank follows a non-blank.

        No piece reaches over such a place (pieces hold blanks only in front or alone), so parts encode
        alone.  A run without one stays whole.
        """
        if len(text) > CUT_CHARS:
            middle = len(text) // 2
            seam = _SEAM.search(text, middle) or _SEAM_BACK.search(text, 1, middle)
            if seam:
                yield from self.cuts(text[: seam.start()])
                yield from self.cuts(text[seam.start() :])
                return
        yield text

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.cuts(text):
            pieces = self.pieces.findall(part)
            known = [*map(self.memo.get, pieces)]
            if None in known:
                known = [self.remembered(p) if k is None else k for p, k in zip(pieces, known, strict=True)]
            ids.extend(chain.from_iterable(known))
        return ids

    def remembered(self, piece: str) -> tuple[int, ...]:
        """The ids of a piece that was not met lately."""
        known = self.memo.get(piece) or self.older.get(piece) or tuple(self.encode_piece(piece.encode("utf-8", "replace")))
        if len(piece) <= 32:
            if len(self.memo) >= MEMO_PIECES:
                self.older, self.memo = self.memo, {}
            self.memo[piece] = known
        return known

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated pairwise up the tree; a leaf is a run of 1,024 tokens."""
        level = [b"".join(map(self.bytes_of.__getitem__, ids[i : i + 1024])) for i in range(0, len(ids), 1024)]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


def _per_text(docs: DataFrame, text: str, ranks: bytes, pattern: str, fields: list[T.StructField], make) -> DataFrame:
    """``docs`` with columns that ``make(codec, text)`` returns; a null text is empty."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType(docs.schema.fields + fields)
    place = docs.columns.index(text)
    kinds = [pa.int64() if isinstance(f.dataType, T.LongType) else pa.list_(pa.int32()) if isinstance(f.dataType, T.ArrayType) else pa.string() for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(parse_ranks(sent.value), pattern)
        for batch in batches:
            for first, block in text_blocks(batch.column(place)):
                made = [make(codec, value.decode("utf-8", "surrogatepass")) for value in block]
                columns = [pa.array([row[i] for row in made], kind) for i, kind in enumerate(kinds)]
                own = [c.slice(first, len(block)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*own, *columns], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", name: str = "token_ids", checked: bool = False) -> DataFrame:
    """``docs`` and the ids of each whole text as ``array<int>``.

    A null or empty text has no ids.  Rows are independent, so repeated rows repeat; no shuffle.
    ``checked`` decodes the ids again and adds ``decoded_sha256`` of the bytes.  New columns must not exist
    in ``docs`` (ValueError).
    """
    fields = [T.StructField(name, T.ArrayType(T.IntegerType(), False), False)]
    if checked:
        fields.append(T.StructField("decoded_sha256", T.StringType(), False))
    _free(docs, [f.name for f in fields])

    def make(codec: TreeCodec, value: str) -> tuple:
        ids = codec.encode(value)
        row = (np.asarray(ids, np.int32),)
        return (*row, hashlib.sha256(codec.decode(ids)).hexdigest()) if checked else row

    return _per_text(docs, text, ranks, pattern, fields, make)


def decode(tokens: DataFrame, ranks: bytes, ids: str = "token_ids", name: str = "text") -> DataFrame:
    """``tokens`` and the decoded text; bytes that are no UTF-8 become replacement characters, null stays null."""
    _free(tokens, [name])
    sent = tokens.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([*tokens.schema.fields, T.StructField(name, T.StringType())])
    place = tokens.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(parse_ranks(sent.value), "")
        for batch in batches:
            rows = [value.as_py() for value in batch.column(place)]
            texts = [None if row is None else codec.decode(row).decode("utf-8", "replace") for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[f.name for f in schema.fields])

    return tokens.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, the hash of the ids (decimal, joined by blanks) and of the decoded bytes."""
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    _free(docs, names)

    def make(codec: TreeCodec, value: str) -> tuple[int, str, str]:
        ids = codec.encode(value)
        written = " ".join(map(codec.written.__getitem__, ids)).encode()
        return len(ids), hashlib.sha256(written).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()

    fields = [T.StructField(names[0], T.LongType(), False), *[T.StructField(n, T.StringType(), False) for n in names[1:]]]
    return _per_text(docs, text, ranks, pattern, fields, make)


def _free(df: DataFrame, names: list[str]) -> None:
    clash = sorted(set(names) & set(df.columns))
    if clash:
        raise ValueError(f"columns exist already: {clash}")
