"""Quality by nearest-neighbour voting over latent-semantic vectors.

Texts become TF-IDF vectors of surface n-grams; a truncated SVD of a labelled sample gives the latent
space.  The labelled vectors (a bounded table) are broadcast, every document is compared with all of them
in blocked matrix products, and its nearest neighbours vote with their cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import fold_of, mix64
from marquee.llm.ngrams import gather, hashed, idf, sample_keys, weighted

BITS = 12
# How much of a text repeats is one of so many steps; a step has several places, so that it weighs
# against hundreds of n-grams.
REPEAT_STEPS = 16
REPEAT_PLACES = 24
DIMS = (2 << BITS) + REPEAT_STEPS * REPEAT_PLACES
RANK = 32
# Labelled documents of each label that vote (and that the latent space is made from).
VOTERS_PER_LABEL = 1_500
NEIGHBOURS = 25
SHARPNESS = 8.0
KEEP_SCORE = 0.3
BLOCK_ROWS = 256


def class_table() -> np.ndarray:
    """Byte -> class: letters by case, digits, bytes above ASCII are one class each; other bytes stay apart."""
    table = np.arange(256, dtype=np.uint8)
    for first, last, to in (("a", "z", "a"), ("A", "Z", "A"), ("0", "9", "0")):
        table[ord(first) : ord(last) + 1] = ord(to)
    table[128:] = ord("a")
    return table


def make_counter():
    """Counts of byte triples, of four-class shapes, and one step that says how much of a text repeats."""
    classes = class_table()

    def count(text: str) -> np.ndarray | None:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        counts = np.zeros(DIMS, np.int64)
        if len(data) < 4:
            return counts if text else None
        triples = hashed([data[:-2], data[1:-1], data[2:]], BITS, 3)
        counts[: 1 << BITS] = np.bincount(triples, minlength=1 << BITS)
        shape = classes[data]
        shapes = hashed([shape[:-3], shape[1:-2], shape[2:-1], shape[3:]], BITS, 4)
        counts[1 << BITS : 2 << BITS] = np.bincount(shapes, minlength=1 << BITS)
        if len(data) >= 24:
            # Distinct 12-byte windows against all of them; memory follows the text.
            eight = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
            windows = mix64(eight[:-4]) ^ eight[4:]
            windows.sort()
            distinct = 1 + np.count_nonzero(windows[1:] != windows[:-1])
            level = min(REPEAT_STEPS - 1, REPEAT_STEPS * distinct // len(windows))
            first = (2 << BITS) + level * REPEAT_PLACES
            counts[first : first + REPEAT_PLACES] = len(data)
        return counts

    return count


@dataclass(frozen=True)
class Voters:
    """Inverse document frequencies, latent axes, and the labelled vectors with their labels."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def latent_axes(x: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors by a seeded randomised SVD with four power steps."""
    rank = min(rank, *x.shape)
    sketch = x @ np.random.default_rng(3).standard_normal((x.shape[1], min(rank + 8, *x.shape))).astype(x.dtype)
    for _ in range(4):
        q, _ = np.linalg.qr(sketch)
        sketch = x @ (x.T @ q)
    q, _ = np.linalg.qr(sketch)
    _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
    return np.ascontiguousarray(vt[:rank].T)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", per_label: int = VOTERS_PER_LABEL) -> Voters:
    """Voters from ``labels (key, label 0/1)``; document frequencies come from all of ``docs``.

    The caller leaves out labels that must not be learned from.  Labels of a repeated key count with the
    smallest value; null keys and labels are left out.
    """
    wanted = sample_keys(labels, key, label, per_label)
    frequencies, documents, found = gather(docs, key, text, DIMS, make_counter, set(wanted))
    weights = idf(frequencies, documents)
    keys = [k for k, (at, _) in sorted(found.items()) if len(at)]
    x = np.zeros((len(keys), DIMS), np.float32)
    for i, k in enumerate(keys):
        at, n = found[k]
        x[i, at] = weighted(at, n, weights)
    axes = latent_axes(x, RANK) if len(keys) else np.zeros((DIMS, 1), np.float32)
    return Voters(weights, axes, unit(x @ axes).astype(np.float32), np.array([float(wanted[k]) for k in keys]))


def vote(vectors: np.ndarray, voters: Voters, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the nearest voters of each row, weighted by a power of their cosine."""
    if not len(voters.labels):
        return np.full(len(vectors), 0.5)
    cosine = vectors @ voters.vectors.T
    k = min(neighbours, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64) ** SHARPNESS
    total = weight.sum(axis=1)
    share = (weight * voters.labels[near]).sum(axis=1)
    return np.divide(share, total, out=np.zeros(len(vectors)), where=total > 0)


def score(docs: DataFrame, voters: Voters, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the vote of each whole text, from 0 to 1.

    A null or empty text, or one with no neighbour at a positive cosine, scores 0; without voters every
    other text scores 0.5.  Rows are independent; ``name`` must not exist yet (ValueError).
    """
    if name in docs.columns:
        raise ValueError(f"column exists already: {name}")
    # Plain values: a class in a broadcast is found by name only, and workers need no copy of this package.
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vars(voters).values()))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType(), False)])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = Voters(*sent.value), make_counter()
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            column = batch.column(place)
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                values = column.slice(first, BLOCK_ROWS)
                latent = np.zeros((len(values), known.axes.shape[1]), np.float32)
                filled = np.zeros(len(values), bool)
                for i, value in enumerate(values):
                    counts = count(value.as_py() or "")
                    if counts is not None:
                        at = np.flatnonzero(counts)
                        latent[i] = weighted(at, counts[at], known.idf) @ known.axes[at]
                        filled[i] = True
                scores[first : first + len(values)] = np.where(filled, vote(unit(latent), known), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out(key="doc_id"):
    """Rows whose labels no model may learn: crc32 of the key modulo 5 is 0."""
    return fold_of(F.col(key), 5) == 0
