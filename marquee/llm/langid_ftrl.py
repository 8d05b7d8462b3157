"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained by follow-the-regularised-leader with an elastic-net penalty, then calibrated by one temperature.
Inverse document frequencies come from all allowed rows, weights from a bounded sample of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import fold_of
from marquee.llm.ngrams import gather, hashed, idf, sample_keys, weighted

BITS = 14
UNKNOWN = "und"
# Documents of each language that the weights are learned from; a fifth of them set the temperature.
SAMPLE_PER_LANG = 600
MAX_LANGS = 1_000


def letter_table() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def make_counter():
    """Counts of lower-case letter pairs and triples; runs of other characters are one blank.  None without letters."""
    is_letter = letter_table()

    def count(text: str) -> np.ndarray | None:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = is_letter[codes]
        if not letter.any():
            return None
        codes = np.where(letter, codes, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        codes = np.concatenate([[np.uint32(32)], codes[keep], [np.uint32(32)]])
        pairs = hashed([codes[:-1], codes[1:]], BITS, 2)
        triples = hashed([codes[:-2], codes[1:-1], codes[2:]], BITS, 3)
        return np.bincount(pairs, minlength=1 << BITS) + np.bincount(triples, minlength=1 << BITS)

    return count


@dataclass(frozen=True)
class Model:
    """Languages in order, weights by n-gram and language, inverse document frequencies, temperature."""

    langs: tuple[str, ...]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, alpha=0.5, beta=1.0, l1=0.02, l2=0.05, epochs=4) -> np.ndarray:
    """Weights (n-grams x languages) after ``epochs`` passes in a seeded order."""
    z = np.zeros((1 << BITS, n_langs))
    n = np.zeros_like(z)

    def current(at: np.ndarray) -> np.ndarray:
        part = z[at]
        shrunk = np.sign(part) * np.maximum(np.abs(part) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, lang = rows[i]
            w = current(at)
            error = softmax(x @ w)
            error[lang] -= 1.0
            gradient = x[:, None] * error[None, :]
            before = n[at]
            after = before + gradient**2
            z[at] += gradient - (np.sqrt(after) - np.sqrt(before)) / alpha * w
            n[at] = after
    return current(np.arange(1 << BITS))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def best_temperature(scores: np.ndarray, langs: np.ndarray) -> float:
    """The temperature with the least loss on rows that were not trained on."""
    if not len(scores):
        return 1.0
    grid = np.geomspace(0.02, 20.0, 120)
    loss = [-np.log(softmax(scores / t)[np.arange(len(langs)), langs] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = SAMPLE_PER_LANG) -> Model:
    """A model of the rows given (the caller leaves out what must not be learned from).

    Rows without language or letters teach nothing; without any, the model knows no language.
    """
    labelled = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).where("l IS NOT NULL")
    wanted = sample_keys(labelled, "k", "l", per_lang)
    frequencies, documents, found = gather(labelled, "k", "t", 1 << BITS, make_counter, set(wanted))
    weights = idf(frequencies, documents)
    langs = tuple(sorted({wanted[k] for k in found}))
    if len(langs) > MAX_LANGS:
        raise ValueError(f"{len(langs)} languages; at most {MAX_LANGS} can be learned")
    rows = [(at, weighted(at, n, weights), langs.index(wanted[k])) for k, (at, n) in sorted(found.items())]
    if len(langs) < 2:
        return Model(langs, np.zeros((1 << BITS, len(langs))), weights, 1.0)
    aside = [r for i, r in enumerate(rows) if i % 5 == 0]
    learned = ftrl([r for i, r in enumerate(rows) if i % 5], len(langs))
    scores = np.array([x @ learned[at] for at, x, _ in aside])
    return Model(langs, learned, weights, best_temperature(scores, np.array([r[2] for r in aside])))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of that language.

    A text that is null or holds no letter, or a model without languages, gives ``und`` and 0.  Equal
    scores go to the smaller name.  Rows are independent; the new names must not exist yet (ValueError).
    """
    if {"lang_pred", "score"} & set(docs.columns):
        raise ValueError("columns lang_pred and score exist already")
    # Plain values: a class in a broadcast is found by name only, and workers need no copy of this package.
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = Model(*sent.value), make_counter()

        def one(value: str | None) -> tuple[str, float]:
            counts = count(value) if value and known.langs else None
            if counts is None:
                return UNKNOWN, 0.0
            at = np.flatnonzero(counts)
            share = softmax(weighted(at, counts[at], known.idf) @ known.weights[at] / known.temperature)
            best = int(np.argmax(share))
            return known.langs[best], float(share[best])

        for batch in batches:
            made = [one(value.as_py()) for value in batch.column(place)]
            new = [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out(key="doc_id"):
    """Rows that no model may learn from: crc32 of the key modulo 3 is 1."""
    return fold_of(F.col(key), 3) == 1
