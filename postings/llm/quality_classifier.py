"""Hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

A word is a run of letters, of digits or of other marks. Its n-grams hash into
``2**bits`` weights: single words and pairs as they are (case folded), and one to
three words by their shape (letter case, digits, the marks themselves). A word
triple that occurs several times in its text also counts under its multiplicity
alone. A feature's value is its share among the text's n-grams of its kind, so a
score is a sparse dot product: the weights' mean per kind, summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm import labelled
from postings.llm.text import FOLD, SPACE, grams, hashes, mix, row_of, runs, slices

BITS = 18
SAMPLE = 6000
THRESHOLD = 0.3
SCALE = 8.0
_U = np.uint64

_KIND = np.where(SPACE, 0, 3).astype(np.int8)
for _span, _kind in ((range(48, 58), 2), (range(65, 91), 1), (range(97, 123), 1), (range(128, 256), 1)):
    _KIND[list(_span)] = _kind
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LOWER = np.zeros(256, np.int64)
_LOWER[97:123] = 1


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of every n-gram of a slice of texts; a bucket may occur several times in a row."""
    kind = _KIND[data]
    starts, ends = runs(kind, offsets)
    word = hashes(FOLD[data], starts, ends)
    row = row_of(starts, offsets)
    upper, lower = (np.concatenate(([0], np.cumsum(t[data]))) for t in (_UPPER, _LOWER))
    ups, lows = upper[ends] - upper[starts], lower[ends] - lower[starts]
    shape = np.where((ups > 1) & (lows == 0), 11, np.where(ups > 0, 12, 13)).astype(np.uint64)
    kinds = kind[starts]
    shape = mix(np.where(kinds == 1, shape, np.where(kinds == 2, _U(14), word)))
    rows, buckets, values = [], [], []

    def add(at: np.ndarray, hashed: np.ndarray, group: int, share: np.ndarray | None = None) -> None:
        count = np.bincount(at, minlength=len(offsets) - 1)
        rows.append(at)
        buckets.append((mix(hashed + _U(group)) >> _U(64 - bits)).astype(np.int64))
        values.append(SCALE / count[at] if share is None else share)

    for size in (1, 2):
        n = max(len(word) - size + 1, 0)
        whole = row[:n] == row[size - 1:]
        add(row[:n][whole], grams(word, size)[whole], size)
    for size in (1, 2, 3):
        n = max(len(word) - size + 1, 0)
        whole = row[:n] == row[size - 1:]
        add(row[:n][whole], grams(shape, size)[whole], 10 + size)
    n = max(len(word) - 2, 0)
    whole = row[:n] == row[2:]
    at = row[:n][whole]
    if len(at):
        key = grams(word, 3)[whole] ^ mix(at.astype(np.uint64) + _U(77))
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        add(at, np.log2(times[inverse]).astype(np.uint64), 20)
    return np.concatenate(rows), np.concatenate(buckets), np.concatenate(values)


def train(texts: pa.Array, labels: np.ndarray, bits: int = BITS, epochs: int = 3, alpha: float = 0.6,
          beta: float = 1.0, l1: float = 0.002, l2: float = 0.001) -> np.ndarray:
    """Weights after ``epochs`` rounds of per-coordinate leader updates; the last weight is the bias."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    examples = []
    for first, data, offsets in slices(texts):
        row, bucket, value = features(data, offsets, bits)
        key, inverse = np.unique(row * size + bucket, return_inverse=True)
        value = np.bincount(inverse, value, len(key))
        cuts = np.searchsorted(key, np.arange(len(offsets)) * size)
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            index = np.append(key[a:b] - r * size, size).astype(np.int32)
            examples.append((index, np.append(value[a:b], 1.0).astype(np.float32), labels[first + r]))
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(examples)):
            index, x, y = examples[k]
            zi, ni = z[index], n[index]
            w = _weights(zi, ni, alpha, beta, l1, l2)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[index] = zi + g - step * w
            n[index] = ni + g * g
    return _weights(z, n, alpha, beta, l1, l2)


def _weights(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
    return np.where(np.abs(z) <= l1, 0.0, w)


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The probability of label 1 for each text; a text without words gets the bias alone."""
    bits = (len(weights) - 1).bit_length() - 1
    out = np.zeros(len(texts))
    for first, data, offsets in slices(texts):
        row, bucket, value = features(data, offsets, bits)
        out[first:first + len(offsets) - 1] = np.bincount(row, value * weights[bucket], len(offsets) - 1)
    return 1 / (1 + np.exp(-np.clip(out + weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, bits: int = BITS) -> np.ndarray:
    """Train on at most ``sample`` labelled rows in one task; without any, every score is one half."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if tables:
            table = pa.Table.from_batches(tables).sort_by([("doc_id", "ascending"), ("text", "ascending")])
            weights = train(table["text"], np.asarray(table["label"]), bits)
            yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()]})

    rows = labelled.training_rows(docs, labels, label, sample).repartition(1).mapInArrow(run, "weights binary").collect()
    return np.frombuffer(rows[0].weights) if rows else np.zeros((1 << bits) + 1)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD, **fitting) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    NULL and empty texts get the bias's score; repeated rows get equal scores; a NULL id is kept.
    Labels that are NULL teach nothing. Other columns are ignored.
    """
    weights = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, **fitting).astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(b.column(1), weights.value), pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
