"""Toxic passages as maximum-scoring segments of token log-odds.

A token is the stem of a run of letters: its first letters, case folded. Runs
longer than words are, and runs of scripts that set no spaces, are cut into
overlapping grams instead, so every letter is in a token. A token's score
is the log-odds of its occurrences in toxic against other labelled texts under
Dirichlet priors, drawn towards zero by its standard error, less a constant
drift, so that clean prose scores negative. Of n
occurrences in one text 1 + ln n count, and the error counts texts alone, since
repeats within one text do not make a token surer. All maximal
segments of a text are found in one linear scan. A segment's score is set
against the extreme values that clean prose of that length would give. The best
segments of a text are judged together, so that many passages too short to count
alone can be significant as a set; what that set is worth is the statistic of
the text, which a logistic curve turns into a probability.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm import labelled
from postings.llm.text import FOLD, hashes, row_of, runs, slices

BITS = 20
SAMPLE = 20000
STEM = 5
DRIFT = 0.5
PRIOR = 50.0
EXPECTED = 0.05
THRESHOLD = 0.5
#: Counts are summed as whole numbers of this part, so their sums do not depend on an order.
PART = 1 << 16
_U = np.uint64

#: A longer run of letters is no word.
LONGEST_WORD = 24
#: Letters in a gram: of runs longer than words, of Chinese and Japanese, of Thai and its like.
GRAM = np.array([0, STEM, 2, 4])
_CHINESE = ((0x2E80, 0x3100), (0x31C0, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1AFF0, 0x1B170), (0x20000, 0x40000))
_THAI = ((0x0E00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x1AB0), (0xA9E0, 0xAA00), (0xAA60, 0xAAE0))


@cache
def _kinds() -> np.ndarray:
    """Of each code point: 0 no letter, else its place in ``GRAM``. Marks belong to their letters."""
    kind = np.zeros(0x110000, np.int8)
    kind[[i for i in range(0x40000) if unicodedata.category(chr(i))[0] in "LM"]] = 1
    kind[0xE0100:0xE01F0] = 1
    for k, spans in ((2, _CHINESE), (3, _THAI)):
        for a, b in spans:
            kind[a:b][kind[a:b] > 0] = k
    return kind


def _points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes, and the byte each starts at, the end last."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[starts].astype(np.int32)
    more = np.digitize(lead, [0xC0, 0xE0, 0xF0])
    point = np.where(more == 0, lead, lead & (0x3F >> more))
    for k in (1, 2, 3):
        wide = np.flatnonzero(more >= k)
        point[wide] = point[wide] << 6 | (data[np.minimum(starts[wide] + k, len(data) - 1)] & 0x3F)
    return point, np.append(starts, len(data))


def tokens(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, start, end) of every token of a slice of texts."""
    point, at = _points(data)
    kinds = _kinds()[point]
    starts, ends = runs(kinds, np.searchsorted(at, offsets))
    kind, length = kinds[starts], ends - starts
    gram = GRAM[kind]
    cut = (kind > 1) | (length > LONGEST_WORD)
    count = np.where(cut, np.maximum(length - gram + 1, 1), 1)
    run = np.repeat(np.arange(len(starts)), count)
    first = starts[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    last = np.minimum(first + gram[run], ends[run])
    stem = hashes(FOLD[data], at[first], at[last])
    starts, ends = at[first], at[np.where(cut[run], last, ends[run])]
    return row_of(starts, offsets), (stem >> _U(64 - bits)).astype(np.int64), starts, ends


@dataclass
class Model:
    """Token scores with the drift taken off, the decay of extreme values, and the logistic curve."""

    score: np.ndarray
    decay: float
    bias: float = -4.0
    slope: float = 0.5


def log_odds(
    toxic: np.ndarray, other: np.ndarray, toxic_texts: np.ndarray, other_texts: np.ndarray, prior: float = PRIOR, drift: float = DRIFT,
) -> np.ndarray:
    """Scores from how often each token counts in toxic and in other texts, and in how many texts of either.

    The prior spreads ``prior`` pseudo-counts over the tokens as they occur in all
    texts, plus a half for each; 1.96 standard errors, which follow from the texts, are taken off.
    """
    unseen = toxic + other == 0
    t, o = _with_prior(toxic, other, prior)
    gap = np.log(t / max(t[~unseen].sum(), 1)) - np.log(o / max(o[~unseen].sum(), 1))
    t, o = _with_prior(toxic_texts, other_texts, prior)
    sure = np.maximum(np.abs(gap) - 1.96 * np.sqrt(1 / t + 1 / o), 0)
    return np.where(unseen, 0, np.sign(gap) * sure) - drift


def _with_prior(toxic: np.ndarray, other: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    both = toxic + other
    a = np.where(both > 0, prior * both / max(both.sum(), 1) + 0.5, 1.0)
    return toxic + a, other + a


def decay_of(score: np.ndarray, other: np.ndarray) -> float:
    """The positive root of sum p exp(decay * score) = 1 over clean tokens; a rare gain is assumed where clean texts show none."""
    p = np.append(other + 0.0, 1.0)
    s = np.append(score, max(1.0, score.max(initial=1.0) / 2))
    p /= p.sum()
    low, high = 1e-6, 50.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(np.minimum(mid * s, 700)) < 1 else (low, mid)
    return low


def segments(bounds: np.ndarray, at: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first token, last token, score), in one scan.

    A segment starts and ends at a token that gains, so only those are scanned: ``at`` are their numbers, and
    ``bounds`` the running sum of all scores before and after each. Each segment has a link to the nearest earlier one
    with a lower sum before it.
    """
    found: list[list[float]] = []
    for left, right, k in zip(bounds[:, 0].tolist(), bounds[:, 1].tolist(), at.tolist()):
        j = len(found) - 1
        while j >= 0 and found[j][2] >= left:
            j = found[j][4]
        found.append([k, k, left, right, j])
        # A segment made longer keeps its sum before and its link.
        while j >= 0 and found[j][3] < right:
            found[j][1], found[j][3] = k, right
            del found[j + 1:]
            j = found[j][4]
    return [(a, b, right - left) for a, b, left, right, _ in found]


def evidence(normal: np.ndarray) -> tuple[float, int]:
    """What the segments of a text are worth together, and how many of the best give that.

    ``normal`` are normalised scores, highest first. The r best of clean prose have a sum above t with a
    probability of about exp(-t) t^(r-1) / (r! (r-1)!); the least over all r counts, as its negative logarithm.
    """
    total, r = np.cumsum(normal), np.arange(1, len(normal) + 1)
    worth = total - (r - 1) * np.log(np.maximum(total, 1e-9)) + 2 * np.cumsum(np.log(r)) - np.log(r)
    worth = np.where(total > r - 1, worth, 0.0)  # below, the sum is no rare one
    best = int(worth.argmax())
    return max(float(worth[best]), 0.0), best + 1


def passages(texts: pa.Array, model: Model, expected: float = EXPECTED) -> Iterator[tuple[float, list[tuple[int, int, float]]]]:
    """Per text its statistic and the significant passages as (first byte, end byte, normalised score), in order.

    The passages are those of the best set, where clean prose would hold fewer than ``expected`` such sets.
    """
    bits = len(model.score).bit_length() - 1
    for _, data, offsets in slices(texts):
        row, bucket, starts, ends = tokens(data, offsets, bits)
        score = model.score[bucket]
        total = np.concatenate(([0.0], np.cumsum(score)))
        first = np.searchsorted(row, np.arange(len(offsets)))
        gains = np.flatnonzero(score > 0)
        cut = np.searchsorted(gains, first)
        for r in range(len(offsets) - 1):
            k = gains[cut[r]:cut[r + 1]]
            if not len(k):
                yield 0.0, []
                continue
            found = segments(np.stack((total[k], total[k + 1]), 1), k)
            normal = model.decay * np.array([s for *_, s in found]) - np.log(first[r + 1] - first[r])
            order = np.argsort(-normal, kind="stable")
            worth, best = evidence(normal[order])
            chosen = np.sort(order[:best]) if worth >= -np.log(expected) else []
            yield worth, [(int(starts[found[i][0]] - offsets[r]), int(ends[found[i][1]] - offsets[r]), float(normal[i])) for i in chosen]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, bits: int = BITS) -> Model:
    """Count tokens over at most ``sample`` labelled texts, spread over tasks; only ``2**bits`` sums come back."""
    rows = labelled.training_rows(docs, labels, label, sample)
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, held_by = np.zeros((2, size), np.int64), np.zeros((2, size), np.int64)
        for b in batches:
            label_of = np.asarray(b.column("label"))
            for first, data, offsets in slices(b.column("text")):
                row, bucket, _, _ = tokens(data, offsets, bits)
                key, n = np.unique(row * size + bucket, return_counts=True)
                toxic = label_of[first + key // size] == 1
                for k in (0, 1):
                    mine = toxic == bool(k)
                    np.add.at(times[k], key[mine] % size, np.rint((1 + np.log(n[mine])) * PART).astype(np.int64))
                    held_by[k] += np.bincount(key[mine] % size, minlength=size)
        at = np.flatnonzero(held_by.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(c[k][at]) for c in (times, held_by) for k in (0, 1))], ["bucket", *names])

    names = ["other", "toxic", "other_texts", "toxic_texts"]
    counted = rows.mapInArrow(count, f"bucket long, {', '.join(f'{n} long' for n in names)}")
    sums = counted.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    at = np.asarray(sums["bucket"])
    dense = {n: np.zeros(size) for n in names}
    for n, column in dense.items():
        column[at] = np.asarray(sums[n])
    dense["other"] /= PART
    dense["toxic"] /= PART
    other = dense["other"]
    score = log_odds(**dense).astype(np.float32)
    model = Model(score, decay_of(score.astype(float), other))

    # The curve is fitted to counts of texts by label and by statistic in steps of a half, up to a bound.
    def statistic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = np.array([s for s, _ in passages(b.column("text"), model)] or [0.0])[:b.num_rows]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(np.minimum(sums * 2, 400).astype(np.int64))], ["label", "step"])

    counts = rows.mapInArrow(statistic, "label int, step long").groupBy("label", "step").count().toArrow()
    model.bias, model.slope = _curve(np.asarray(counts["step"]) / 2, np.asarray(counts["label"]) == 1, np.asarray(counts["count"]).astype(float))
    return model


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one variable (its logarithm), by Newton steps with a small ridge."""
    if not len(x) or not y.any() or y.all():
        return -4.0, 2.0
    x = np.log1p(x)
    design = np.stack((np.ones_like(x), x), 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - 0.1 * beta
        curve = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + 0.1 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return float(beta[0]), float(beta[1])


def find(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, passages) of every row of ``docs``; a passage is (first byte, end byte, normalised score).

    NULL, empty and letterless texts have no passage and the lowest score; repeated rows get equal results.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            found = list(passages(b.column(1), m))
            x = np.log1p(np.array([s for s, _ in found]))
            p = 1 / (1 + np.exp(-np.clip(m.bias + m.slope * x, -30, 30)))
            spans = pa.array([[{"first": a, "end": e, "score": s} for a, e, s in kept] for _, kept in found], span)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64()), spans], ["doc_id", "score", "passages"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, passages array<struct<first:long,end:long,score:double>>")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, **fitting) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages) of every row of ``docs``."""
    found = find(docs, fit(docs, labels, label, **fitting))
    return found.select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"),
    )
