"""A quality classifier: Naive Bayes features under a linear hinge-loss model.

A text is a set of n-grams: its words, and runs of up to three word shapes (which kinds of characters a
word begins, goes on and ends with, and whether it repeats the word before it). Each n-gram is an
indicator scaled by the log of how much likelier it is in good than in bad texts; rows have length one. The
hinge loss is minimised by dual coordinate descent, and out-of-fold margins give the slope and offset that turn
a margin into a probability.

Fitting uses a bounded sample of labelled rows (``SAMPLE`` of each class), scoring is one pass without a
shuffle. A text's score depends on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintner.llm.arrays import Words, distinct_pairs, folds, mixed, text_slices
from vintner.llm.shared import appended, bounded_sample, fresh, stored

#: Most labelled rows of each class that the model is fitted on.
SAMPLE = 6000
BITS = 18
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 20
FOLDS = 3
#: The end of the range in which the log of the odds of a score stays, so that a score is never 0 or 1.
LIMIT = 30.0

_KIND = np.full(256, 7, dtype=np.int64)  # other signs
_KIND[97:123] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[128:] = 0  # parts of letters beyond ASCII, nearly always
_KIND[[46, 44, 59, 58]] = 3  # . , ; :
_KIND[[33, 63]] = 4
_KIND[[39, 34, 40, 41, 45]] = 5
_KIND[[124]] = 6


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, n-gram) of every text and n-gram in it, each pair once."""
    words = Words(data, offsets, fold=False)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    (hashes,) = words.hashes()
    text, start, end = words.text, words.start, words.end
    middle = np.minimum(start + 1, end - 1)
    before_last = np.maximum(end - 2, start)
    again = np.zeros(len(words), dtype=np.int64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    shape = (((_KIND[data[start]] * 8 + _KIND[data[middle]]) * 8 + _KIND[data[before_last]]) * 8 + _KIND[data[end - 1]]) * 2 + again
    runs = shape.astype(np.uint64) + np.uint64(1 << 32)
    texts, grams = [text, text], [hashes, mixed(runs)]
    for _ in range(2):
        size = len(grams[-1])
        if size < 2:
            break
        same = text[: size - 1] == text[len(words) - size + 1 :]
        run = mixed(grams[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + runs[len(words) - size + 1 :])
        grams.append(run)
        texts.append(np.where(same, text[: size - 1], -1))
    text, gram = np.concatenate(texts), np.concatenate(grams)
    gram = mixed(gram) >> np.uint64(64 - BITS)
    return distinct_pairs(text[text >= 0], gram[text >= 0])


@dataclass
class QualityModel:
    weights: np.ndarray  # of an indicator, log-count ratio included
    scales: np.ndarray  # squares of the log-count ratios, for a row's length
    bias: float
    slope: float
    offset: float

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, gram = features(data, offsets)
        n = len(offsets) - 1
        gram = gram.astype(np.int64)
        total = np.bincount(text, self.weights[gram], minlength=n)
        length = np.sqrt(np.bincount(text, self.scales[gram], minlength=n))
        return total / np.maximum(length, 1e-12) + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for a, b, data, offsets in text_slices(column):
            odds = np.clip(self.slope * self.margins(data, offsets) + self.offset, -LIMIT, LIMIT)
            out[a:b] = 1 / (1 + np.exp(-odds))
        return out


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log of the smoothed share of each n-gram among those of good texts over that of bad texts; 0 if never seen."""
    counts = np.zeros((2, 1 << BITS))
    for row, label in zip(rows, labels, strict=True):
        counts[int(label), row] += 1
    shares = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True)
    return np.where(counts.sum(axis=0) > 0, np.log(shares[1] / shares[0]), 0.0)


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, width: int, cost: float = COST, rounds: int = ROUNDS
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half their squares plus the hinge losses times the cost.

    A row is its columns and values; labels are 1 and -1. Classes get the same total cost. One dual
    variable at a time is set to its best value in [0, cost of the row], in a seeded random order, until no
    projected gradient of a round is over a thousandth.
    """
    weights, bias = np.zeros(width), 0.0
    alpha = np.zeros(len(rows))
    n_good = max(1, int((labels > 0).sum()))
    n_bad = max(1, len(labels) - n_good)
    upper = np.where(labels > 0, cost * len(labels) / (2 * n_good), cost * len(labels) / (2 * n_bad))
    norms = np.array([float(v @ v) + 1.0 for v in values])
    random = np.random.default_rng(7)
    for _ in range(rounds):
        worst = 0.0
        for i in random.permutation(len(rows)):
            row, value, y = rows[i], values[i], labels[i]
            gradient = y * (float(weights[row] @ value) + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), upper[i])
            step = (new - alpha[i]) * y
            if step:
                worst = max(worst, abs(new - alpha[i]) * norms[i])
                alpha[i] = new
                weights[row] += step * value
                bias += step
        if worst < 1e-3:
            break
    return weights, bias


def _fitted(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    ratios = log_count_ratios(rows, labels)
    values = []
    for row in rows:
        value = ratios[row]
        values.append(value / max(float(np.sqrt(value @ value)), 1e-12))
    weights, bias = dual_coordinate_descent(rows, values, np.where(labels > 0, 1.0, -1.0), 1 << BITS)
    return weights * ratios, ratios**2, bias


def logistic_line(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of the log odds of label 1 on the margin, by Newton's method."""
    if not len(margins) or labels.min() == labels.max():
        return 1.0, 0.0
    # Targets a little inside 0 and 1, so that classes that a margin separates have a finite answer.
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    line = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -LIMIT, LIMIT)))
        slope = x.T @ (p - target) + 1e-6 * line
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        line = line - step / max(1.0, float(np.abs(step).max()) / 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(line[0]), 0.0), float(line[1])


def sampled_features(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of n-grams and labels of a bounded sample of the labelled documents.

    Labels other than 0 and 1, and rows without a doc_id, are left out; of a doc_id labelled twice each
    row counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IN (0, 1)")
    # At most two classes times the limit rows.
    sample = stored(bounded_sample(known, "doc_id", "label", limit), "labelled-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[bytes] = []
            for a, b, data, offsets in text_slices(batch.column(2)):
                text, gram = features(data, offsets)
                bounds = np.searchsorted(text, np.arange(b - a + 1))
                gram = gram.astype("<i4")
                rows += [gram[x:y].tobytes() for x, y in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["doc_id", "label", "grams"]
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    found = joined.mapInArrow(run, "doc_id long, label int, grams binary").toArrow().sort_by(
        [("doc_id", "ascending"), ("label", "ascending")]
    )
    rows = [np.frombuffer(x.as_py(), dtype="<i4") for x in found.column("grams")]
    return rows, found.column("label").to_numpy().astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = SAMPLE) -> QualityModel:
    """A model of ``label`` from at most ``limit`` labelled documents of each class.

    With no labelled rows, or of one class only, every score is that class's share (a half without any).
    """
    rows, y = sampled_features(docs, labels, label, limit)
    if not len(y) or y.min() == y.max():
        share = 0.5 if not len(y) else (0.0 if y[0] == 0 else 1.0)
        flat = np.zeros(1 << BITS)
        return QualityModel(flat, flat, 0.0, 0.0, {0.5: 0.0, 0.0: -LIMIT, 1.0: LIMIT}[share])
    margins = np.zeros(len(y))
    for fold in range(FOLDS):
        out = folds(len(y), FOLDS) == fold
        if not out.any() or out.all() or y[~out].min() == y[~out].max():
            continue
        weights, scales, bias = _fitted([r for r, o in zip(rows, out, strict=True) if not o], y[~out])
        for i in np.flatnonzero(out):
            margins[i] = weights[rows[i]].sum() / max(float(np.sqrt(scales[rows[i]].sum())), 1e-12) + bias
    weights, scales, bias = _fitted(rows, y)
    return QualityModel(weights, scales, bias, *logistic_line(margins, y))


def with_scores(docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score") -> DataFrame:
    """All rows and columns, and the score of the text (0 to 1); a null or empty text is scored as an empty one."""
    texts = fresh("text_to_score", docs.columns)
    held = docs.withColumn(texts, F.col(text).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            found = model.scores(batch.column(last))
            yield appended(batch.select(range(last)), **{score: pa.array(found)})

    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])
    return held.mapInArrow(run, schema)
