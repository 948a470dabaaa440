"""Toxicity categories by a chain of linear models.

The chain predicts one category after the other; the last link is the label itself. Each link is a
logistic model over the words of a text (and the beginnings of words, for words that are disguised by
their endings) and the log odds of all earlier links. While fitting, a row's earlier log odds come from
models that have not seen the row (out-of-fold), so a later link learns how far the earlier ones can be
trusted on new texts; on new texts the earlier links feed the later ones.

Labels say only whether a text is toxic. The categories of toxic rows are therefore set by word lists,
a parameter: a toxic row belongs to each category one of whose words it holds, and to ``veiled`` if it
holds none. A row that is not toxic belongs to no category, whatever its words.

Fitting uses a bounded sample (``SAMPLE`` rows of each label), scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintner.llm.arrays import Words, distinct_pairs, folds, text_slices
from vintner.llm.shared import appended, bounded_sample, fresh, stored

#: Most labelled rows of each label that the chain is fitted on.
SAMPLE = 8000
#: Words that put a toxic row into a category. Weak labels: scores do not depend on them but through what is learnt.
CATEGORIES = {
    "insult": ("idiot", "moron", "clown", "loser", "scum", "trash"),
    "contempt": ("pathetic", "worthless", "disgusting", "stupid"),
}
VEILED = "veiled"
LABEL = "toxic"
PREFIXES = (4, 5, 6)
#: N-grams offered to the selection, and those that the links use.
CANDIDATES = 1 << 16
SELECTED = 2048
#: Fewest toxic rows of the sample with a feature, and least statistic of its association with the label.
LEAST_ROWS = 3
LEAST_G = 12.0
PENALTY = 1e-5
STEPS = 500
FOLDS = 3
LIMIT = 15.0
#: A row of either label is equally likely in the sample, so this asks for some doubt only.
THRESHOLD = 0.3


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Text of every word (letters and digits, A-Z as a-z), and hashes of the words and of their beginnings."""
    words = Words(data, offsets, letters=True)
    whole, *starts = words.hashes(PREFIXES)
    return words.text, [whole, *(h ^ np.uint64(k) for h, k in zip(starts, PREFIXES, strict=True))]


def _word_hashes(words: tuple[str, ...]) -> np.ndarray:
    data = " ".join(words).encode()
    return tokens(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))[1][0]


class Lookup:
    """Places of known features in a sorted table; a small bit table turns most others away first."""

    def __init__(self, known: np.ndarray):
        self.known = np.sort(known)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.known & np.uint64(len(self.seen) - 1)).astype(np.int64)] = True

    def pairs(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, place of the feature), each pair once, by text."""
        text, kinds = tokens(data, offsets)
        texts, places = [], []
        for hashes in kinds:
            hit = np.flatnonzero(self.seen[(hashes & np.uint64(len(self.seen) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.known, hashes[hit]), max(len(self.known) - 1, 0))
            sure = self.known[at] == hashes[hit] if len(self.known) else np.zeros(0, dtype=bool)
            texts.append(text[hit][sure] if len(self.known) else hit[:0])
            places.append(at[sure] if len(self.known) else at[:0])
        found, place = distinct_pairs(np.concatenate(texts), np.concatenate(places))
        return found, place.astype(np.int64)


def _sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    return np.repeat(np.arange(len(rows)), lengths), np.concatenate([np.zeros(0, np.int64), *rows])


def logistic(row: np.ndarray, place: np.ndarray, extra: np.ndarray, y: np.ndarray, width: int) -> np.ndarray:
    """Weights of the indicators, of the extra columns and the offset, by accelerated gradient steps.

    The mean log loss plus a small penalty on the squared weights; (row, place) has the indicators set.
    """
    n, k = len(y), extra.shape[1]
    if not n:
        return np.zeros(width + k + 1)
    both = np.concatenate([extra, np.ones((n, 1))], axis=1)

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, w[place], minlength=n) + both @ w[width:]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(place, r[row], minlength=width), both.T @ r])

    v = np.ones(width + k + 1)
    for _ in range(20):
        v = back(times(v / max(float(np.linalg.norm(v)), 1e-12)))
    step = 1 / (0.25 * np.linalg.norm(v) / n * 1.05 + PENALTY)
    w = ahead = np.zeros(width + k + 1)
    t = 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(times(ahead), -30, 30)))
        new = ahead - step * (back(p - y) / n + PENALTY * np.concatenate([ahead[:-1], [0.0]]))
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / faster * (new - w)
        w, t = new, faster
    return w


@dataclass
class ToxicityChain:
    names: list[str]
    lookup: Lookup
    links: list[np.ndarray]  # weights of the indicators, of the earlier links, and the offset

    def log_odds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row per text, a column per category in the order of the chain."""
        n, width = len(offsets) - 1, len(self.lookup.known)
        text, place = self.lookup.pairs(data, offsets)
        out = np.zeros((n, len(self.links)))
        for k, w in enumerate(self.links):
            odds = np.bincount(text, w[:width][place], minlength=n) + out[:, :k] @ w[width:-1] + w[-1]
            out[:, k] = np.clip(odds, -LIMIT, LIMIT)
        return out

    def probabilities(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(column), len(self.links)))
        for a, b, data, offsets in text_slices(column):
            out[a:b] = 1 / (1 + np.exp(-self.log_odds(data, offsets)))
        return out


def _chain(rows: list[np.ndarray], targets: np.ndarray, width: int) -> list[np.ndarray]:
    n, n_links = targets.shape
    earlier, links = np.zeros((n, 0)), []
    fold = folds(n, FOLDS)
    row, place = _sparse(rows)
    for k in range(n_links):
        y = targets[:, k].astype(float)
        links.append(logistic(row, place, earlier, y, width))
        odds = np.zeros(n)
        for f in range(FOLDS):
            out = fold == f
            kept = ~out
            number = np.cumsum(kept) - 1
            inside = kept[row]
            w = logistic(number[row[inside]], place[inside], earlier[kept], y[kept], width)
            all_odds = np.bincount(row, w[:width][place], minlength=n) + earlier @ w[width:-1] + w[-1]
            odds[out] = all_odds[out]
        earlier = np.concatenate([earlier, np.clip(odds, -LIMIT, LIMIT)[:, None]], axis=1)
    return links


def _associated(n_toxic: np.ndarray, n_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Features that toxic rows have more often, by the likelihood-ratio statistic of a two-by-two table."""
    total = n_toxic + n_clean
    g = np.zeros(len(total))
    for observed, rows in ((n_toxic, toxic), (n_clean, clean), (toxic - n_toxic, toxic), (clean - n_clean, clean)):
        having = total if observed is n_toxic or observed is n_clean else toxic + clean - total
        expected = having * (rows / max(toxic + clean, 1))
        g += 2 * np.where(observed > 0, observed * np.log(np.maximum(observed, 1) / np.maximum(expected, 1e-12)), 0.0)
    more = n_toxic * clean > n_clean * toxic
    rank = np.argsort(-np.where(more, g, -1.0), kind="stable")[:SELECTED]
    return np.sort(rank[(more & (g >= LEAST_G))[rank]])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = LABEL,
    categories: dict[str, tuple[str, ...]] = CATEGORIES,
    limit: int = SAMPLE,
) -> ToxicityChain:
    """A chain over the categories, ``veiled`` and the label, from at most ``limit`` rows of each label.

    Labels other than 0 and 1 and rows without a doc_id are left out. Without toxic rows, or without
    others, all probabilities follow the share of the rows there are; without any row they are all low.
    """
    names = [*categories, VEILED, LABEL]
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IN (0, 1)")
    chosen = stored(bounded_sample(known, "doc_id", "label", limit), "toxicity-labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most two labels times the limit rows.
    sample = stored(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"), "toxicity-sample")

    def toxic_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, data, offsets in text_slices(batch.column(0)):
                text, kinds = tokens(data, offsets)
                for hashes in kinds:
                    order = np.lexsort((text, hashes))
                    h, t = hashes[order], text[order]
                    first = np.ones(len(h), dtype=bool)
                    first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
                    found.append(h[first])
            values, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["feature", "n"])

    counted = sample.filter("label = 1").select("text").mapInArrow(toxic_features, "feature long, n long")
    common = counted.groupBy("feature").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_ROWS)
    best = common.orderBy(F.desc("n"), "feature").limit(CANDIDATES).toArrow()
    features = best.column("feature").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(features)
    candidates, n_toxic = Lookup(features), best.column("n").to_numpy()[order]

    def clean_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(candidates.known), dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                total += np.bincount(candidates.pairs(data, offsets)[1], minlength=len(total))
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["place", "n"])

    counted = sample.filter("label = 0").select("text").mapInArrow(clean_counts, "place long, n long")
    found = counted.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    n_clean = np.zeros(len(features), dtype=np.int64)
    n_clean[found.column("place").to_numpy()] = found.column("n").to_numpy()
    rows_of = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    used = _associated(n_toxic, n_clean, rows_of.get(1, 0), rows_of.get(0, 0))
    lookup = Lookup(candidates.known[used])
    lists = [_word_hashes(words) for words in categories.values()]

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[bytes] = []
            flags = np.zeros(batch.num_rows, dtype=np.int32)
            for a, b, data, offsets in text_slices(batch.column(2)):
                text, place = lookup.pairs(data, offsets)
                bounds = np.searchsorted(text, np.arange(b - a + 1))
                rows += [place[x:y].astype("<i4").tobytes() for x, y in zip(bounds, bounds[1:], strict=False)]
                of, (words, *_) = tokens(data, offsets)
                for k, listed in enumerate(lists):
                    flags[a + np.unique(of[np.isin(words, listed)])] |= 1 << k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(flags), pa.array(rows, pa.binary())],
                names=["doc_id", "label", "flags", "places"],
            )

    found = sample.mapInArrow(described, "doc_id long, label int, flags int, places binary").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    y = found.column("label").to_numpy().astype(np.int64)
    flags = found.column("flags").to_numpy()
    rows = [np.frombuffer(x.as_py(), dtype="<i4").astype(np.int64) for x in found.column("places")]
    if not len(y):
        none = np.zeros(len(lookup.known))
        return ToxicityChain(names, lookup, [np.concatenate([none, np.zeros(k), [-LIMIT]]) for k in range(len(names))])
    targets = np.zeros((len(y), len(names)))
    for k in range(len(categories)):
        targets[:, k] = (y == 1) & (flags >> k & 1 == 1)
    targets[:, -2] = (y == 1) & (flags == 0)
    targets[:, -1] = y
    return ToxicityChain(names, lookup, _chain(rows, targets, len(lookup.known)))


def with_categories(docs: DataFrame, chain: ToxicityChain, prefix: str = "p_") -> DataFrame:
    """All rows and columns, and a probability of each category; a null text counts as empty."""
    text = fresh("text_to_score", docs.columns)
    names = [prefix + n for n in chain.names]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, T.DoubleType()) for name in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            found = chain.probabilities(batch.column(last))
            columns = {n: pa.array(np.ascontiguousarray(found[:, k])) for k, n in enumerate(names)}
            yield appended(batch.select(range(last)), **columns)

    return docs.withColumn(text, F.col("text").cast("string")).mapInArrow(run, schema)
