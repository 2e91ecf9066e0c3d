"""Operator 4: a quality classifier of histogram gradient-boosted trees.

Tasks turn whole texts into ``FEATURES`` (document statistics, no words of the texts),
a bounded sample of labelled documents (``max_train_rows``) is fitted in numpy, and
the trees, complete ones of depth ``DEPTH`` laid out in flat arrays, are walked for all
rows and all trees of a batch at once.

Edge cases: null and empty texts have all statistics 0 and a score like any other; with
no labels the score is 0.5, with one class only it is near that class; repeated rows are
scored alike; a null doc_id counts as held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eqscene.llm._common import whole_text
from eqscene.llm._labelled import fold, labelled_sample
from eqscene.llm._shingles import byte_chunks, chunks, word_hashes

FOLDS = 5
THRESHOLD = 0.3
MAX_TRAIN_ROWS = 20_000
DEPTH, TREES, RATE, BINS, RIDGE, LEAST = 4, 60, 0.2, 64, 1.0, 2.0
_CLASSES = ("lower", "upper", "digit", "space", "newline", "mark", "bar", "symbol", "beyond")
FEATURES = (
    *(f"{c}_share" for c in _CLASSES),
    "log_bytes",
    "log_words",
    "word_bytes",
    "words_a_line",
    "unlike_words",
    "top_word",
    "same_as_before",
    "unlike_pairs",
    "unlike_lines",
    "longest_word",
)


def _byte_classes() -> np.ndarray:
    of = np.full(256, _CLASSES.index("symbol"), np.uint8)
    for name, chars in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("digit", "0123456789"), ("space", " \t\r"), ("newline", "\n"), ("mark", ".,;:!?'\"()-"), ("bar", "|")):
        of[list(chars.encode())] = _CLASSES.index(name)
    of[65:91] = _CLASSES.index("upper")
    of[128:] = _CLASSES.index("beyond")
    return of


_CLASS_OF = _byte_classes()


def _unlike(x: np.ndarray) -> float:
    return len(np.unique(x)) / len(x) if len(x) else 0.0


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    k = len(_CLASSES)
    for i, j in chunks(texts):
        size = np.array([len(t) for t in texts[i:j]])
        raw = np.frombuffer(b"".join(texts[i:j]), np.uint8)
        row = np.repeat(np.arange(j - i), size)
        counts = np.bincount(row * k + _CLASS_OF[raw], minlength=(j - i) * k).reshape(-1, k)
        hashes, n = word_hashes(texts[i:j])
        end = np.cumsum(n)
        out[i:j, :k] = counts / np.maximum(size, 1)[:, None]
        out[i:j, k] = np.log1p(size)
        out[i:j, k + 1] = np.log1p(n)
        out[i:j, k + 2] = (size - counts[:, 3] - counts[:, 4]) / np.maximum(n, 1)
        out[i:j, k + 3] = n / (counts[:, 4] + 1)
        for at in range(j - i):
            if not n[at]:
                continue
            w = hashes[end[at] - n[at] : end[at]]
            _, often = np.unique(w, return_counts=True)
            lines = texts[i + at].split(b"\n")
            out[i + at, k + 4 :] = (
                len(often) / len(w),
                often.max() / len(w),
                (w[1:] == w[:-1]).mean() if len(w) > 1 else 0.0,
                _unlike(w[1:] * np.uint64(3) + w[:-1]),
                len(set(lines)) / len(lines),
                max(map(len, texts[i + at].split())),
            )
    return out


def statistics_of(column: pa.Array) -> np.ndarray:
    """The same of a column of texts."""
    return np.concatenate([np.zeros((0, len(FEATURES))), *(statistics(texts) for _, _, texts in byte_chunks(column))])


@dataclass
class Forest:
    """Complete trees in flat arrays: split of node s of tree t, and value of its leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.leaf))
        total = np.full(len(x), self.prior)
        if len(trees):
            node = np.zeros((len(x), len(trees)), np.int64)
            row = np.arange(len(x))[:, None]
            for _ in range(DEPTH):
                right = x[row, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            total = total + self.leaf[trees, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees on the logistic loss over quantile histograms."""
    none = Forest(np.zeros((0, 2**DEPTH - 1), int), np.zeros((0, 2**DEPTH - 1)), np.zeros((0, 2**DEPTH)), 0.0)
    if not len(y):
        return none
    none.prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    if y.min() == y.max():
        return none
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    margin = np.full(n, none.prior)
    splits, limits, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)  # within its level
        split, limit = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, np.inf)
        for level in range(DEPTH):
            cells = (node[:, None] * width + np.arange(width)) * BINS + binned
            shape = (2**level, width, BINS)
            g = np.bincount(cells.ravel(), np.repeat(gradient, width), np.prod(shape)).reshape(shape).cumsum(2)
            h = np.bincount(cells.ravel(), np.repeat(hessian, width), np.prod(shape)).reshape(shape).cumsum(2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
            gain[(h < LEAST) | (h_all - h < LEAST)] = 0
            best = gain.reshape(2**level, -1).argmax(1)
            f, b = best // BINS, best % BINS
            use = gain.reshape(2**level, -1).max(1) > 1e-9
            base = 2**level - 1
            for s in np.flatnonzero(use):
                split[base + s] = f[s]
                limit[base + s] = cuts[f[s]][b[s]] if b[s] < len(cuts[f[s]]) else np.inf
            node = 2 * node + (use[node] & (binned[np.arange(n), f[node]] > b[node]))
        g = np.bincount(node, gradient, 2**DEPTH)
        h = np.bincount(node, hessian, 2**DEPTH)
        leaf = RATE * g / (h + RIDGE)
        margin = margin + leaf[node]
        splits.append(split)
        limits.append(limit)
        leaves.append(leaf)
    return Forest(np.array(splits), np.array(limits), np.array(leaves), none.prior)


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> Forest:
    """Fit on at most ``max_train_rows`` documents of the folds that may be learnt from."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics_of(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.string()), b.column("label"), pa.array(list(x), pa.list_(pa.float64()))],
                names=["doc_id", "label", "x"],
            )

    sample = labelled_sample(docs, labels, "quality", fold("doc_id", FOLDS) != 0, max_train_rows)
    rows = sample.mapInArrow(features, "doc_id string, label int, x array<double>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist()).reshape(len(rows), len(FEATURES))
    return fit(x, rows["label"].to_numpy(float))


def quality_score(forest: Forest) -> Column:
    """The score of column ``text``."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(forest.scores(statistics_of(texts)))

    return score(whole_text())


def score_quality(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    forest = train(docs, labels, max_train_rows)
    return docs.select(
        "doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), quality_score(forest).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    return docs.filter(quality_score(train(docs, labels, max_train_rows)) >= THRESHOLD)
