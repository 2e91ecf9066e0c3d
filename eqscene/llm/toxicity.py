"""Operator 10: toxicity by weak supervision.

Voters look at a whole text: lists of words, lists of word beginnings of several
lengths, and patterns. The lists are ``SEED_WORDS`` and what stands out in the labelled
documents that may be learnt from (a bounded sample, ``max_train_rows``): a word or
beginning whose documents are toxic far more often than documents are at large. Of these
the ``MAX_TERMS`` that occur in most toxic documents are listed: a model parameter, which
bounds what is sent to tasks and does not depend on the size of the corpus.

A generative model of the votes (no labels in it) is fitted by expectation
maximisation on all documents, counted by their row of votes: for
each voter the chances of its votes given the class, and, from the residuals, the correlations between voters; a
voter that says what others say counts for less. Its posteriors are the labels that a
linear classifier over the voters' counts is trained on, and that classifier scores
all documents.

Edge cases: null and empty texts get no hits and the score of a text without hits; with
no labels the seed words and patterns alone vote; repeated rows are scored alike; a null
doc_id is not held out; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eqscene.llm._common import staged, whole_text
from eqscene.llm._labelled import fold, labelled_sample

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
MAX_TRAIN_ROWS = 12_000
MAX_TERMS = 1_000
BEGINNINGS = (4, 5, 6, 7, 8)
#: How far from chance a listed term is, and the share of its documents that are toxic.
LEAST_Z, LEAST_SHARE = 7.0, 0.5
#: Common English insults (fixed values).
SEED_WORDS = (
    "bastard clown creep cretin dimwit disgusting dumb dumbass filth fool garbage idiot idiotic imbecile jerk "
    "loser lowlife moron moronic pathetic scum scumbag stupid trash vermin weirdo worthless"
).split()
_ADDRESS = re.compile(r"\b(?:you|they|he|she)(?:'re| are|'s| is)? (?:an? |such |so |all |just )*(\w+)")
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&-_"


def terms(text: str) -> set[str]:
    """The distinct words of a text, lower-cased, without marks at their ends."""
    return {w.strip(_EDGE) for w in set(text.lower().split())} - {""}


def keys_of(text: str) -> set[str]:
    """Words as ``=word`` and beginnings as ``n^begin``."""
    words = terms(text)
    return {f"={w}" for w in words} | {f"{n}^{w[:n]}" for n in BEGINNINGS for w in words if len(w) >= n}


@dataclass
class Lexicon:
    """One set of terms for each list voter: seeds, words, and beginnings by length."""

    seeds: frozenset
    words: frozenset
    begins: dict[int, frozenset]

    def counts(self, text: str) -> list[float]:
        """What each voter of VOTERS counts in a text."""
        words = terms(text)
        seeds = len(words & self.seeds)
        begun = [sum(w[:n] in known for w in words) for n, known in self.begins.items() if known]
        most = max([len(words & self.words), *begun], default=0)
        address = sum(w in self.seeds for w in _ADDRESS.findall(text.lower())) if seeds else 0
        listed = max(seeds, most)
        return [seeds, seeds, len(words & self.words), most, most, most, address, 100.0 * listed / max(len(words), 1), listed]


#: Each voter with the least count at which it votes toxic; the last votes clean at 0.
VOTERS = (
    ("a seed", 1),
    ("two seeds", 2),
    ("two listed words", 2),
    ("a listed term", 1),
    ("two listed terms", 2),
    ("three listed terms", 3),
    ("someone addressed", 1),
    ("one term in a hundred", 1),
    ("silence", np.inf),
)


def votes(counts: np.ndarray) -> np.ndarray:
    """1 toxic, -1 clean, 0 abstains."""
    out = (counts >= np.array([least for _, least in VOTERS])).astype(np.int8)
    out[:, -1] = np.where(counts[:, -1] > 0, 0, -1)
    return out


@dataclass
class LabelModel:
    """Chances of a vote given the class, the voters' correlations, and the class balance."""

    chances: np.ndarray  # class, voter, vote + 1
    correlations: np.ndarray
    balance: float

    def posterior(self, v: np.ndarray) -> np.ndarray:
        m = v.shape[1]
        shared = np.clip(self.correlations - np.eye(m), 0, None).sum(1)
        weight = 1 / (1 + shared)
        log = np.log(self.chances)
        odds = np.log(self.balance / (1 - self.balance)) + sum(
            weight[j] * (log[1, j, v[:, j] + 1] - log[0, j, v[:, j] + 1]) for j in range(m)
        )
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def label_model(v: np.ndarray, balance: float, rounds: int = 25, times: np.ndarray | None = None) -> LabelModel:
    """Expectation maximisation from the majority of votes; no labels. Row i stands for ``times[i]`` texts.

    Correlations are those of the residuals after the class is taken out, averaged
    over the classes.
    """
    m = v.shape[1]
    times = np.ones(len(v)) if times is None else times
    balance = float(np.clip(balance, 0.005, 0.5))
    p = np.where(v.sum(1) > 0, 0.95, 0.02) if len(v) else np.zeros(0)
    model = LabelModel(np.full((2, m, 3), 1 / 3), np.eye(m), balance)
    onehot = np.stack([v == -1, v == 0, v == 1], 2).astype(float)
    for _ in range(rounds if len(v) else 0):
        for c, w in ((0, times * (1 - p)), (1, times * p)):
            model.chances[c] = (np.einsum("i,ijk->jk", w, onehot) + 0.1) / (w.sum() + 0.3)
        total = np.zeros((m, m))
        for c, w in ((0, times * (1 - p)), (1, times * p)):
            centred = (v - (model.chances[c] * np.array([-1, 0, 1])).sum(1)) * np.sqrt(w)[:, None]
            cov = centred.T @ centred / max(w.sum(), 1e-9)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            total += cov / sd[:, None] / sd
        model.correlations = total / 2
        model.balance = float(np.clip(np.average(p, weights=times), 0.005, 0.5))
        p = model.posterior(v)
    return model


@dataclass
class Linear:
    lexicon: Lexicon
    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = design(np.array([self.lexicon.counts(t) for t in texts], float))
        return 1 / (1 + np.exp(-np.clip(x @ self.weight + self.bias, -30, 30)))


def design(counts: np.ndarray) -> np.ndarray:
    """For each voter whether it votes toxic or clean, and the logarithm of its count."""
    return np.concatenate([votes(counts).astype(float), np.log1p(counts)], 1)


def newton_sums(a: np.ndarray, p: np.ndarray, times: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The slope and curvature of the logistic loss at ``w``, summed over the rows, in one flat array."""
    q = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
    return np.concatenate([a.T @ (times * (q - p)), ((a * (times * q * (1 - q))[:, None]).T @ a).ravel()])


def fit_linear(sums: Callable[[np.ndarray], np.ndarray], width: int, n: float, ridge: float = 1e-3, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Logistic regression on posteriors of ``n`` rows by Newton's method with backtracking to small steps."""
    w = np.zeros(width + 1)
    penalty = np.full(len(w), ridge * max(n, 1))
    penalty[-1] = 1e-6
    for _ in range(rounds if n else 0):
        found = sums(w)
        grad = found[: len(w)] + penalty * w
        hess = found[len(w) :].reshape(len(w), len(w)) + np.diag(penalty + 1e-6)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-10:
            break
    return w[:-1], float(w[-1])


def mine(docs: DataFrame, labels: DataFrame, max_train_rows: int) -> tuple[Lexicon, float]:
    """The lists, and the share of toxic documents among the labelled ones learnt from."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True):
                keys = list(keys_of(text)) + ["*"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array([label] * len(keys), pa.int32())], names=["key", "label"]
                )

    sample = labelled_sample(docs, labels, "toxic", fold("doc_id", FOLDS) != HELD_OUT, max_train_rows)
    counted = (
        sample.mapInArrow(keyed, "key string, label int")
        .groupBy("key")
        .agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
    )
    base = counted.filter(F.col("key") == "*").first()
    rate = base["toxic"] / base["n"] if base else 0.0
    found = []
    if 0 < rate < 1:
        z = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
        found = (
            counted.filter(F.col("key") != "*")
            .filter((z >= LEAST_Z) & (F.col("toxic") >= LEAST_SHARE * F.col("n")))
            .orderBy(F.desc("toxic"), "key")
            .limit(MAX_TERMS)
            .collect()
        )
    keys = [r["key"] for r in found]
    begins = {n: frozenset(k[2:] for k in keys if k.startswith(f"{n}^")) for n in BEGINNINGS}
    return Lexicon(frozenset(SEED_WORDS), frozenset(k[1:] for k in keys if k[0] == "="), begins), rate


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> Linear:
    """Lists from labels, a label model of unlabelled votes, a classifier on its posteriors.

    Spark counts all documents by their row of counts. The label model needs only the
    rows of votes, few whatever the size of the corpus; each Newton step is summed over
    the rows of counts where they lie.
    """
    lexicon, rate = mine(docs, labels, max_train_rows)
    m = len(VOTERS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = np.array([lexicon.counts(t) for t in b.column("text").to_pylist()], float).reshape(b.num_rows, m)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.list_(pa.float64())), pa.array(list(votes(counts)), pa.list_(pa.int8()))],
                names=["counts", "votes"],
            )

    rows = staged(
        docs.select(whole_text().alias("text"))
        .mapInArrow(counted, "counts array<double>, votes array<tinyint>")
        .groupBy("counts", "votes")
        .agg(F.count("*").alias("times")),
        "counts",
    )
    patterns = rows.groupBy("votes").agg(F.sum("times").alias("times")).orderBy("votes").collect()
    if not patterns:
        return Linear(lexicon, np.zeros(2 * m), -3.0)
    times = np.array([r["times"] for r in patterns], float)
    v = np.array([r["votes"] for r in patterns], np.int8)
    model = label_model(v, rate or 0.05, times=times)

    def sums(w: np.ndarray) -> np.ndarray:
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = design(np.array(b.column("counts").to_pylist(), float))
                    p = model.posterior(np.array(b.column("votes").to_pylist(), np.int8))
                    a = np.concatenate([x, np.ones((len(x), 1))], 1)
                    part = newton_sums(a, p, b.column("times").to_numpy().astype(float), w)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(part))), pa.array(part)], names=["at", "part"])

        parts = rows.mapInArrow(summed, "at long, part double").groupBy("at").agg(F.sum("part").alias("part")).orderBy("at").collect()
        return np.array([r["part"] for r in parts])

    weight, bias = fit_linear(sums, 2 * m, times.sum())
    return Linear(lexicon, weight, bias)


def toxicity_score(model: Linear) -> Column:
    """The score of column ``text``."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()), dtype="float64")

    return score(whole_text())


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = train(docs, labels, max_train_rows)
    return docs.select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), toxicity_score(model).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
