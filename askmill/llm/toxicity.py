"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives. A sample of all training texts, marked or not, is the
unlabelled set: it holds toxic texts by their natural share. With the class prior p (the share of positives among labelled
rows) the risk of a linear classifier is

    p * R(positive as 1)  +  max(0, R(unlabelled as 0) - p * R(positive as 0)),

and where the bracket falls below 0 the step goes up its gradient, which keeps a flexible model from
driving it negative. The loss is logistic, so scores are estimates of the class probability.

Features are the distinct words of a text (runs of letters, lower-cased) and the beginnings of longer
words, since abuse is inflected and compounded. The model is fitted on
the driver in numpy from a bounded sample, the first ``MAX_POSITIVE`` and ``MAX_UNLABELLED``
training rows in the order of a hash of doc_id, and at most ``MAX_WORDS`` telling words of theirs;
scoring reads every text whole, in Arrow batches, with the weights as a broadcast of bounded size.

Null text is empty and, like a text of unknown words, gets the score of the bias. Labels without a
document, and null labels, are left out. Without positives the model is the prior (0 if unknown).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmill.llm.common import id_and_text

MAX_POSITIVE, MAX_UNLABELLED, MAX_WORDS = 2_000, 6_000, 100_000
STEMS = (4, 5, 6, 7, 8)
#: Features in fewer training texts than this, or as common in both samples, have no weight of their own.
LEAST_TEXTS, LEAST_Z = 3, 3.3

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """The words, and their beginnings marked with a hyphen."""
    found = set(words)
    for n in STEMS:
        found.update([w[:n] + "-" for w in words if len(w) > n])
    return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    prior: float

    def score(self, text: str) -> float:
        weights = self.weights
        total = self.bias + sum(weights[w] for w in sorted(features_of(words_of(text)) & weights.keys()))
        return float(1 / (1 + np.exp(-total)))


class Sparse:
    """Rows of word indices; products with a weight vector, and their transpose."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.width, self.count = width, len(rows)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.word = np.concatenate(rows) if rows else np.zeros(0, int)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.word], self.count)

    def back(self, each: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, each[self.row], self.width)


def fit_nnpu(positive: Sparse, unlabelled: Sparse, prior: float, steps: int = 1000, rate: float = 0.05, decay: float = 1e-4):
    """Full-batch Adam on the non-negative risk; weights with the bias apart."""
    width = positive.width
    state, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    state[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    for step in range(1, steps + 1):
        at_p = positive.times(state[:-1]) + state[-1]
        at_u = unlabelled.times(state[:-1]) + state[-1]
        as_zero_p, as_zero_u = np.logaddexp(0, at_p).mean(), np.logaddexp(0, at_u).mean()
        up = sigmoid(at_u) / unlabelled.count
        down = -prior * sigmoid(at_p) / positive.count
        if as_zero_u - prior * as_zero_p >= 0:
            each_p, each_u = prior * (sigmoid(at_p) - 1) / positive.count + down, up
        else:
            each_p, each_u = -down, -up
        slope = np.append(positive.back(each_p) + unlabelled.back(each_u) + decay * state[:-1], each_p.sum() + each_u.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        state = state - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    # The mean score of all texts is the prior: correction steps on a small sample shift the bias.
    at_u, low, high = unlabelled.times(state[:-1]), -60.0, 60.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if sigmoid(at_u + middle).mean() < prior else (low, middle)
    return state[:-1], (low + high) / 2


def telling(positives: list[set[str]], others: list[set[str]]) -> list[str]:
    """Features more common among the positives than chance explains, by a two-sample z score.

    One that a few training texts happen to share would only let the model learn these by heart.
    """
    in_p = Counter(f for x in positives for f in features_of(x))
    in_p = {f: n for f, n in in_p.items() if n >= LEAST_TEXTS}
    in_u = Counter(f for x in others for f in features_of(x) & in_p.keys())
    n_p, n_u = len(positives), len(others)
    scores = {}
    for f, n in in_p.items():
        share = (n + in_u[f] + 1) / (n_p + n_u + 2)
        scores[f] = (n / n_p - in_u[f] / n_u) / np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    kept = sorted((-z, f) for f, z in scores.items() if z >= LEAST_Z)
    return [f for _, f in kept[:MAX_WORDS]]


def _sample_words(texts: DataFrame, ids: DataFrame, most: int) -> pd.DataFrame:
    """The words of at most ``most`` of these documents, picked by a hash of the id."""
    picked = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "words": ["\n".join(sorted(words_of(t))) for t in frame["text"]]})

    found = texts.join(F.broadcast(picked), "doc_id", "left_semi").mapInPandas(cut, "doc_id long, words string")
    # Copies of a text would count its words many times over.
    return found.toPandas().sort_values(["doc_id", "words"]).drop_duplicates("words")


def train(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column | None = None,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """Fit on documents for which ``held_out`` (over doc_id) is not true."""
    texts = id_and_text(docs)
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    marks = marks.where("doc_id is not null and toxic is not null")
    ids = texts.select("doc_id").where("doc_id is not null")
    if held_out is not None:
        marks, ids = marks.where(~held_out), ids.where(~held_out)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = marks.agg(F.avg(F.col("toxic").cast("double"))).head()[0] or 0.0
    toxic = marks.where("toxic = 1").select("doc_id")
    found = _sample_words(texts, toxic, max_positive)
    rest = _sample_words(texts, ids, max_unlabelled)
    if found.empty or rest.empty or not 0 < prior < 1:
        prior = min(max(prior, 1e-6), 1 - 1e-6)
        return Model({}, float(np.log(prior / (1 - prior))), prior)
    positives = [set(x.split("\n")) if x else set() for x in found["words"]]
    others = [set(x.split("\n")) if x else set() for x in rest["words"]]
    kept = telling(positives, others)
    index = {w: i for i, w in enumerate(kept)}

    def sparse(rows):
        return Sparse([np.array(sorted(index[f] for f in features_of(x) & index.keys()), dtype=int) for x in rows], len(kept))

    weights, bias = fit_nnpu(sparse(positives), sparse(others), prior)
    return Model({w: float(x) for w, x in zip(kept, weights, strict=True) if abs(x) > 1e-3}, bias, prior)


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Add the score of every whole text; the rows and their other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = shared.value.score
        for batch in texts:
            yield pd.Series([score(t or "") for t in batch], dtype="float64")

    return docs.withColumn(name, scored(docs[text]))
