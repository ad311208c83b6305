"""Quality rules: fixed limits on document statistics, then gradient-boosted trees over them.

Every whole text gives a row of statistics (``COUNTS`` and the features made of them). The trees are fitted in numpy on
at most ``MAX_LABELLED`` labelled texts, the first in the order of a hash of doc_id: logistic loss, second-order steps,
histogram splits of ``BINS`` bins, trees of ``DEPTH`` levels. For the features in ``FALLING`` the score never rises
with the feature: a split that would raise it is not taken, and each side of such a split keeps to its own
side of the middle between the two values.

A fitted model is three arrays, one row to a tree: the feature and the threshold of each inner node, and the value of each
leaf, nodes in heap order. A batch walks all trees level by level as array look-ups, without a loop over texts.

A text fails the base rules with fewer than ``LEAST_WORDS`` words, or where words in repeated five-word windows are over
``MOST_REPEATED`` percent. Words are runs without ASCII white space, compared as they stand. Null text is empty and
fails. Rows that repeat a doc_id give a row each; a row without doc_id keeps its null. Labels that are null, that have no
document, or that contradict each other are left out; without both kinds of label the trees keep every text. Empty tables
give no rows. Columns of other names are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmill.llm.common import id_and_text, marked_ids, unmarked_ids

#: The bound on the labelled rows that the driver holds for fitting.
MAX_LABELLED = 20_000
#: The base rules.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
BINS, DEPTH, TREES, RATE, SHRINK, LEAST_WEIGHT = 64, 4, 120, 0.1, 1.0, 1.0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "words",
    "word_length",
    "symbols_a_word",
    "repeated_lines",
    "repeated_words",
    "distinct_words",
    "upper_case",
    "digits",
    "marks_a_word",
    "wordless",
    "words_a_line",
    "longest_word",
    "other_bytes",
]
FALLING = ("symbols_a_word", "repeated_lines", "repeated_words", "marks_a_word")


def _bytes_in(values) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(values)] = True
    return found


_SPACE = _bytes_in([0x20, *range(0x09, 0x0E)])
_SYMBOL = _bytes_in(b"#*$%&|<>")
_UPPER, _DIGIT = _bytes_in(range(0x41, 0x5B)), _bytes_in(range(0x30, 0x3A))
_LETTER = _bytes_in([*range(0x41, 0x5B), *range(0x61, 0x7B)])
_MARK = _bytes_in([b for b in range(0x21, 0x7F) if not _LETTER[b] and not _DIGIT[b]])
# A bit for each class of bytes, and none for bytes that continue a character.
_CLASSES = sum(t.astype(np.uint8) << n for n, t in enumerate((_SPACE, _SYMBOL, _UPPER, _DIGIT, _LETTER, _MARK)))
_FIRST = (np.arange(256) & 0xC0) != 0x80


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that stand in a window of ``size`` words which the text holds twice or more."""
    if len(words) <= size:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    count = len(words) - size + 1
    code, bound = ids[:count], len(numbers)
    for place in range(1, size):
        if bound * len(numbers) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            bound = count
        code = code * len(numbers) + ids[place : place + count]
        bound *= len(numbers)
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def statistics(data: bytes) -> tuple[list[int], list[float]]:
    """The counts of a text and the features of the trees."""
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    per_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)

    def count(which: np.ndarray) -> int:
        return int(per_byte[which].sum())

    n = len(words)
    characters = count(_FIRST & ~_SPACE)
    symbols, again = count(_SYMBOL), len(lines) - len(set(lines))
    repeats = repeated_words(words)
    a, b, c = max(n, 1), max(len(lines), 1), max(characters, 1)
    counts = [n, characters, symbols, again, repeats]
    letters = count(_LETTER)
    wordless = sum(1 for w in words if len(w) == 1 and _MARK[w[0]])
    features = [
        np.log1p(n),
        characters / a,
        symbols / a,
        again / b,
        repeats / a,
        len(set(words)) / a,
        count(_UPPER) / max(letters, 1),
        count(_DIGIT) / c,
        count(_MARK) / a,
        wordless / a,
        n / b,
        np.log1p(max(map(len, words), default=0)),
        count(~_FIRST) / c,
    ]
    return counts, features


@dataclass
class Trees:
    """``feature`` and ``threshold`` of inner nodes and ``value`` of leaves, a row to a tree, in heap order."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, features: np.ndarray) -> np.ndarray:
        """The probability of good quality for each row of features."""
        total = np.full(len(features), self.base)
        if len(self.value):
            every, tree = np.arange(len(features))[:, None], np.arange(len(self.value))[None, :]
            node = np.zeros((len(features), len(self.value)), np.int64)
            for _ in range(int(np.log2(self.value.shape[1]))):
                right = features[every, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            total += self.value[tree, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between the bins: middles between neighbouring values at even shares of the rows."""
    values = np.sort(column)
    cuts = np.unique(values[np.linspace(0, len(values) - 1, bins + 1).astype(int)])
    return (cuts[:-1] + cuts[1:]) / 2


def fit(features: np.ndarray, good: np.ndarray, falling: tuple[int, ...] = (), trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the labels; the score never rises with the features in ``falling``."""
    rows, width = features.shape
    share = float(np.clip(good.mean() if rows else 0.5, 1e-6, 1 - 1e-6))
    inner, leaves = (1 << depth) - 1, 1 << depth
    base = float(np.log(share / (1 - share)))
    if not rows or good.min() == good.max():
        # Nothing to tell apart: all texts are kept.
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), abs(base))
    edges = [_edges(features[:, j], BINS) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], features[:, j], "left") for j in range(width)], axis=1)
    total, out = np.full(rows, base), ([], [], [])
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, weight = good - chance, chance * (1 - chance)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        node = np.zeros(rows, int)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            # Sums by node, feature and bin, then over the bins up to each cut.
            at = ((node - first)[:, None] * width + np.arange(width)) * (BINS + 1) + binned
            shape = (count, width, BINS + 1)
            size = count * width * (BINS + 1)
            g = np.bincount(at.ravel(), np.repeat(slope, width), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(at.ravel(), np.repeat(weight, width), size).reshape(shape).cumsum(axis=2)
            whole_g, whole_h = g[:, :, -1:], h[:, :, -1:]
            lows, highs = (x[first : first + count, None, None] for x in (low, high))
            left = np.clip(g / (h + SHRINK), lows, highs)
            right = np.clip((whole_g - g) / (whole_h - h + SHRINK), lows, highs)
            alone = np.clip(whole_g / (whole_h + SHRINK), lows, highs)

            def gained(value, slopes, weights):
                return slopes * value - (weights + SHRINK) * value**2 / 2

            gain = gained(left, g, h) + gained(right, whole_g - g, whole_h - h) - gained(alone, whole_g, whole_h)
            unfit = (h < LEAST_WEIGHT) | (whole_h - h < LEAST_WEIGHT)
            for j in falling:
                unfit[:, j] |= right[:, j] > left[:, j]
            for j in range(width):
                unfit[:, j, len(edges[j]) :] = True
            gain[unfit] = 0.0
            flat = gain.reshape(count, -1)
            best = flat.argmax(axis=1)
            taken = flat[np.arange(count), best] > 1e-9
            j, cut = np.divmod(best, BINS + 1)
            for n in range(count):
                here = first + n
                for child in (2 * here + 1, 2 * here + 2):
                    low[child], high[child] = low[here], high[here]
                if not taken[n]:
                    continue
                feature[here], threshold[here] = j[n], edges[j[n]][cut[n]]
                if j[n] in falling:
                    middle = (left[n, j[n], cut[n]] + right[n, j[n], cut[n]]) / 2
                    low[2 * here + 1], high[2 * here + 2] = middle, middle
            goes = features[np.arange(rows), feature[node]] > threshold[node]
            node = 2 * node + 1 + goes
        leaf = node - inner
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, weight, leaves)
        value = RATE * np.clip(g / (h + SHRINK), low[inner:], high[inner:])
        total += value[leaf]
        for parts, part in zip(out, (feature, threshold, value), strict=True):
            parts.append(part)
    return Trees(*(np.stack(x) for x in out), base)


def with_statistics(texts: DataFrame, trees: Trees | None = None) -> DataFrame:
    """doc_id, the counts, and the features or, given trees, the ``score``."""
    shared = texts.sparkSession.sparkContext.broadcast(trees)
    tail = "features array<double>" if trees is None else "score double"
    schema = "doc_id long, " + "".join(f"{name} long, " for name in COUNTS) + tail

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [statistics(bytes(data)) for data in frame["text"]]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            features = np.array([f for _, f in found], float).reshape(-1, len(FEATURES))
            out = pd.DataFrame(counts, columns=COUNTS)
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            if shared.value is None:
                out["features"] = list(features)
            else:
                out["score"] = shared.value.score(features)
            yield out

    return texts.select("doc_id", F.col("text").cast("binary").alias("text")).mapInPandas(run, schema)


def train(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, most: int = MAX_LABELLED) -> Trees:
    """Fit on at most ``most`` labelled documents for which ``held_out`` (over doc_id) is not true."""
    texts = id_and_text(docs)
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    marks = marks.where("doc_id is not null and quality is not null")
    if held_out is not None:
        marks = marks.where(~held_out)
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("highest"))
    marks = marks.where("quality = highest").select("doc_id", "quality")
    picked = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # Copied to the driver, at most ``most`` rows, so that the labels are picked once.
    known = {row["doc_id"]: row["quality"] for row in picked.collect()}
    ids = docs.sparkSession.createDataFrame([(n,) for n in known], "doc_id long")
    found = with_statistics(texts.join(F.broadcast(ids), "doc_id", "left_semi")).select("doc_id", "features").toPandas()
    # One row for a doc_id: the rows of one are in an order of their own.
    found["features"] = found["features"].map(tuple)
    found = found.sort_values(["doc_id", "features"]).drop_duplicates("doc_id")
    features = np.array(found["features"].tolist(), float).reshape(-1, len(FEATURES))
    good = np.array([known[n] for n in found["doc_id"]], float)
    return fit(features, good, tuple(FEATURES.index(name) for name in FALLING))


def judge(docs: DataFrame, trees: Trees, least: float = 0.5) -> DataFrame:
    """Counts, ``score``, ``base_failed`` and ``kept`` of every document."""
    found = unmarked_ids(with_statistics(marked_ids(id_and_text(docs)), trees))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    kept = ~F.col("base_failed") & (F.col("score") >= least)
    return found.withColumn("base_failed", failed).withColumn("kept", kept)
