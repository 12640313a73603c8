"""Document quality by histogram gradient-boosted trees over document statistics.

A text becomes some thirty statistics of its whole and of its worst stretch of
words.  Values are cut into bins at quantiles; a tree is grown level by level
from histograms of gradients per bin, and all trees are complete, so they are
flattened into arrays (feature, cut, leaf value) that many documents walk
through side by side, one array operation per level.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starload.llm.common import fold, held_out, labelled_sample, shared

#: The bound of the sample that the trees are fitted with.
EXAMPLES = 20_000
BINS = 48
DEPTH = 4
TREES = 70
RATE = 0.15
SHRINK = 1.0
LEAST_WEIGHT = 1.0
STRETCH = 60
THRESHOLD = 0.3
RESULT = "score double, predicted int"
SYMBOLS = re.compile(r"[#*$%&|<>@^~_=+{}\[\]\\/]")
DIGITS = re.compile(r"\d")
STOPS = re.compile(r"[.!?]")
OTHER_MARKS = re.compile(r"[,;:'\"()-]")
FEATURES = ("words", "characters per word", "distinct words", "upper-case letters", "upper-case words", "symbols",
            "exclamations", "digits", "sentence ends", "other marks", "repeated neighbours", "most frequent word",
            "distinct lines", "lines", "distinct pairs", "words ending in repeated marks", "letters", "short words",
            "long words", "longest word", "characters per line", "beyond ASCII", "worst distinct words",
            "worst upper-case words", "worst symbols", "worst repeated neighbours", "best distinct words")


def statistics_of(text: str | None) -> list[float]:
    """The FEATURES of a text; all 0 for one that is NULL or has no words."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    lines = [line for line in text.split("\n") if line.strip()]
    counts, lengths = Counter(words), np.fromiter(map(len, words), dtype=np.int64)
    upper = [len(w) > 1 and w.isupper() for w in words]
    same = [a == b for a, b in zip(words, words[1:])]
    n_symbols = len(SYMBOLS.findall(text))
    symbols = [1 if SYMBOLS.search(w) else 0 for w in words] if n_symbols else [0] * n
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text)))
    upper_letters = len(text) - len(re.sub(r"[A-ZÀ-ÖØ-Þ]", "", text))
    starts = range(0, max(1, n - STRETCH // 2), STRETCH)
    # A rest too short for a stretch of its own belongs to the last one.
    stretch = [(b - a, a, b) for a, b in zip(starts, [*starts[1:], n])]
    distinct = [len(set(words[a:b])) / k for k, a, b in stretch]
    return [
        np.log1p(n), float(lengths.mean()), len(counts) / n, upper_letters / max(1, letters), sum(upper) / n,
        n_symbols / size, text.count("!") / size, len(DIGITS.findall(text)) / size,
        len(STOPS.findall(text)) / n, len(OTHER_MARKS.findall(text)) / n, sum(same) / n, max(counts.values()) / n,
        len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), len(set(zip(words, words[1:]))) / max(1, n - 1),
        sum(1 for w in counts if w[-1] == w[-2:-1] and not w[-1].isalnum()) / len(counts), letters / size,
        float((lengths <= 3).mean()), float((lengths > 12).mean()),
        np.log1p(lengths.max()), np.log1p(size / max(1, len(lines))),
        1 - len(text.encode("ascii", "ignore")) / size,
        min(distinct), max(sum(upper[a:b]) / k for k, a, b in stretch), max(sum(symbols[a:b]) / k for k, a, b in stretch),
        max(sum(same[a:b]) / k for k, a, b in stretch), max(distinct)]


@dataclass
class Trees:
    """All trees as arrays: node i has its children at 2 i + 1 and 2 i + 2; nodes that do not split send all left."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # trees x inner nodes
    leaf: np.ndarray  # trees x leaves

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        every = np.arange(trees)[None, :]
        at = np.zeros((len(rows), trees), np.int64)
        for _ in range(int(np.log2(inner + 1))):
            right = np.take_along_axis(rows, self.feature[every, at], axis=1) > self.cut[every, at]
            at = 2 * at + 1 + right
        total = self.start + self.leaf[every, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boosted trees for the log loss of 0/1 labels."""
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    n, width = rows.shape
    rate = (labels.sum() + 1) / (n + 2)
    start = float(np.log(rate / (1 - rate)))
    if not n:
        return Trees(start, np.zeros((1, inner), np.int64), np.full((1, inner), np.inf), np.zeros((1, leaves)))
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(cuts[f], rows[:, f], "left") for f in range(width)], axis=1)
    total = np.full(n, start)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-total))
        slope, bend = chance - labels, chance * (1 - chance)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, number = (1 << level) - 1, 1 << level
            place = node - first
            best_gain, best = np.full(number, 1e-6), np.full((number, 2), -1)
            for f in range(width):
                if not len(cuts[f]):
                    continue
                cell = place * BINS + bins[:, f]
                g = np.bincount(cell, slope, number * BINS).reshape(number, BINS).cumsum(axis=1)
                h = np.bincount(cell, bend, number * BINS).reshape(number, BINS).cumsum(axis=1)
                left_g, left_h, all_g, all_h = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = (left_g ** 2 / (left_h + SHRINK) + (all_g - left_g) ** 2 / (all_h - left_h + SHRINK)
                        - all_g ** 2 / (all_h + SHRINK))
                gain[(left_h < LEAST_WEIGHT) | (all_h - left_h < LEAST_WEIGHT)] = -np.inf
                gain[:, len(cuts[f]):] = -np.inf
                at = gain.argmax(axis=1)
                better = gain[np.arange(number), at] > best_gain
                best_gain[better] = gain[np.arange(number), at][better]
                best[better] = np.stack([np.full(number, f), at], axis=1)[better]
            for i in np.flatnonzero(best[:, 0] >= 0):
                feature[first + i], cut[first + i] = best[i, 0], cuts[best[i, 0]][best[i, 1]]
            node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + SHRINK)
        total = total + value[leaf]
        features.append(feature)
        thresholds.append(cut)
        values.append(value)
    return Trees(start, np.stack(features), np.stack(thresholds), np.stack(values))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, bound: int = EXAMPLES) -> Trees:
    """Trees for a bounded sample of labelled documents; its statistics are made in tasks."""
    @F.pandas_udf("array<double>")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics_of(t) for t in texts])

    sample = labelled_sample(docs, labels, "quality", usable, bound)
    rows = sample.select("doc_id", "label", measure(F.col("text")).alias("s")).toPandas().sort_values(
        "doc_id", kind="stable")
    features = np.array(rows["s"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    return grow(features, (rows["label"].to_numpy() > 0).astype(float))


def score(text: Column, trees: Trees, spark: SparkSession) -> Column:
    unpack = shared(spark, trees)

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = unpack()
        for texts in batches:
            rows = np.array([statistics_of(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
            found = known.probabilities(rows)
            yield pd.DataFrame({"score": found, "predicted": (found >= THRESHOLD).astype(np.int32)})
    return judge(text)


def judged(docs: DataFrame, labels: DataFrame, folds: int = 5, remainder: int = 0) -> DataFrame:
    """doc_id, held_out, score (of quality 1) and predicted for every row of docs (doc_id, text and any others).

    Labels are learnt from rows whose fold is not the held-out one; a row without
    doc_id has none and is not held out.  A NULL text or one without words has the
    statistics 0 and is scored like others; without labels every score is one half.
    Repeated rows have equal results.  An empty table gives an empty one.
    """
    trees = fit(docs, labels, fold("doc_id", folds) != remainder)
    result = docs.select("doc_id", held_out("doc_id", folds, remainder).alias("held_out"),
                         score(F.col("text"), trees, docs.sparkSession).alias("s"))
    return result.select("doc_id", "held_out", "s.*")
