"""Toxicity by the nearest labelled examples in TF-IDF space.

Examples are a bounded sample of labelled documents.  The vocabulary is every
term of theirs: words, and dense word beginnings of 4 and 5 letters, by a 64-bit hash.  Documents
and examples are vectors of (1 + log tf) * idf over all of it, of length 1; a term
whose presence raises the rate of label 1 weighs more, by the root of its
likelihood ratio, and none weighs less.

The examples are an inverted index, made in tasks: terms are dealt into buckets, and
each bucket is weighed, sorted and packed on its own.  The driver passes the packed
buckets on and opens none.  The examples lie in blocks.  For the terms that most examples have, the
index knows the largest value of every block.  A document's rarer terms are summed
over their postings; with what the common terms can add at most, that bounds
every block, and only blocks whose bound reaches the last neighbour so far
are looked at.  Bounds are in single precision with a margin for its error, cosines
are summed in double precision: the neighbours are exact.

Neighbours vote with their squared cosine as weight against a prior.  Votes are
turned into probabilities by an isotonic fit on leave-one-out votes of the
examples, in which an example is weighed without its own label and without terms that no other one has.  A document without
any term has the rate of such examples.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starload.llm.common import fold, give_back, held_out, labelled_sample
from starload.scratch import materialise

LETTERS = re.compile(r"[^\W\d_]+")
RESULT = "score double, predicted int, neighbours array<struct<doc_id: long, cosine: double, label: int>>"
#: The bound of the classifier: labelled documents.
EXAMPLES = 12_000
#: How much the root of twice the log likelihood ratio of a term and label 1 adds to its weight.
LABEL_WEIGHT = 0.8
DENSE = 120
NEIGHBOURS = 15
#: Terms, the most frequent ones, that have block maxima; examples of a block; documents that are looked up together.
COMMON = 512
BLOCK = 8
TOGETHER = 64
#: Blocks that are looked at before any can be skipped; with more than one in WIDE open, all are multiplied at once.
AHEAD, WIDE = 8, 8
#: More than twice the error of a sum of COMMON products in single precision, for vectors of length 1.
ERROR = 2 * COMMON * 2.0 ** -23
#: Rows whose results are held at once.
PIECE = 1024
#: The index is made and sent in so many buckets of terms.
BUCKETS = 16
THRESHOLD = 0.3


def terms_of(text: str | None) -> Counter:
    """Words of a text with their numbers, and its dense word beginnings, marked by a final star.

    A beginning that is common for its length also opens harmless words now and
    then, so it counts only from one in DENSE words on; `*2` marks two or more.
    """
    words = LETTERS.findall((text or "").lower())
    found = Counter(words)
    four: dict[str, int] = {}
    five: dict[str, int] = {}
    for word, times in found.items():
        size = len(word)
        if size > 4:
            four[word[:4]] = four.get(word[:4], 0) + times
            if size > 5:
                five[word[:5]] = five.get(word[:5], 0) + times
    least = len(words) / DENSE
    for beginnings in (four, five):
        for start, times in beginnings.items():
            if times >= least:
                found[start + "*"] = times
                if times > 1:
                    found[start + "*2"] = times
    return found


def label_ratio(with_1: np.ndarray, with_0: np.ndarray, all_1: int, all_0: int) -> np.ndarray:
    """Twice the log likelihood ratio of a term's counts per label, 0 where the term lowers the rate of label 1."""
    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)
    seen = with_1 + with_0
    rate = all_1 / max(1, all_1 + all_0)
    ratio = 2 * (part(with_1, seen * rate) + part(with_0, seen * (1 - rate))
                 + part(all_1 - with_1, (all_1 + all_0 - seen) * rate)
                 + part(all_0 - with_0, (all_1 + all_0 - seen) * (1 - rate)))
    return np.where(with_1 > seen * rate, ratio, 0.0)


Vector = tuple[np.ndarray, np.ndarray]


def hashed(found: Counter) -> Vector:
    """(64-bit hashes, numbers) of the terms of a text, in order of the hashes."""
    terms = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)
    order = np.argsort(terms)
    return terms[order], np.fromiter(found.values(), np.int64, len(found))[order]


def weights_of(seen: np.ndarray, with_1: np.ndarray, all_1: int, everyone: int) -> np.ndarray:
    """Inverse document frequency of terms, times what their presence says about label 1."""
    ratio = label_ratio(with_1, seen - with_1, all_1, everyone - all_1)
    return (np.log((1 + everyone) / (1 + seen)) + 1) * (1 + LABEL_WEIGHT * np.sqrt(np.maximum(ratio, 0.0)))


Bucket = tuple[int, bytes]


def pack(terms: np.ndarray, places: np.ndarray, times: np.ndarray, labels: np.ndarray, all_1: int, everyone: int) -> bytes:
    """One bucket of the index from its postings (term, place of the example, number, label of the example)."""
    order = np.lexsort((places, terms))
    terms, places, times, labels = terms[order], places[order], times[order], labels[order]
    names, starts = np.unique(terms, return_index=True)
    ends = np.append(starts, len(terms))
    seen = np.diff(ends)
    with_1 = np.add.reduceat(labels, starts) if len(starts) else seen
    values = (1 + np.log(times)) * np.repeat(weights_of(seen, with_1, all_1, everyone), seen)
    return pickle.dumps((names, seen.astype(np.int32), with_1.astype(np.int32), places.astype(np.int32),
                         values.astype(np.float32)), protocol=5)


class Index:
    """The examples in place order: ids and labels; postings by term, the common terms as rows of blocks with maxima."""

    def __init__(self, buckets: Sequence[Bucket], ids: np.ndarray, labels: np.ndarray):
        """buckets: number of postings and what `pack` made of them."""
        self.ids, self.labels = ids, labels
        self.all_1, self.everyone = int(labels.sum()), len(labels)
        found, squares = [(np.zeros(0, np.int64), *[np.zeros(0, np.int32)] * 2)], np.zeros(len(ids))
        ends = np.cumsum([0, *(n for n, _ in buckets)])
        self.postings = np.empty(ends[-1], [("place", np.int32), ("value", np.float32)])
        parts = [self.postings[a:b] for a, b in zip(ends, ends[1:])]
        for part, (_, bucket) in zip(parts, buckets):
            *terms, part["place"], part["value"] = pickle.loads(bucket)
            found.append(terms)
            squares += np.bincount(part["place"], part["value"].astype(float) ** 2, len(ids))
        for part in parts:
            part["value"] /= np.sqrt(np.maximum(squares, 1e-300))[part["place"]]
        names, seen, with_1 = (np.concatenate(p) for p in zip(*found))
        # The postings stay where they are, bucket after bucket; only the terms are put in order.
        order = np.argsort(names)
        seen = seen.astype(np.int64)
        ends = np.cumsum(seen)
        self.terms, self.with_1 = names[order], with_1[order]
        self.begin, self.number = (ends - seen)[order], seen[order]  # where a term's postings begin, and how many it has
        self.weight = weights_of(self.number, self.with_1, self.all_1, self.everyone)
        self.has_terms = squares > 0
        chosen = np.lexsort((self.terms, -self.number))[:COMMON]
        self.column = np.full(len(self.terms), -1, np.int32)
        self.column[chosen] = np.arange(len(chosen))
        blocks = -(-len(ids) // BLOCK)
        self.common = np.zeros((blocks * BLOCK, len(chosen)), np.float32)
        for column, term in enumerate(chosen):
            own = slice(self.begin[term], self.begin[term] + self.number[term])
            self.common[self.postings["place"][own], column] = self.postings["value"][own]
        in_blocks = self.common.reshape(blocks, BLOCK, len(chosen))
        self.maxima = in_blocks.max(axis=1, initial=0.0)
        self.lengths = np.sqrt(np.einsum("bij,bij->bi", in_blocks, in_blocks)).max(axis=1, initial=0.0)

    def vector(self, terms: np.ndarray, times: np.ndarray, left_out: int = -1) -> Vector:
        """(places of the terms in the index, weights) of a text; as if the example `left_out`, itself, were not there."""
        at = np.searchsorted(self.terms, terms)
        known = self.terms[np.minimum(at, len(self.terms) - 1)] == terms if len(self.terms) else np.zeros(len(terms), bool)
        weight = None
        if left_out >= 0:
            known &= self.number[at] > 1
            label = int(self.labels[left_out])
            weight = weights_of(self.number[at[known]] - 1, self.with_1[at[known]] - label, self.all_1 - label, self.everyone - 1)
        at = at[known]
        weights = (1 + np.log(times[known])) * (self.weight[at] if weight is None else weight)
        return at, weights / (np.sqrt((weights ** 2).sum()) or 1.0)

    def nearest_of(self, vectors: Sequence[Vector], left_out: Sequence[int] | None = None) -> Iterator[Vector]:
        """(places, cosines) of the neighbours of each vector: positive cosines, best first, ties by place."""
        for first in range(0, len(vectors), TOGETHER):
            some = vectors[first:first + TOGETHER]
            rows = np.zeros((len(some), self.common.shape[1]), np.float32)
            for row, (at, weights) in zip(rows, some):
                columns = self.column[at]
                row[columns[columns >= 0]] = weights[columns >= 0]
            # What the common terms can add in a block: by their maxima, and by the lengths of the two vectors.
            bounds = np.minimum(rows @ self.maxima.T, np.sqrt((rows ** 2).sum(axis=1))[:, None] * self.lengths) + ERROR
            skips = [-1] * len(some) if left_out is None else left_out[first:first + TOGETHER]
            looks = [_Look(self, *vector, skip, bound) for vector, skip, bound in zip(some, skips, bounds)]
            # Vectors that few blocks can be skipped for are multiplied with all examples at once.
            wide = [i for i, look in enumerate(looks) if WIDE * len(look.open) > len(self.maxima)]
            products = dict(zip(wide, rows[wide] @ self.common.T)) if wide else {}
            for i, look in enumerate(looks):
                yield look.best(rows[i], products.get(i))

    def rare_sums(self, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the terms that are not common add to the cosine of every example."""
        rare = self.column[at] < 0
        begin, number = self.begin[at[rare]], self.number[at[rare]]
        ends = np.cumsum(number)
        if not len(ends):
            return np.zeros(len(self.common))
        # All postings of these terms, one list after the other.
        every = np.arange(ends[-1])
        every += np.repeat(begin - ends + number, number)
        some = self.postings.take(every)
        return np.bincount(some["place"], some["value"] * np.repeat(weights[rare], number), len(self.common))

    @staticmethod
    def open_blocks(upper: np.ndarray, least: float) -> np.ndarray:
        """The blocks that may hold an example at least as near as the last neighbour; the others are skipped."""
        return (upper >= least) & (upper > ERROR)

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        prior = self.all_1 / max(1, self.everyone)
        weight = cosines ** 2
        return float((weight @ self.labels[places] + 0.25 * prior) / (weight.sum() + 0.25))

    def votes(self, texts: Iterable[tuple[np.ndarray, np.ndarray, int]]) -> list[float]:
        """Leave-one-out votes of examples (terms, numbers, place)."""
        texts, found = list(texts), []
        for first in range(0, len(texts), TOGETHER):
            some = texts[first:first + TOGETHER]
            found += [self.vote(*n) for n in self.nearest_of([self.vector(*t) for t in some], [t[2] for t in some])]
        return found

    def empty_score(self) -> float:
        """The rate of label 1 among examples without any term, smoothed by the rate of all."""
        empty = self.labels[~self.has_terms]
        return float((empty.sum() + 0.5 * self.all_1 / max(1, self.everyone)) / (len(empty) + 0.5))

    def scores(self, texts: Sequence[str | None], knots: Vector) -> Iterator[tuple[float, list[tuple[int, float, int]]]]:
        for first in range(0, len(texts), TOGETHER):
            vectors = [self.vector(*hashed(terms_of(text))) for text in texts[first:first + TOGETHER]]
            for (at, _), (places, cosines) in zip(vectors, self.nearest_of(vectors)):
                if not len(at):
                    yield self.empty_score(), []
                    continue
                score = float(np.interp(self.vote(places, cosines), *knots))
                yield score, [(int(self.ids[p]), float(c), int(self.labels[p])) for p, c in zip(places, cosines)]


class _Look:
    """One vector's way through the index: what its rarer terms add, and the blocks that are open."""

    def __init__(self, index: Index, at: np.ndarray, weights: np.ndarray, skip: int, bounds: np.ndarray):
        self.index, self.skip = index, skip
        self.sums = index.rare_sums(at, weights)
        columns = index.column[at]
        self.columns, self.weights = columns[columns >= 0], weights[columns >= 0]
        upper = bounds + self.sums.reshape(-1, BLOCK).max(axis=1, initial=0.0)
        # The blocks with the largest bounds give a first last neighbour.
        ahead = np.argpartition(-upper, AHEAD - 1)[:AHEAD] if len(upper) > AHEAD else np.arange(len(upper))
        self.places = self.inside(ahead)
        self.values = self.cosines(self.places)
        self.least = np.partition(self.values, -NEIGHBOURS)[-NEIGHBOURS] if len(self.values) >= NEIGHBOURS else 0.0
        still = index.open_blocks(upper, self.least)
        still[ahead] = False
        self.open = np.flatnonzero(still)

    @staticmethod
    def inside(blocks: np.ndarray) -> np.ndarray:
        return (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()

    def cosines(self, places: np.ndarray) -> np.ndarray:
        found = self.sums[places] + self.index.common.take(places, axis=0).take(self.columns, axis=1) @ self.weights
        found[places == self.skip] = 0.0
        return found

    def best(self, row: np.ndarray, products: np.ndarray | None) -> Vector:
        places, values = self.places, self.values
        if len(self.open):
            more = self.inside(self.open)
            near = self.sums[more] + (products[more] if products is not None else self.index.common.take(more, axis=0) @ row)
            near[more == self.skip] = 0.0
            least = self.least
            if len(near) > NEIGHBOURS:  # as many are at least this near
                least = max(least, np.partition(near, -NEIGHBOURS)[-NEIGHBOURS] - ERROR)
            more = more[near + ERROR >= least]
            places, values = np.concatenate([places, more]), np.concatenate([values, self.cosines(more)])
        places, values = places[values > 0], values[values > 0]
        best = np.lexsort((places, -np.round(values, 12)))[:NEIGHBOURS]
        return places[best], values[best]


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of labels on votes (pool adjacent violators), smoothed by one half."""
    pools: list[list[float]] = []  # sum of votes, of labels, number
    for i in np.argsort(votes, kind="stable"):
        pools.append([votes[i], labels[i], 1.0])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    if not pools:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    sums = np.array(pools)
    level = (sums[:, 1] + 0.5) / (sums[:, 2] + 1)
    return sums[:, 0] / sums[:, 2], np.maximum.accumulate(level)


@dataclass
class Judge:
    """A fitted index, ready for tasks, and the calibration of its votes."""

    index: Callable[[], Index]
    knots: Vector


def fit(docs: DataFrame, labels: DataFrame, usable: Column, bound: int = EXAMPLES) -> Judge:
    """The index of a bounded sample of labelled documents; equal texts with equal labels count once."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, "toxic", usable, bound)
    once = sample.groupBy(F.xxhash64("text"), "label").agg(F.min("doc_id").alias("doc_id"))
    # One narrow row per example of the bounded sample.
    numbered = materialise(once.select("doc_id", "label", (F.row_number().over(Window.orderBy("doc_id")) - 1).alias("place")),
                           "examples")
    examples = numbered.orderBy("place").toPandas()
    ids, marks = examples["doc_id"].to_numpy(np.int64), examples["label"].to_numpy(np.int64)
    all_1, everyone = int(marks.sum()), len(marks)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [hashed(terms_of(text)) for text in batch["text"]]
            yield pd.DataFrame({"place": batch["place"], "label": batch["label"], "terms": [t for t, _ in found],
                                "times": [n for _, n in found]})

    def bucket(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [len(rows)], "packed": [pack(*(
            rows[c].to_numpy(np.int64) for c in ("term", "place", "times", "label")), all_1, everyone)]})

    texts = sample.join(F.broadcast(numbered.select("doc_id", "place")), "doc_id")
    counted = materialise(texts.select("place", "label", "text").mapInPandas(
        count, "place int, label int, terms array<long>, times array<long>"), "example-terms")
    postings = counted.select("place", "label", F.explode(F.arrays_zip("terms", "times")).alias("t")).select(
        "place", "label", F.col("t.terms").alias("term"), F.col("t.times").alias("times"))
    buckets = [(r.n, bytes(r.packed)) for r in postings.groupBy(F.pmod("term", F.lit(BUCKETS)).alias("bucket"))
               .applyInPandas(bucket, "n long, packed binary").collect()]
    packed = spark.sparkContext.broadcast((buckets, ids, marks))  # plain values, which need no code to be read

    def index() -> Index:
        return Index(*packed.value)

    def leave_one_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = index()
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"],
                                "vote": known.votes(zip(batch["terms"], batch["times"], batch["place"]))})

    votes = counted.where(F.size("terms") > 0).mapInPandas(leave_one_out, "label int, vote double").toPandas()
    votes = votes.sort_values(["vote", "label"], kind="stable")
    return Judge(index, isotonic(votes["vote"].to_numpy(float), votes["label"].to_numpy(float)))


def in_pieces(texts: pd.Series) -> Iterator[tuple[pd.Series, list[str | None]]]:
    """A batch in pieces whose results are small, each with its different texts: copies that come together count once."""
    for start in range(0, len(texts), PIECE):
        some = texts.iloc[start:start + PIECE]
        yield some, list(dict.fromkeys(some))


def score(text: Column, judge: Judge) -> Column:
    @F.pandas_udf(RESULT)
    def judged_by(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = judge.index()
        for texts in batches:
            for some, different in in_pieces(texts):
                found = dict(zip(different, known.scores(different, judge.knots)))
                rows = [found[text] for text in some]
                yield pd.DataFrame({"score": [s for s, _ in rows], "predicted": [int(s >= THRESHOLD) for s, _ in rows],
                                    "neighbours": [[{"doc_id": d, "cosine": c, "label": y} for d, c, y in n] for _, n in rows]})
        del known
        give_back()
    return judged_by(text)


def predicted(text: Column, judge: Judge) -> Column:
    """The label alone."""
    @F.pandas_udf("int")
    def predicted_by(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = judge.index()
        for texts in batches:
            for some, different in in_pieces(texts):
                found = dict(zip(different, (int(s >= THRESHOLD) for s, _ in known.scores(different, judge.knots))))
                yield pd.Series([found[text] for text in some], dtype="int32")
        del known
        give_back()
    return predicted_by(text)


def judged(docs: DataFrame, labels: DataFrame, folds: int = 4, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted and the neighbours behind it for every row of docs (doc_id, text, any others).

    Labels are learnt from rows whose fold is not the held-out one; a row without
    doc_id has none and is not held out.  Of several rows of one doc_id the one
    with the largest text is learnt from.  A NULL or empty text has no terms and
    the score of such examples.  Without labels every score is 0.  Equal rows
    have equal results.  An empty table gives an empty one.
    """
    judge = fit(docs, labels, fold("doc_id", folds) != remainder)
    result = docs.select("doc_id", held_out("doc_id", folds, remainder).alias("held_out"), score(F.col("text"), judge).alias("s"))
    return result.select("doc_id", "held_out", "s.*")


def without_toxic(docs: DataFrame, labels: DataFrame, folds: int = 4, remainder: int = 2) -> DataFrame:
    """The rows of docs that are not predicted toxic."""
    judge = fit(docs, labels, fold("doc_id", folds) != remainder)
    rows = docs.select(F.struct(*docs.columns).alias("row"), predicted(docs["text"], judge).alias("label"))
    return rows.where("label = 0").select("row.*")
