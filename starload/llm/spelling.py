"""Spelling variants: words one edit apart, found with bit-sliced position indexes.

Occurrences are counted over all documents.  Two words are near if one inserted,
deleted or replaced code point makes one of the other.  Let the shorter one of two
near words have m code points and h = m // 2: they have the first h in common or,
if the edit lies there, the last m - h.  So a word of L code points takes part
four times, with its first and its last half, for m = L and m = L - 1.  Equal halves are dealt
into cells of about `Shape.cell` words; a cell that a frequent half makes larger
is cut into blocks, and each block is looked up in each.

A cell holds, per (position, letter), a bitset over its words: who has that
letter there.  Many words are looked up at once.  Four sets per word go through its
letters: no error so far, one replaced letter, one letter more (positions shift
by one) and one letter less (shift back); each step is a few operations on whole
machine words.  A pair that has the first half in common counts there and not at the
last half, so it is found once.  No pair leaves a cell, only one row per word with near words.

A word's form is its near word of largest n if that is large enough; forms are
followed to the last by pointer doubling.  n grows with every step, so there are no circles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starload.scratch import materialise

# Fixed values of the contract.
RUN = r"[A-Za-z\u00C0-\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Shape:
    """Least code points and occurrences of a word, how much more frequent a form is, which occurrences lose a letter."""

    least_length: int = 6
    least_n: int = 5
    factor: int = 5
    every: int = 199
    #: Words of a cell, and of a block of a cell that is twice as large.
    cell: int = 4096


def vocabulary(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(word, n) of all words of docs (doc_id, text) that are long and frequent enough.

    An occurrence loses one code point if its hash with the doc_id says so; without doc_id none does.
    """
    run = F.translate("run", UPPER, LOWER)
    runs = (docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
            .where(F.length("run") >= shape.least_length).select("doc_id", run.alias("run")))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    place = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = runs.select(F.when(h % shape.every == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= shape.least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= shape.least_n))


def _bits(members: np.ndarray) -> np.ndarray:
    """Booleans as 64-bit machine words."""
    padded = np.zeros(-(-len(members) // 64) * 64, bool)
    padded[:len(members)] = members
    return np.packbits(padded, bitorder="little").view(np.uint64)


class PositionIndex:
    """Bitsets over words, per position and letter, and per length."""

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) for w in words])
        letters, number = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), return_inverse=True)
        owner = np.repeat(np.arange(len(words)), self.lengths)
        place = np.arange(len(number)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        longest, self.width = int(self.lengths.max()), -(-len(words) // 64)
        # Position i is row i + 1: one before the first and one after the last letter have no word.
        self.table = np.zeros((longest + 2, len(letters), self.width), np.uint64)
        np.bitwise_or.at(self.table, (place + 1, number, owner >> 6), np.uint64(1) << (owner & 63).astype(np.uint64))
        self.letters = np.zeros((len(words), longest), np.int64)
        self.letters[owner, place] = number

    def of_length(self, length: int) -> np.ndarray:
        return _bits(self.lengths == length)

    def near(self, queries: np.ndarray, among: np.ndarray, half: int, first_half: bool) -> np.ndarray:
        """One bitset per query, all of one length: the words of the bitset `among` that are one edit away.

        Only words with (or, without first_half, only words without) the first `half` letters in common.
        """
        length = int(self.lengths[queries[0]])
        exact = np.repeat(among[None, :], len(queries), axis=0)
        replaced, longer, shorter = (np.zeros_like(exact) for _ in range(3))
        halves = exact
        for i, letter in enumerate(self.letters[queries, :length].T):
            here, after, before = (self.table[i + 1 + shift, letter] for shift in (0, 1, -1))
            shorter = (shorter & before) | exact
            longer = (longer | exact) & after
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
            if i + 1 == half:
                halves = exact if first_half else ~exact
        return halves & ((replaced & self.of_length(length)) | ((longer | exact) & self.of_length(length + 1))
                         | (shorter & self.of_length(length - 1)))


#: So many words are looked up together.
TOGETHER = 256
FOUND = "word string, n_near long, other_n long, other string"


def _look_up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Of the words of one cell that are asked for: how many near ones it has, and the most frequent of them."""
    first_half, m = bool(key[0]), int(key[1])
    words, counts = rows["word"].tolist(), rows["n"].to_numpy()
    index = PositionIndex(words)
    by_rank = np.array(sorted(range(len(words)), key=lambda i: (-counts[i], words[i])))  # str orders by code point
    rank = np.argsort(by_rank)
    targets, found = rows["target"].to_numpy(bool), []
    for length in (m, m + 1):
        asked = np.flatnonzero((index.lengths == length) & rows["asked"].to_numpy(bool))
        # Two words of m + 1 letters meet where m + 1 is the shorter length.
        among = _bits(targets & ((index.lengths == m) | (length == m)))
        for start in range(0, len(asked), TOGETHER):
            some = asked[start:start + TOGETHER]
            near = index.near(some, among, m // 2, first_half).view(np.uint8)
            query, other = np.nonzero(np.unpackbits(near, axis=1, bitorder="little"))
            if len(query):
                begin = np.flatnonzero(np.diff(query, prepend=-1))
                best = by_rank[np.minimum.reduceat(rank[other], begin)]
                found.append(pd.DataFrame({
                    "word": [words[i] for i in some[query[begin]]], "n_near": np.diff(np.append(begin, len(query))),
                    "other_n": counts[best], "other": [words[i] for i in best]}))
    return pd.concat(found) if found else pd.DataFrame(columns=["word", "n_near", "other_n", "other"])


def near_words(words: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """(word, n_near, other_n, other) of the words (word, n), all different, that have near ones.

    other is the near word of largest n, ties by code point.
    """
    def halves(first: bool, m: Column) -> Column:
        h = F.floor(m / 2).cast("int")
        half = F.substring("word", F.lit(1), h) if first else F.substring("word", F.length("word") - m + h + 1, m - h)
        return F.struct(F.lit(first).alias("first_half"), m.alias("m"), F.xxhash64(half, F.lit(first)).alias("half"))

    length = F.length("word")
    entries = words.select("word", "n", F.explode(F.array(*[halves(f, m) for f in (True, False) for m in (length, length - 1)]))
                           .alias("e")).select("word", "n", "e.*").where(F.col("m") >= shape.least_length)
    cells = (words.groupBy(F.length("word").alias("m")).agg(F.count(F.lit(1)).alias("n"))
             .select("m", F.ceil(F.col("n") / shape.cell).alias("cells")))
    # Words of m + 1 letters come to a length m that no word has, too; they meet nobody there.
    dealt = (entries.join(cells, "m").withColumn("cell", F.pmod("half", "cells")).drop("half", "cells"))
    group = ["first_half", "m", "cell"]
    large = (dealt.groupBy(group).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 2 * shape.cell)
             .select(*group, F.ceil(F.col("size") / shape.cell).cast("int").alias("blocks")))
    cut = (dealt.join(large, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
           .withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_asked = F.transform(every, lambda other: F.struct(F.col("own").alias("asking"), other.alias("among")))
    as_target = F.transform(F.filter(every, lambda other: other != F.col("own")),
                            lambda other: F.struct(other.alias("asking"), F.col("own").alias("among")))
    placed = cut.select("word", "n", *group, "own", F.explode(F.concat(as_asked, as_target)).alias("p")).select(
        "word", "n", *group, "p.*", (F.col("own") == F.col("p.asking")).alias("asked"),
        (F.col("own") == F.col("p.among")).alias("target"))
    # Few bytes make much work here, so tasks are not joined by their bytes: as many stay as a shuffle has.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = [*group, "asking", "among"]
    found = placed.repartition(tasks, *cell).groupBy(*cell).applyInPandas(_look_up, FOUND)
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("b")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("b.minus")).alias("other_n"), F.col("b.other").alias("other")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words of forms (word, form) without circles: the end of the way from form to form."""
    at = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialise(at.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of docs (doc_id, text and any others).

    form is the near word of largest n (ties: smallest in code-point order) if
    its n is at least `factor` times the word's own, else NULL; root is the last
    of the forms, the word itself without one.  A NULL text has no words; a
    repeated row counts again; occurrences in a row without doc_id stay as they
    are.  Runs of any length are words.  An empty table gives an empty one.
    """
    words = materialise(vocabulary(docs, shape), "words")
    near = near_words(words, shape)
    is_form = F.col("other_n") >= shape.factor * F.col("n")
    formed = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("other")).alias("form"), F.when(is_form, F.col("other_n")).alias("form_n")), "forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
