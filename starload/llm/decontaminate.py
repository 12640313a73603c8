"""Benchmark passages in documents, by the q-gram lemma.

Texts are compared as lower-cased characters with every run of white space as
one blank.  A passage of m characters that occurs with at most e edits shares at
least m - q + 1 - q * e of its q-grams with the place, all of them within a band
of diagonals.  So the shared q-grams of a document and a passage are counted in
bands of diagonals twice as wide as the edits allow, each overlapping the next
by half, and only bands that reach the bound are aligned, in a band as well.
q is 8, or as much less as a short passage needs for its bound to be positive.

The q-grams of the passages are looked up in a sorted array behind a bitmap.
Equal q-grams that follow each other in a passage are one run with a range of
diagonals, and the shared ones are counted in pieces, so that repetitive texts need no more memory than others.
Passages go through in blocks of bounded size, each of which is broadcast and
held against all documents; a small benchmark is one block.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starload.llm.common import shared

Q = 8
#: Edits allowed, as a share of the characters of a passage.
EDITS = 0.1
#: Characters of passages in a block.
BLOCK_CHARACTERS = 2_000_000
#: Characters of documents that are looked up at once.
CHUNK = 1 << 18
#: Shared q-grams that are held at once.
PIECE = 1 << 20
BITMAP = 20
WORDS = re.compile(r"\S+")
FOUND = "array<struct<item_id: long, start: long, stop: long, edits: int>>"


def lowered(text: str) -> str:
    """Lower case, character by character: a letter whose lower case is longer stays as it is."""
    lower = text.lower()
    if len(lower) == len(text):
        return lower
    return "".join(low if len(low) == 1 else c for c, low in zip(text, map(str.lower, text)))


def compared(text: str | None) -> str:
    """The text as it is compared: words in lower case with one blank between them."""
    return " ".join(lowered(text).split()) if text else ""


def places_in(text: str) -> list[int]:
    """For each character of the compared text its place in the text."""
    places: list[int] = []
    for word in WORDS.finditer(text):
        if places:
            places.append(word.start() - 1)
        places.extend(range(word.start(), word.end()))
    return places


def folded(text: str) -> np.ndarray:
    """One byte per character; equal characters have equal bytes, so no shared q-gram is lost."""
    try:
        return np.frombuffer(text.encode("latin-1"), dtype=np.uint8)
    except UnicodeEncodeError:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        return (codes ^ (codes >> 8) * 31).astype(np.uint8)


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """The q-grams of a byte array, q at most 8, as 64-bit values."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8 - q, np.uint8)]) if q < 8 else np.ascontiguousarray(data)
    windows = np.ndarray(len(data) - q + 1, dtype="<u8", buffer=padded, strides=(1,))
    return windows & np.uint64((1 << 8 * q) - 1) if q < 8 else windows


def spread(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (number[0] of them), first[1], ..."""
    return np.repeat(first - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))


@dataclass
class Hits:
    """Shared q-grams: a place in the text, a passage, and a run of its places (first one and length)."""

    at: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    length: np.ndarray

    def only(self, chosen: np.ndarray) -> Hits:
        return Hits(self.at[chosen], self.owner[chosen], self.first[chosen], self.length[chosen])


class Grams:
    """The q-grams of passages for one q, sorted; equal ones that follow each other in a passage are one run."""

    def __init__(self, q: int, owners: np.ndarray, texts: list[str]):
        self.q = q
        codes, owner, first, length = [], [], [], []
        for i in owners.tolist():
            own = grams(folded(texts[i]), q)
            begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            codes.append(own[begin])
            owner.append(np.full(len(begin), i))
            first.append(begin)
            length.append(np.diff(np.r_[begin, len(own)]))
        codes, owner, first, length = (np.concatenate(x) for x in (codes, owner, first, length))
        order = np.lexsort((first, owner, codes))
        self.codes, self.runs = codes[order], Hits(codes[order], owner[order], first[order], length[order])
        self.bitmap = np.zeros(1 << BITMAP, dtype=bool)
        self.bitmap[self._bits(self.codes)] = True

    @staticmethod
    def _bits(codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITMAP)).astype(np.int64)

    def hits(self, data: np.ndarray) -> Callable[[], Iterator[Hits]]:
        """All shared q-grams of a text with the passages, in pieces of bounded size; can be gone through again."""
        at, first, last = [], [], []
        for start in range(0, max(0, len(data) - self.q + 1), CHUNK):
            codes = grams(data[start:start + CHUNK + self.q - 1], self.q)
            likely = np.flatnonzero(self.bitmap[self._bits(codes)])
            low = np.searchsorted(self.codes, codes[likely], "left")
            high = np.searchsorted(self.codes, codes[likely], "right")
            known = high > low
            at.append(likely[known] + start)
            first.append(low[known])
            last.append(high[known])
        at, first, last = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, first, last))
        number = last - first
        edges = np.searchsorted(np.cumsum(number), np.arange(PIECE, int(number.sum()) + PIECE, PIECE), "right")
        edges = np.unique(np.r_[0, edges, len(at)])

        def piece(a: int, b: int) -> Hits:
            run = spread(first[a:b], number[a:b])
            return Hits(np.repeat(at[a:b], number[a:b]), self.runs.owner[run], self.runs.first[run], self.runs.length[run])
        made = [piece(0, len(at))] if len(edges) == 2 else None
        return lambda: iter(made) if made else (piece(a, b) for a, b in zip(edges, edges[1:]))


def summed(keys: list[np.ndarray], values: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of keys and the sums of their values."""
    if not len(values):
        return keys, values
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    edge = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
    return [k[edge] for k in keys], np.add.reduceat(values[order], edge)


def summed_up(parts: Iterable[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray] | None:
    total = None
    for keys, values in parts:
        part = summed(keys, values)
        total = part if total is None else summed([np.r_[a, b] for a, b in zip(total[0], part[0])], np.r_[total[1], part[1]])
    return total


@dataclass
class Passages:
    """A block of passages: their q-grams, and what bounds a match."""

    ids: list[int]
    texts: list[str]
    edits: np.ndarray = field(init=False)
    bound: np.ndarray = field(init=False)

    def __post_init__(self):
        size = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.edits = np.floor(EDITS * size).astype(np.int64)
        # So many shared q-grams are promised; shorter ones where those of Q characters promise none.
        q = np.minimum(Q, size // (self.edits + 1))
        self.bound = size - q + 1 - q * self.edits
        self.short = np.flatnonzero((size > 0) & (size < Q)).tolist()
        long = size >= Q
        self.tables = [Grams(int(one), np.flatnonzero(long & (q == one)), self.texts) for one in np.unique(q[long])]

    def bands(self, hits: Hits, text_of: np.ndarray, begin: np.ndarray, shift: int) -> tuple[list[np.ndarray], np.ndarray]:
        """(text, passage, band) of every hit, and how many q-grams of its run lie in that band of diagonals."""
        wide = 2 * (self.edits[hits.owner] + 1)  # bands of two widths, one starting at every width
        last = hits.at - begin - hits.first + shift * wide // 2
        lowest = last - hits.length + 1
        low, high = lowest // wide, last // wide
        number = high - low + 1
        band, wide, last, lowest = spread(low, number), *(np.repeat(x, number) for x in (wide, last, lowest))
        inside = np.minimum(last, (band + 1) * wide - 1) - np.maximum(lowest, band * wide) + 1
        return [np.repeat(text_of, number), np.repeat(hits.owner, number), band], inside

    def regions(self, data: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, passage, start, stop): places that share enough q-grams with a passage in a band of diagonals.

        data: the texts one after the other, each with one byte behind it; begins: where they begin, and the end.
        """
        for table in self.tables:
            pieces = table.hits(data)

            def placed() -> Iterator[tuple[Hits, np.ndarray]]:
                for hits in pieces():
                    yield hits, np.searchsorted(begins, hits.at, "right") - 1
            counted = summed_up(([text_of, hits.owner], hits.length) for hits, text_of in placed())
            if counted is None:
                continue
            (texts, owners), number = counted
            enough = number >= self.bound[owners]
            likely = np.sort(texts[enough] * len(self.ids) + owners[enough])
            if not len(likely):
                continue
            for shift in (0, 1):
                parts = []
                for hits, text_of in placed():
                    key = text_of * len(self.ids) + hits.owner
                    chosen = np.flatnonzero(likely[np.minimum(np.searchsorted(likely, key), len(likely) - 1)] == key)
                    parts.append(summed(*self.bands(hits.only(chosen), text_of[chosen], begins[text_of[chosen]], shift)))
                (texts, owners, bands), number = summed_up(parts)
                for i in np.flatnonzero(number >= self.bound[owners]).tolist():
                    text, item = int(texts[i]), int(owners[i])
                    edits, size = int(self.edits[item]), int(begins[text + 1] - begins[text]) - 1
                    low = (2 * int(bands[i]) - shift) * (edits + 1)
                    stop = low + 2 * (edits + 1) + len(self.texts[item]) + edits
                    yield text, item, max(0, low - edits), min(size, stop)

    def matches(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """Per compared text (passage, start, stop, edits): the best place of each region, overlaps of one passage once."""
        results: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        start = 0
        while start < len(texts):  # as many texts at once as fit a chunk
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) < CHUNK):
                size += len(texts[stop]) + 1
                stop += 1
            begins = np.cumsum([0] + [len(t) + 1 for t in texts[start:stop]])
            found: dict[int, set[tuple[int, int, int]]] = {}
            for text, *region in self.regions(folded("\n".join(texts[start:stop])), begins):
                found.setdefault(text, set()).add(tuple(region))
            for text, regions in found.items():
                results[start + text] = self.confirmed(texts[start + text], sorted(regions))
            start = stop
        for item in self.short:
            word = re.compile(rf"(?<!\w){re.escape(self.texts[item])}(?!\w)")
            for i, text in enumerate(texts):
                results[i] = sorted(results[i] + [(item, m.start(), m.end(), 0) for m in word.finditer(text)])
        return results

    def confirmed(self, text: str, regions: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        found, aligned = set(), {}
        for item, start, stop in regions:
            place = text.find(self.texts[item], start, stop)
            if place >= 0:
                found.add((item, place, place + len(self.texts[item]), 0))
            elif self.edits[item]:
                key = item, text[start:stop]  # a text that repeats itself has many equal regions
                if key not in aligned:
                    aligned[key] = banded(self.texts[item], key[1], int(self.edits[item]))
                if best := aligned[key]:
                    found.add((item, start + best[0], start + best[1], best[2]))
        kept: list[tuple[int, int, int, int]] = []
        for match in sorted(found, key=lambda m: (m[0], m[3], m[1])):
            at = bisect(kept, match)  # what is kept lies apart, so only the neighbours can overlap
            if not any(k[0] == match[0] and k[1] < match[2] and match[1] < k[2] for k in kept[max(0, at - 1):at + 1]):
                kept.insert(at, match)
        return kept


def banded(passage: str, region: str, most: int) -> tuple[int, int, int] | None:
    """(start, stop, edits) of the best occurrence of the passage in the region, or None beyond `most` edits.

    The region is as long as the band is wide, so every row is computed whole:
    a cell is a substitution or deletion from the row above, or an insertion,
    which is a running minimum.  Starts are carried along.  Ties: fewest edits,
    then the earliest stop.
    """
    text = np.array([ord(c) for c in region], dtype=np.int64)
    steps = np.arange(len(text) + 1)
    cost, begin = np.zeros(len(text) + 1, dtype=np.int64), steps.copy()
    best, source = np.empty_like(cost), np.zeros_like(cost)
    for row, character in enumerate(passage, 1):
        across = cost[:-1] + (text != ord(character))
        down = cost[1:] + 1
        best[0] = row
        np.minimum(across, down, out=best[1:])
        source[1:] = np.where(across <= down, begin[:-1], begin[1:])
        level = best - steps
        lowest = np.minimum.accumulate(level)
        origin = np.maximum.accumulate(np.where(level == lowest, steps, 0))
        cost, begin = lowest + steps, source[origin]
        if cost.min() > most:
            return None
    stop = int(cost.argmin())
    return (int(begin[stop]), stop, int(cost[stop])) if cost[stop] <= most else None


def blocks(benchmark: DataFrame, characters: int = BLOCK_CHARACTERS) -> Iterator[Passages]:
    """The passages of a benchmark (item_id, text) in blocks of bounded size; empty ones match nothing."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").where("item_id IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        text = compared(row["text"])
        if not text:
            continue
        if ids and size + len(text) > characters:
            yield Passages(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(text)
        size += len(text)
    if ids:
        yield Passages(ids, texts)


def found_in(text: Column, passages: Passages, spark: SparkSession) -> Column:
    """The occurrences of a block of passages, with places in the original text."""
    unpack = shared(spark, passages)

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = unpack()
        for texts in batches:
            every = list(texts)
            rows = []
            for one, matches in zip(every, known.matches([compared(t) for t in every])):
                places = places_in(one) if matches else []
                rows.append([{"item_id": known.ids[i], "start": places[a], "stop": places[b - 1] + 1, "edits": e}
                             for i, a, b, e in matches])
            yield pd.Series(rows)
    return find(text)


def all_found(docs: DataFrame, benchmark: DataFrame) -> Column:
    """The occurrences of all passages in the text of docs."""
    columns = [found_in(docs["text"], block, docs.sparkSession) for block in blocks(benchmark)]
    return F.concat(*columns) if columns else F.array().cast(FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, matches (item_id, start, stop, edits), n_items and is_contaminated for every row of docs.

    start and stop are characters of the whole text.  A NULL or empty text holds
    nothing.  A passage shorter than a q-gram matches whole words only, and an
    empty one or one without item_id nothing.  Repeated rows have equal results,
    an empty table gives an empty one, an empty benchmark finds nothing.
    """
    found = docs.select("doc_id", all_found(docs, benchmark).alias("matches"))
    return found.select("doc_id", "matches",
                        F.size(F.array_distinct(F.transform("matches", lambda m: m["item_id"]))).cast("long").alias("n_items"),
                        (F.size("matches") > 0).alias("is_contaminated"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs in which no passage of the benchmark occurs."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), all_found(docs, benchmark).alias("matches"))
    return rows.where(F.size("matches") == 0).select("row.*")
