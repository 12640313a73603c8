"""Fill-in-the-middle: cut every document at two of its units and put the middle last.

A unit is a run of letters A-Z, a-z or any other single character.  The UTF-8
bytes of a text lie in fixed blocks.  Two Fenwick trees over the blocks store how
many units and how many code points begin in each.  A cut after k units is where
unit k + 1 begins: descending the trees by powers of two finds the block of
that unit and the code points before it, and the place inside the block is looked
up in the bytes of that block alone.

What a document is cut into is decided by a hash of seed and doc_id, so every run
agrees.  A text is put together again with SQL functions: no text that is cut
contains a marker, and no marker can begin inside a piece and end in the next
one, because `<` is only the first character of a marker.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starload.llm.common import utf8

# Fixed values of the contract: markers, and the forms of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Bytes of a block.
BLOCK = 4096
CUT = "n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Shape:
    """Seed, and how many per cent of the documents are cut and of those put suffix first."""

    seed: int = 1
    cut_percent: int = 90
    suffix_first_percent: int = 20


class Fenwick:
    """Sums over blocks: the prefix sum of several counts at once, and the block of the k-th of the first one."""

    def __init__(self, counts: np.ndarray):
        """counts: one row per block, one column per kind."""
        size = len(counts)
        sums = np.zeros((size + 1, counts.shape[1]), np.int64)
        np.cumsum(counts, axis=0, out=sums[1:])
        place = np.arange(size + 1)
        self.tree = sums - sums[place - (place & -place)]
        self.total = sums[-1]

    def find(self, number: int) -> tuple[int, np.ndarray]:
        """The block in which the first count reaches `number` (1 or more, at most its total), and all sums before it."""
        place, before = 0, np.zeros(self.tree.shape[1], np.int64)
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            ahead = place + step
            if ahead < len(self.tree) and before[0] + self.tree[ahead, 0] < number:
                place, before = ahead, before + self.tree[ahead]
            step >>= 1
        return place, before


class Units:
    """The units of one text."""

    def __init__(self, data: bytes, block: int = BLOCK):
        self.data, self.block = data, block
        bytes_ = np.frombuffer(data, np.uint8)
        lower = bytes_ | 0x20
        letter = (lower >= ord("a")) & (lower <= ord("z"))
        self.first = (bytes_ & 0xC0) != 0x80  # where a code point begins
        self.begins = self.first & ~letter
        self.begins[:1] |= letter[:1]
        self.begins[1:] |= letter[1:] & ~letter[:-1]
        starts = np.arange(0, len(data), block)
        counts = np.zeros((len(starts), 2), np.int64)
        if len(starts):
            counts[:, 0] = np.add.reduceat(self.begins, starts, dtype=np.int64)
            counts[:, 1] = np.add.reduceat(self.first, starts, dtype=np.int64)
        self.tree = Fenwick(counts)
        self.n, self.chars = (int(x) for x in self.tree.total)

    def cut(self, units: int) -> tuple[int, int]:
        """(byte, code point) at which the first `units` units end."""
        if units >= self.n:
            return len(self.data), self.chars
        block, (before, chars) = self.tree.find(units + 1)
        start = block * self.block
        inside = int(np.flatnonzero(self.begins[start:start + self.block])[units - before])
        return start + inside, int(chars) + int(self.first[start:start + inside].sum())


def arranged(text: str | None, h: tuple[int, int, int, int], shape: Shape) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    units = Units(utf8(text))
    if not text or h[2] % 100 >= shape.cut_percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return units.n, PLAIN, None, None, text
    low, high = sorted((h[0] % (units.n + 1), h[1] % (units.n + 1)))
    (a, chars_a), (b, chars_b) = units.cut(low), units.cut(high)
    prefix, middle, suffix = (part.decode("utf-8", "surrogatepass")
                              for part in (units.data[:a], units.data[a:b], units.data[b:]))
    if h[3] % 100 < shape.suffix_first_percent:
        return units.n, SPM, chars_a, chars_b - chars_a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.n, PSM, chars_a, chars_b - chars_a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def draws(doc_id: Column, shape: Shape) -> Column:
    """Four numbers of a document: the first 8-digit groups of the sha256 of `<seed>:<doc_id>`, NULL as an empty id."""
    text = F.concat(F.lit(f"{shape.seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def transformed(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output for every row of docs (doc_id, text and any others).

    A NULL or empty text has no unit and the form plain with an empty output.
    A text that contains a marker stays as it is.  Rows that share a doc_id draw the same numbers, so
    repeated rows have equal results; a row without doc_id draws those of an
    empty id.  Any part may be empty.  An empty table gives an empty one.
    """
    @F.pandas_udf(CUT)
    def arrange(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drawn in batches:
            made = pd.DataFrame([arranged(t, tuple(map(int, h)), shape) for t, h in zip(texts, drawn)],
                                columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield made.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    parts = docs.select("doc_id", arrange(F.col("text"), draws(F.col("doc_id"), shape)).alias("fim"))
    return parts.select("doc_id", "fim.*")


def restored(output: Column, form: Column) -> Column:
    """The text that was cut, from what was made of it."""
    pieces = F.split(output, "<[PSM]>")
    first, second, third = (F.get(pieces, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == PSM, F.concat(first, third, second))
            .when(form == SPM, F.concat(second, third, first)).otherwise(output))


def digests(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """`transformed` with the sha256 of the output and of the text rebuilt from it instead of the texts."""
    made = transformed(docs, shape)
    hashed = {"output_sha256": F.col("output"), "restored_sha256": restored(F.col("output"), F.col("form"))}
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       *[F.sha2(text.cast("binary"), 256).alias(name) for name, text in hashed.items()])
