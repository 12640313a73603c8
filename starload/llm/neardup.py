"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

A document is the set of its distinct word shingles.  Equal sets form a class,
and only one document per class goes on.  One hash of every shingle is cut into
equal ranges, the smallest value of a range is one position of the signature,
and an empty range borrows from the ranges in an order of its own (optimal
densification).  Bands of the signature are buckets.

In a bucket every member is paired with one centre and confirmed on full sets.
That is not all of it: members that are not linked with the centre may be linked
with each other.  So centres leave the bucket and, while a bucket still holds
documents of more than one component, members outside its largest component
become the next centres, paired with the members of other components.  The
pairs of a round are bounded by the members of open buckets, and the end result
is the one of all pairs that share a bucket.

Recall: with 42 bands of 6 rows two sets of similarity 0.8 share no bucket with
probability (1 - 0.8**6)**42, three in a million.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from starload.llm.common import mix, words_of
from starload.operators.keys import number_rows
from starload.scratch import materialise

#: How many centres a bucket has in a round after the first.
CENTRES_AT_ONCE = 64
#: A shingle that at most so many open documents have is rare.
RARE = 128
SIGNATURE = "n_shingles long, set_key binary, bands array<long>"


@dataclass(frozen=True)
class Shape:
    """Words per shingle, the least similarity in per cent, and the cut of the signature."""

    words: int = 5
    percent: int = 80
    bands: int = 42
    rows: int = 6
    seed: int = 20_240_229


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; one for all words where there are fewer than `size`."""
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words_of(text, lower=True)), dtype=np.uint64)
    if not len(hashed):
        return hashed
    width = min(size, len(hashed))
    count = len(hashed) - width + 1
    joined = mix(hashed[:count] + np.uint64(width))
    for i in range(1, width):
        joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + hashed[i:i + count])
    return np.unique(joined)


class Signer:
    """Signatures and band keys of one shape."""

    def __init__(self, shape: Shape):
        self.shape = shape
        size = shape.bands * shape.rows
        self.edges = np.array([(i << 64) // size for i in range(size)], dtype=np.uint64)
        random = np.random.default_rng(shape.seed)
        self.borrow = np.array([random.permutation(size) for _ in range(size)], dtype=np.int32)
        self.band_seeds = random.integers(1, 1 << 62, shape.bands).astype(np.uint64)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        first = np.searchsorted(hashes, self.edges)
        filled = first < np.append(first[1:], len(hashes))
        empty = np.flatnonzero(~filled)
        source = np.arange(len(first))
        if len(empty):
            lenders = self.borrow[empty]
            source[empty] = lenders[np.arange(len(empty)), filled[lenders].argmax(axis=1)]
        return hashes[first[source]]

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        cut = self.signature(hashes).reshape(self.shape.bands, self.shape.rows)
        key = self.band_seeds
        for i in range(self.shape.rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, i])
        return key.view(np.int64)


def signed(text: Column, shape: Shape) -> Column:
    """n_shingles, a 128-bit key of the set and its band keys (both NULL for an empty set)."""
    @F.pandas_udf(SIGNATURE)
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        signer = Signer(shape)
        for texts in batches:
            rows = []
            for one in texts:
                found = shingles(one, shape.words)
                rows.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), signer.bands(found))
                            if len(found) else (0, None, None))
            yield pd.DataFrame(rows, columns=["n_shingles", "set_key", "bands"])
    return sign(text)


def linked(left: Column, right: Column, shape: Shape) -> Column:
    """Whether the full shingle sets of two texts reach the similarity."""
    @F.pandas_udf("boolean")
    def confirm(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        last, known = None, None  # pairs of one centre come one after another
        for ones, others in batches:
            answers = []
            for one, other in zip(ones, others):
                if known is None or other != last:
                    last, known = other, shingles(other, shape.words)
                mine = shingles(one, shape.words)
                both = len(np.intersect1d(mine, known, assume_unique=True))
                answers.append(both > 0 and 100 * both >= shape.percent * (len(mine) + len(known) - both))
            yield pd.Series(answers, dtype=bool)
    return confirm(left, right)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b): the smallest node that can be reached.

    Every node hooks to its smallest neighbour, edges are rewritten to the
    parents, and what is left between different parents goes into the next
    round.  Each round at least halves what can still move.
    """
    edges = links.where("a <> b").select("a", "b")
    parents = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("parent"))
                            .select(F.col("a").alias("node"), "parent"), "hooks")
        if parents is None:
            parents = hooks
        else:
            moved = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("to"))
            parents = materialise(parents.join(moved, "parent", "left")
                                  .select("node", F.coalesce("to", "parent").alias("parent")), "parents")
        to_a = hooks.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        to_b = hooks.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = materialise(edges.join(to_a, "a").join(to_b, "b").where("pa <> pb")
                            .select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b")).distinct(),
                            "edges")
        if edges.isEmpty():
            return parents.select("node", F.col("parent").alias("component"))


def _rare_shingles(texts: DataFrame, nodes: DataFrame, shape: Shape) -> DataFrame:
    """(hash, node): the shingles that at most RARE rows of `nodes` have."""
    @F.pandas_udf("array<long>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingles(one, shape.words).view(np.int64) for one in batch])

    here = texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    found = materialise(here.select(F.col("doc_id").alias("node"), F.explode(hashes(F.col("text"))).alias("hash")),
                        "open-shingles")
    rare = found.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") <= RARE).select("hash")
    return materialise(found.join(rare, "hash"), "rare-shingles")


def _shareable(rest: DataFrame, texts: DataFrame, rare: DataFrame) -> DataFrame:
    """rest with `shared`: the shingles of a node that are not rare.  A doc_id with several texts keeps all of them."""
    once = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows = 1")
    own = (rare.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
           .join(once.select(F.col("doc_id").alias("node")), "node", "left_semi"))
    return rest.join(own, "node", "left").withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")


def _open(rest: DataFrame) -> DataFrame:
    """The rows of buckets with several components; minor: outside the largest component of the bucket."""
    sizes = rest.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = (sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("c"),
                                        F.count(F.lit(1)).alias("components"))
               .where("components > 1").select("key", F.col("c.component").alias("largest")))
    return (rest.join(largest, "key").withColumn("minor", F.col("component") != F.col("largest")).drop("largest"))


def _connected(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows (key, node, n, shared) with the component of their node."""
    return (rows.select("key", "node", "n", "shared").join(components(links), "node", "left")
            .withColumn("component", F.coalesce("component", "node")))


def confirmed_links(docs: DataFrame, members: DataFrame, shape: Shape) -> DataFrame:
    """(a, b): links enough to connect all nodes that are linked and share one of the buckets (key, node, n).

    The first centre of a bucket is its smallest node.  Members of open buckets
    that share a rare shingle are paired next; a shingle is rare if few open
    documents have it, so these pairs are bounded by the shingles.  From then on
    rare shingles are known not to be shared between the pairs that are left.
    That bounds their similarity exactly, and only pairs whose bound reaches it
    are made, in stars around members outside the largest component of a bucket.
    """
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    texts = materialise(docs.select("doc_id", "text").join(nodes, "doc_id", "left_semi"), "candidate-texts")
    mine = texts.select(F.col("doc_id").alias("node"), F.col("text").alias("mine"))
    other = texts.select(F.col("doc_id").alias("centre"), F.col("text").alias("other"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        return materialise(
            pairs.join(mine, "node").join(other, "centre")
            .where(linked(F.col("mine"), F.col("other"), shape))
            .select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct(), "links")

    sizes_fit = 100 * F.least("n", "centre_n") >= shape.percent * F.greatest("n", "centre_n")
    first = members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("c"))
    first = first.select("key", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n"))
    stars = members.join(first, "key").where("node <> centre")
    links = confirmed(stars.where(sizes_fit).select("node", "centre").distinct())
    rest = _connected(stars.withColumn("shared", F.col("n")), links)
    left = materialise(_open(rest).drop("minor"), "open-buckets")
    if left.isEmpty():
        return links

    open_nodes = left.select("node", "n", "component").distinct()
    rare = _rare_shingles(texts, open_nodes.select("node").distinct(), shape)
    sharing = rare.join(open_nodes, "node")
    centres = sharing.select("hash", F.col("node").alias("centre"), F.col("n").alias("centre_n"),
                             F.col("component").alias("own"))
    links = links.union(confirmed(
        sharing.join(centres, "hash").where("component <> own AND node < centre").where(sizes_fit)
        .select("node", "centre").distinct()))
    left = _shareable(left.drop("shared"), texts, rare).where(100 * F.col("shared") >= shape.percent * F.col("n"))
    left = materialise(_open(_connected(left, links)), "open-buckets")

    in_bucket = Window.partitionBy("key").orderBy(F.xxhash64("node"), "node")
    most_shared = F.least("shared", "centre_shared")
    while not left.isEmpty():
        chosen = (left.where("minor").withColumn("place", F.row_number().over(in_bucket))
                  .where(F.col("place") <= CENTRES_AT_ONCE))
        chosen = materialise(chosen.select(
            "key", F.col("node").alias("centre"), F.col("n").alias("centre_n"),
            F.col("shared").alias("centre_shared"), F.col("component").alias("own")), "centres")
        pairs = (left.join(chosen, "key").where("component <> own")
                 .where(100 * most_shared >= shape.percent * (F.col("n") + F.col("centre_n") - most_shared))
                 .select("node", "centre").distinct())
        links = links.union(confirmed(pairs))
        done = chosen.select("key", F.col("centre").alias("node"))
        left = materialise(_open(_connected(left.join(done, ["key", "node"], "left_anti"), links)), "open-buckets")
    return links


def _of_one_id(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of a doc_id that came with several texts."""
    key = F.xxhash64("set_key")
    several = (named.groupBy("doc_id").agg(F.min(key).alias("least"), F.max(key).alias("most"))
               .where("least <> most").select("doc_id"))
    places = named.join(several, "doc_id", "left_semi").join(classes, "set_key").select("doc_id", "node")
    first = places.groupBy("doc_id").agg(F.min("node").alias("first"))
    return (places.join(first, "doc_id").where("node <> first")
            .select(F.col("node").alias("a"), F.col("first").alias("b")).distinct())


def near_duplicates(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id, text and any others).

    component_id is the smallest doc_id that can be reached over links, the own
    one included; kept marks the document that carries it.  A text that is NULL
    or has no words has the empty set and is linked with nothing.  A row without
    doc_id cannot be named by others: it is linked with nothing, its
    component_id is NULL and it is kept.  Rows that share a doc_id are one
    document, linked where any of its rows is.  An empty table gives an empty one.
    """
    rows = materialise(docs.select("doc_id", signed(F.col("text"), shape).alias("s")).select("doc_id", "s.*"), "signed")
    named = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    nodes = named.join(classes, (named.set_key == classes.set_key) & (named.doc_id == classes.node), "left_semi")
    banded = nodes.select(F.col("doc_id").alias("node"), F.col("n_shingles").cast("int").alias("n"),
                          F.explode("bands").alias("key"))
    shared = (banded.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
              .where("least < most").select("key"))
    members = materialise(banded.join(shared, "key", "left_semi").distinct(), "buckets")
    links = materialise(_of_one_id(named, classes), "links")
    if not members.isEmpty():
        links = links.union(confirmed_links(docs, members, shape))
    known = components(links)
    placed = classes.join(known, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component"))
    return (rows.join(placed, "set_key", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """One row of docs of every group of near copies: the one with the smallest doc_id, then the smallest hash of its text.

    Every row is a document of its own here, whatever its doc_id: of repeated
    rows one stays, and one without doc_id stays only if its group has no row
    with one.  Rows without words are near copies of nothing and all stay.
    """
    unclear = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        gone = near_duplicates(docs, shape).where("NOT kept").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    # Rows are numbered in the order in which they are preferred, and the numbers are the ids that are compared.
    place = "_place"
    while place in docs.columns:
        place = f"_{place}"
    rows = materialise(docs.withColumn(place, F.monotonically_increasing_id()), "rows")
    order = rows.select(F.col(place).alias("place"), "doc_id", F.sha2("text", 256).alias("text"))
    numbers = materialise(number_rows(order, ["doc_id", "text", "place"], "number", unique=True).select("place", "number"), "numbers")
    renamed = rows.join(numbers, rows[place] == numbers["place"]).select(F.col("number").alias("doc_id"), "text")
    gone = near_duplicates(renamed, shape).where("NOT kept").select(F.col("doc_id").alias("number"))
    lost = numbers.join(gone, "number").select(F.col("place").alias(place))
    return rows.join(lost, place, "left_anti").select(docs.columns)
