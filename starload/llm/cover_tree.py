"""Near-duplicate vectors: exact threshold pairs by dual traversal of cover trees.

Vectors become unit vectors, so that a cosine is a distance.  Equal vectors of a
label form a class, and only classes are compared.  A cover tree has nested levels
whose radii halve: every point lies within the radius of a centre, centres below one
parent lie further apart than it, and a centre stays one in all levels below.  Two trees are
gone through together, and a pair of nodes is left out where the distance of
their centres is more than both covering radii and the largest distance of a link.
What is left at the leaves is compared in double precision.

Large labels are first cut by the top of such a tree: the first centres of
a farthest-first order of a bounded sample, every prefix of which is a level.  Every
vector has a home, the cell of its nearest centre.  It is also sent to the cells behind its own
in which it may have partners: those whose covering radius, measured over all
vectors, reaches it, and whose border with its home is within reach.  So every
pair meets in exactly one cell.  A cell is cut into parts of bounded size, and each
part meets each other one.

A task returns numbers of links per vector and, for the components, one star per group
that its links connect, never the pairs.  On vectors without any structure (uniform in
many dimensions) no bound on distances excludes much, and comparing stays
quadratic within a label; the parts keep it in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starload.llm.common import shared
from starload.llm.neardup import components
from starload.scratch import materialise


@dataclass(frozen=True)
class Shape:
    """Least cosine of a link; vectors of a part, sample and most cells for the top of the tree."""

    cosine: float = 0.98
    part: int = 4096
    sample: int = 4096
    cells: int = 1024

    @property
    def reach(self) -> float:
        """The distance of two unit vectors with that cosine."""
        return float(np.sqrt(max(0.0, 2 - 2 * self.cosine)))


#: More than rounding moves a distance.
SLACK = 1e-6
#: A node with so few points is a leaf; below this radius points are not told apart any more.
LEAF, SMALLEST = 48, 2.0 ** -12
#: So many rows of distances are computed together.
ROWS = 512


def distance(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosines))


@dataclass
class Node:
    """Points around a centre; `reach` is the distance of the furthest one."""

    centre: int
    reach: float
    members: np.ndarray
    children: list[Node] = field(default_factory=list)

    @property
    def is_leaf(self) -> bool:
        return not self.children


def cover(points: np.ndarray, members: np.ndarray, centre: int, radius: float) -> list[Node]:
    """Nodes of one level: the centre itself and points further than the radius from all before them."""
    owner = np.full(len(members), -1)
    cosine = points[members] @ points[centre]
    centres = [centre]
    own = distance(cosine)
    owner[own <= radius] = 0
    far = np.where(owner == 0, own, 0.0)
    rows = 8  # more at a time as long as most of them become centres
    while True:
        left, before = np.flatnonzero(owner < 0), len(centres)
        if not len(left):
            break
        first = left[:rows]
        distances = distance(points[members[first]] @ points[members[left]].T)
        free = np.ones(len(left), bool)
        for row, place in enumerate(first):
            if free[row]:
                near = free & (distances[row] <= radius)
                near[row] = True
                owner[left[near]] = len(centres)
                far[left[near]] = distances[row][near]
                free &= ~near
                centres.append(int(members[place]))
        rows = min(ROWS, 2 * rows) if 2 * (len(centres) - before) > rows else max(8, rows // 2)
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(len(centres) + 1))
    return [Node(c, float(far[order[a:b]].max()), members[order[a:b]]) for c, a, b in zip(centres, edges, edges[1:])]


def tree(points: np.ndarray) -> Node:
    """The cover tree of unit vectors (at least one)."""
    members = np.arange(len(points))
    root = Node(0, float(distance(points @ points[0]).max()), members)
    todo = [(root, 1.0)]
    while todo:
        node, radius = todo.pop()
        while radius >= node.reach and radius > SMALLEST:  # levels that would have this one node
            radius /= 2
        if len(node.members) <= LEAF or radius <= SMALLEST:
            continue
        node.children = cover(points, node.members, node.centre, radius)
        todo += [(child, radius / 2) for child in node.children]
    return root


def links(a: np.ndarray, b: np.ndarray | None, shape: Shape) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked points between a and b; without b, each pair of two points of a once."""
    if not len(a) or b is not None and not len(b):
        return
    left, same = tree(a), b is None
    points = a if same else b
    todo = [(left, left if same else tree(b))]
    while todo:
        one, other = todo.pop()
        if one.is_leaf and other.is_leaf:
            found = a[one.members] @ points[other.members].T >= shape.cosine
            if one is other and same:
                found = np.triu(found, 1)
            i, j = np.nonzero(found)
            yield one.members[i], other.members[j]
            continue
        ones, others = one.children or [one], other.children or [other]
        reach_b = np.array([n.reach for n in others]) + shape.reach + SLACK
        centres_b = points[[n.centre for n in others]]
        single_b = np.array([len(n.members) == 1 for n in others])
        centre_b = np.array([n.centre for n in others])
        for start in range(0, len(ones), ROWS):
            some = ones[start:start + ROWS]
            cosines = a[[n.centre for n in some]] @ centres_b.T
            near = distance(cosines) <= np.array([n.reach for n in some])[:, None] + reach_b
            if same and one is other:  # each pair of children once
                near &= np.arange(len(others)) >= (start + np.arange(len(some)))[:, None]
            alone = np.array([len(n.members) == 1 for n in some])[:, None] & single_b & near
            i, j = np.nonzero(alone & (cosines >= shape.cosine))
            x, y = np.array([n.centre for n in some])[i], centre_b[j]
            apart = x != y if same else np.ones(len(x), bool)
            yield x[apart], y[apart]
            todo += [(some[p], others[q]) for p, q in zip(*np.nonzero(near & ~alone))]


def gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]], least: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs in larger arrays."""
    some, size = [], 0
    for pair in pairs:
        some.append(pair)
        size += len(pair[0])
        if size >= least:
            yield tuple(map(np.concatenate, zip(*some)))
            some, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*some)))


def connect(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The roots of all places, after those of i and j are connected; a root is the smallest place of its group."""
    while True:
        while (parent != parent[parent]).any():
            parent = parent[parent]
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


FOUND = "key binary, node long, low long, n long"


def matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def compare(rows: pd.DataFrame, shape: Shape) -> pd.DataFrame:
    """Links inside a group of rows (key, node, weight, unit, is_left, is_right): of its left rows with its right rows.

    Rows that are both are compared with each other once.  Per row with links:
    their number, and the smallest node that it reaches inside the group.
    """
    left, right = rows["is_left"].to_numpy(bool), rows["is_right"].to_numpy(bool)
    points, weight = matrix(rows["unit"]), rows["weight"].to_numpy()
    both, left, right = np.flatnonzero(left & right), np.flatnonzero(left), np.flatnonzero(right & ~left)
    pairs = chain(((both[i], both[j]) for i, j in links(points[both], None, shape)),
                  ((left[i], right[j]) for i, j in links(points[left], points[right], shape)))
    by_node = np.argsort(rows["node"].to_numpy(), kind="stable")
    place = np.argsort(by_node)
    number, parent = np.zeros(len(rows)), np.arange(len(rows))
    for i, j in gathered(pairs):
        number += np.bincount(i, weight[j], len(rows)) + np.bincount(j, weight[i], len(rows))
        parent = connect(parent, place[i], place[j])
    has = np.flatnonzero(number)
    node = rows["node"].to_numpy()
    return pd.DataFrame({"key": rows["key"].to_numpy()[has], "node": node[has], "low": node[by_node[parent[place[has]]]],
                         "n": number[has].astype(np.int64)})


def unit(vector: Column, label: Column) -> Column:
    """key (128-bit, of label and direction), unit vector as bytes and its dimensions; NULL if it links with nothing."""
    @F.pandas_udf("key binary, unit binary, dims int")
    def scaled(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for vectors, labels in batches:
            rows = []
            for v, label in zip(vectors, labels):
                x = np.zeros(0) if v is None or label is None else np.asarray(v, np.float64)
                if not len(x) or not np.isfinite(x).all() or not x.any():
                    rows.append((None, None, None))
                    continue
                x = x / np.abs(x).max()  # so that squares neither overflow nor vanish
                data = (x / np.sqrt(x @ x) + 0.0).tobytes()
                rows.append((xxhash.xxh3_128_digest(f"{label}:".encode() + data), data, len(x)))
            yield pd.DataFrame(rows, columns=["key", "unit", "dims"]).astype({"dims": "Int32"})
    return scaled(vector, label.cast("string"))


def top_centres(sample: np.ndarray, number: int) -> np.ndarray:
    """The first centres in farthest-first order of a sample of unit vectors."""
    chosen, away = [0], distance(sample @ sample[0])
    while len(chosen) < min(number, len(sample)) and away.max() > SLACK:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distance(sample @ sample[chosen[-1]]))
    return sample[chosen]


def _homes(classes: DataFrame, large: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """classes with home, the place of their nearest centre, and `away`, its distance; 0 in a label that is not cut."""
    known = shared(classes.sparkSession, centres)

    @F.pandas_udf("home int, away double")
    def nearest(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        tops = known()
        for units, dims, cut in batches:
            home, away = np.zeros(len(units), np.int32), np.full(len(units), np.nan)
            for size in dims.unique():
                here = np.flatnonzero(((dims == size) & cut).to_numpy(bool))
                if size in tops and len(here):
                    cosines = matrix(units.iloc[here]) @ tops[size].T
                    home[here] = cosines.argmax(axis=1)
                    away[here] = distance(cosines.max(axis=1))
            yield pd.DataFrame({"home": home, "away": away})

    marked = classes.join(large.withColumn("cut", F.lit(True)), ["label", "dims"], "left")
    marked = marked.withColumn("cut", F.coalesce("cut", F.lit(False)))
    return marked.withColumn("h", nearest("unit", "dims", "cut")).select("*", "h.home", "h.away").drop("h")


def _guests(homes: DataFrame, centres: dict[int, np.ndarray], reaches: dict[int, np.ndarray], shape: Shape) -> Column:
    """The cells behind the own one in which a vector may have partners.

    A link moves a vector by at most the reach t.  A partner at home in b is no
    nearer to a than to b, so the vector is at most t from the border of a and
    b: x.a - x.b <= t * |a - b|; and it is at most t outside the ball of b.
    """
    known = shared(homes.sparkSession, (centres, reaches))

    @F.pandas_udf("array<int>")
    def behind(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        tops, balls = known()
        between = {size: distance(c @ c.T) for size, c in tops.items()}
        for units, dims, home, cut in batches:
            found: list = [[] for _ in range(len(units))]
            for size in dims.unique():
                here = np.flatnonzero(((dims == size) & cut).to_numpy(bool))
                if size not in tops or not len(here):
                    continue
                cosines, own = matrix(units.iloc[here]) @ tops[size].T, home.to_numpy()[here]
                border = cosines[np.arange(len(here)), own][:, None] - cosines <= shape.reach * between[size][own] + SLACK
                ball = distance(cosines) <= balls[size] + shape.reach + SLACK
                later = np.arange(len(tops[size])) > own[:, None]
                for place, row in zip(here, border & ball & later):
                    found[place] = np.flatnonzero(row).tolist()
            yield pd.Series(found)
    return behind("unit", "dims", "home", "cut")


def _placed(classes: DataFrame, shape: Shape) -> DataFrame:
    """classes, each in every cell in which it is compared (cell, at_home)."""
    large = materialise(classes.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("size"))
                        .where(F.col("size") > shape.part), "large-labels")
    number = large.groupBy("dims").agg(F.max("size").alias("size"))
    sampled = (classes.join(large.drop("size"), ["label", "dims"], "left_semi")
               .orderBy(F.xxhash64("key"), "key").limit(shape.sample).select("dims", "unit").toPandas())
    wanted = {int(r.dims): int(r["size"]) for r in number.orderBy(F.desc("size")).limit(shape.sample).collect()}
    centres = {size: top_centres(matrix(own["unit"]), min(shape.cells, -(-wanted.get(size, 1) // shape.part)))
               for size, own in sampled.groupby("dims")}
    if not centres:
        return classes.withColumn("cell", F.lit(0)).withColumn("at_home", F.lit(True))
    homes = materialise(_homes(classes, large.drop("size"), centres), "homes")
    furthest = homes.where("cut").groupBy("dims", "home").agg(F.max("away").alias("reach"))
    reaches = {size: np.full(len(c), -np.inf) for size, c in centres.items()}
    for row in furthest.where(F.col("reach").isNotNull()).collect():  # one row per centre
        reaches[row.dims][row.home] = row.reach
    cells = F.transform(_guests(homes, centres, reaches, shape), lambda c: F.struct(c.alias("cell"), F.lit(False).alias("at_home")))
    own = F.array(F.struct(F.col("home").alias("cell"), F.lit(True).alias("at_home")))
    return (materialise(homes.withColumn("cells", F.concat(own, cells)), "guests")
            .select(*classes.columns, F.explode("cells").alias("c")).select(*classes.columns, "c.cell", "c.at_home"))


def _groups(placed: DataFrame, shape: Shape) -> DataFrame:
    """Rows per pair of parts (one, other) of a cell: parts at home with each other, and with those of guests."""
    cell = ["label", "dims", "cell"]
    sizes = placed.groupBy(cell).agg(F.count_if("at_home").alias("own"), F.count_if(~F.col("at_home")).alias("guests"))
    large = sizes.where(F.greatest("own", "guests") > shape.part).select(
        *cell, F.greatest(F.lit(1), F.ceil(F.col("own") / shape.part)).cast("int").alias("homes"),
        F.greatest(F.lit(1), F.ceil(F.col("guests") / shape.part)).cast("int").alias("visits"))
    cut = placed.join(large, cell, "left").withColumns({k: F.coalesce(k, F.lit(1)) for k in ("homes", "visits")})
    number = F.xxhash64("key")
    part = F.when(F.col("at_home"), F.pmod(number, "homes")).otherwise(F.pmod(number, "visits")).cast("int")
    cut = cut.withColumn("part", part)

    def group(one: Column, other: Column) -> Column:
        return F.struct(one.cast("int").alias("one"), other.cast("int").alias("other"))

    part, homes = F.col("part"), F.col("homes")
    last = homes + F.col("visits") - 2
    before = F.transform(F.sequence(F.lit(0), part), lambda p: group(p, part))
    after = F.when(part < last, F.transform(F.sequence(part + 1, last), lambda p: group(part, p))).otherwise(F.array())
    # The first part of the guests comes to the groups in which a part at home meets itself.
    visited = F.transform(F.sequence(F.lit(0), homes - 1),
                          lambda p: group(p, F.when(part == 0, p).otherwise(homes + part - 1)))
    every = F.when(F.col("at_home"), F.concat(before, after)).otherwise(visited)
    one, other = F.col("g.one"), F.col("g.other")
    return cut.select(*placed.columns, "part", F.explode(every).alias("g")).select(
        *placed.columns, one.alias("one"), other.alias("other"), (F.col("at_home") & (F.col("part") == one)).alias("is_left"),
        (~F.col("at_home") | (F.col("part") == other)).alias("is_right"))


def _shared_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of a vec_id that came with several vectors."""
    several = (rows.groupBy("vec_id").agg(F.min("key").alias("least"), F.max("key").alias("most"))
               .where("least <> most").select("vec_id"))
    return (rows.join(several, "vec_id", "left_semi").join(classes.select("key", "node"), "key")
            .select(F.col("vec_id").alias("a"), F.col("node").alias("b")).distinct())


def near_duplicates(vectors: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors (vec_id, embedding, label and any others).

    n_links counts other rows linked directly: same label, cosine at least that
    of the shape.  component_id is the smallest vec_id that links reach, the own
    one included.  A vector that is NULL, empty, zero or has a NULL or
    non-finite component, or no label, links with nothing, as do vectors of different length.  A
    row without vec_id cannot be named by others: it links with nothing,
    its component_id is NULL and it is kept.  Rows that share a vec_id count one by one in
    n_links and are one vector in a component.  An empty table gives an empty one.
    """
    rows = materialise(vectors.select("vec_id", F.col("label").cast("string").alias("label"),
                                      unit(F.col("embedding"), F.col("label")).alias("u"))
                       .select("vec_id", "label", "u.*")
                       .withColumn("key", F.when(F.col("vec_id").isNotNull(), F.col("key"))), "unit-vectors")
    named = rows.where("key IS NOT NULL")
    classes = materialise(named.groupBy("key", "label", "dims").agg(
        F.min("vec_id").cast("long").alias("node"), F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit")), "classes")

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        return compare(rows, shape)

    groups = _groups(_placed(classes, shape), shape)
    found = materialise(groups.groupBy("label", "dims", "cell", "one", "other").applyInPandas(look, FOUND), "links")
    numbers = found.groupBy("key").agg(F.sum("n").alias("n"))
    known = components(found.select(F.col("node").alias("a"), F.col("low").alias("b"))
                       .union(_shared_ids(named.select("vec_id", "key"), classes)))
    placed = (classes.select("key", "node", "weight").join(numbers, "key", "left").join(known, "node", "left")
              .select("key", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                      F.coalesce("component", "node").alias("component_id")))
    return (rows.select("vec_id", "key").join(placed, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", F.col("vec_id").cast("long")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
