"""Mixing sources to target weights by words taken.

Targets come from weights, capped at a multiple of what a source has.  A target
is a number of whole passes over the source and a remaining budget.  For the
budget, documents are counted by exact length.  Every length gives its even
share of whole documents; of what is then missing, more documents
are taken from the longest on, down to a reserve of RESERVE times the longest
length; and the last words are a subset-sum problem over the documents that are
left, solved exactly by dynamic programming over their lengths and counts.  Which
documents of a length are taken is decided by a seeded hash.

Documents meet in groups of one source and length, and such a group (a third of
all rows, if they are copies) is cut by ranges of the hash: only the range in
which the last taken document lies is put in order, its equal rows as one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starload.llm.common import spark_words
from starload.local import small_frame
from starload.scratch import materialise

#: Fixed values of the contract: weights by rank of the source, share of all words, most passes.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_PASSES = 2
#: So many times the longest length are left to the exact fit.
RESERVE = 4
#: A source and length is cut into 2**RANGE_BITS ranges of the seeded hash.
RANGE_BITS = 10
SEED = 11


def targets(sources: Sequence[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most_passes: float = MOST_PASSES) -> list[tuple[str | None, float]]:
    """(source, target) in order: by code point, NULL last.  Weights repeat; what is above a cap is shared again.

    The total is `share` of all words, or less where all caps together are less.
    """
    ordered = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
    weight = [weights[i % len(weights)] for i in range(len(ordered))]
    cap = [most_passes * words for _, words in ordered]
    budget = share * sum(words for _, words in ordered)
    open_, target = list(range(len(ordered))), [0.0] * len(ordered)
    while open_:
        unit = budget / sum(weight[i] for i in open_)
        above = [i for i in open_ if weight[i] * unit > cap[i]]
        if not above:
            for i in open_:
                target[i] = weight[i] * unit
            break
        for i in above:
            target[i] = float(cap[i])
            budget -= cap[i]
        open_ = [i for i in open_ if i not in above]
    return [(source, target[i]) for i, (source, _) in enumerate(ordered)]


def fit_lengths(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many of each length to take so that the sum is as large as possible without passing the budget.

    A bounded knapsack: for every length the reachable sums are extended by 1, 2,
    4, ... documents, until the budget itself is reached.  A sum keeps the step
    that reached it first; going back from the best sum gives the numbers.
    """
    taken = [0] * len(lengths)
    usable = [(i, int(n), int(c)) for i, (n, c) in enumerate(zip(lengths, counts)) if 0 < n <= budget and c > 0]
    if not usable:
        return taken
    unit = math.gcd(*(n for _, n, _ in usable))
    budget = budget // unit
    first = np.full(budget + 1, -1, np.int32)
    reach = np.zeros(budget + 1, dtype=bool)
    reach[0] = True
    steps: list[tuple[int, int, int]] = []  # index, number, sum
    for i, length, count in usable:
        rest, number = min(count, budget * unit // length), 1
        while rest and not reach[budget]:
            number = min(number, rest)
            more = length // unit * number
            if more <= budget:
                new = more + np.flatnonzero(reach[:budget + 1 - more] & ~reach[more:])
                first[new] = len(steps)
                reach[new] = True
                steps.append((i, number, more))
            rest -= number
            number *= 2
    at = int(np.flatnonzero(reach)[-1])
    while at:
        i, number, more = steps[first[at]]
        taken[i] += number
        at -= more
    return taken


def quotas_of(sizes: Sequence[int], documents: Sequence[int], budget: int) -> list[int]:
    """How many documents of each length come nearest to the budget from below.  Sizes are distinct.

    What the fit does not bring to the budget is tried once more after some of
    the documents chosen before it are given back, one per length in turn; a
    budget of no more than the reserve is fitted exactly over all documents.
    """
    order = sorted((i for i in range(len(sizes)) if sizes[i] > 0 and documents[i] > 0), key=lambda i: -sizes[i])
    words = sum(sizes[i] * documents[i] for i in order)
    taken = [0] * len(sizes)
    if not words:
        return taken
    reserve = RESERVE * sizes[order[0]]
    for i in order:
        taken[i] = documents[i] * budget // words
    missing = budget - sum(sizes[i] * taken[i] for i in order)
    for i in order:
        more = min(documents[i] - taken[i], max(0, missing - reserve) // sizes[i])
        taken[i] += more
        missing -= more * sizes[i]

    def fitted() -> list[int]:
        return [t + m for t, m in zip(taken, fit_lengths(sizes, [d - t for d, t in zip(documents, taken)], missing))]
    result = fitted()
    if sum(sizes[i] * result[i] for i in order) == budget or missing >= budget:
        return result
    while missing < reserve and any(taken):
        for i in order:
            if taken[i] and missing < reserve:
                taken[i] -= 1
                missing += sizes[i]
    return fitted()


def _quotas(planned: DataFrame) -> DataFrame:
    """(_source, _size, quota): one group per source, a row per length that its documents have."""
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        quota = quotas_of(group["_size"].tolist(), group["documents"].tolist(), int(group["budget"].iloc[0]))
        return pd.DataFrame({"_source": group["_source"], "_size": group["_size"], "quota": quota})
    return (planned.where("budget > 0").groupBy("_source")
            .applyInPandas(fit, "_source string, _size long, quota long"))


def decisions(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
              most_passes: int = MOST_PASSES, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """What the mix takes, as a rule per source and length: (sized, rules).

    sized: (doc_id, _source, _size, _order) of every row.  rules: a row per source
    and length with source_size, target, whole passes, and the seeded hash up to
    which documents are taken once more (NULL: none); of the last_rows rows that
    have this hash itself, last_take are.  One row per source comes to the
    driver, where the caps are shared out.
    """
    spark = docs.sparkSession
    sized = materialise(docs.select("doc_id", *_keys(docs, seed)), "sizes")
    lengths = materialise(sized.groupBy("_source", "_size").agg(F.count(F.lit(1)).alias("documents")), "lengths")
    sources = lengths.groupBy("_source").agg(F.sum(F.col("_size") * F.col("documents")).alias("words")).collect()
    words = {row["_source"]: row["words"] for row in sources}
    plan_rows = []
    for source, target in targets([tuple(row) for row in sources], weights, share, most_passes):
        passes = min(most_passes, int(target // words[source])) if words[source] else 0
        budget = max(0, math.floor(target - passes * words[source]))
        plan_rows.append((source, words[source], target, passes, budget))
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("_plan_source", T.StringType()), ("source_size", T.LongType()), ("target", T.DoubleType()),
        ("passes", T.IntegerType()), ("budget", T.LongType()))])
    plan = F.broadcast(small_frame(spark, plan_rows, schema))
    planned = lengths.join(plan, lengths["_source"].eqNullSafe(plan["_plan_source"])).drop("_plan_source")
    quota = materialise(_quotas(planned), "quotas")

    same = [sized["_source"].eqNullSafe(quota["_source"]), sized["_size"] == quota["_size"]]
    open_ = sized.join(quota.where("quota > 0"), same).select(
        sized["_source"], sized["_size"], "_order", "quota",
        F.shiftrightunsigned("_order", 64 - RANGE_BITS).cast("int").alias("range"),
        F.col("_order").bitwiseXOR(F.lit(-(1 << 63))).alias("signed"))  # so that signed order is the order of ranges
    group = ["_source", "_size"]
    ranges = open_.groupBy(*group, "quota", "range").agg(F.count(F.lit(1)).alias("rows"))
    upto = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    last = (ranges.withColumn("upto", F.sum("rows").over(upto)).where("upto >= quota AND upto - rows < quota")
            .select(F.col("_source").alias("s"), F.col("_size").alias("z"), F.col("range").alias("r"),
                    (F.col("quota") - F.col("upto") + F.col("rows")).alias("in_range")))
    inside = Window.partitionBy(*group).orderBy("signed").rowsBetween(Window.unboundedPreceding, 0)
    # Rows that are equal in doc_id and text have one hash: they are counted, and the last of them taken by number.
    border = (open_.join(last, open_["_source"].eqNullSafe(last["s"]) & (open_["_size"] == last["z"])
                         & (open_["range"] == last["r"]))
              .groupBy(*group, "signed", "in_range").agg(F.count(F.lit(1)).alias("last_rows"))
              .withColumn("upto", F.sum("last_rows").over(inside)).where("upto >= in_range AND upto - last_rows < in_range")
              .select(F.col("_source").alias("s"), F.col("_size").alias("z"), F.col("signed").alias("last_order"), "last_rows",
                      (F.col("in_range") - F.col("upto") + F.col("last_rows")).alias("last_take")))
    rules = planned.join(border, planned["_source"].eqNullSafe(border["s"]) & (planned["_size"] == border["z"]), "left")
    return sized, materialise(rules.select(F.col("_source").alias("_rule_source"), F.col("_size").alias("_rule_size"),
                                           "source_size", "target", "passes", "last_order", "last_rows", "last_take"), "rules")


def _keys(docs: DataFrame, seed: int) -> list[Column]:
    return [docs["source"].alias("_source"), F.size(spark_words(docs["text"])).cast("long").alias("_size"),
            F.xxhash64(docs["doc_id"], docs["text"], F.lit(seed)).alias("_order")]


def _with_copies(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows with `_copies`.  Of the rows that share the last hash, a number is taken: counted per partition, then within."""
    signed = F.col("_order").bitwiseXOR(F.lit(-(1 << 63)))
    split = rules.where("last_take < last_rows")
    cut = not split.isEmpty()
    numbered = rows.withColumn("_part", F.spark_partition_id()) if cut else rows
    joined = numbered.join(rules, rows["_source"].eqNullSafe(rules["_rule_source"]) & (rows["_size"] == rules["_rule_size"]))
    taken = F.coalesce(signed <= F.col("last_order"), F.lit(False)).cast("int")
    if not cut:
        return joined.withColumn("_copies", F.col("passes") + taken)
    tied = F.coalesce((signed == F.col("last_order")) & F.expr("last_take < last_rows"), F.lit(False))
    whole = joined.where(~tied).withColumn("_copies", F.col("passes") + taken)
    same = materialise(joined.where(tied), "tied")
    upto = Window.partitionBy("s", "z").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    before = (same.groupBy(F.col("_source").alias("s"), F.col("_size").alias("z"), F.col("_part").alias("p"))
              .agg(F.count(F.lit(1)).alias("n")).withColumn("_before", F.sum("n").over(upto) - F.col("n")).drop("n"))
    place = F.row_number().over(Window.partitionBy("_source", "_size", "_part").orderBy("_order"))
    part = (same.withColumn("_place", place)
            .join(before, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_size") == F.col("z")) & (F.col("_part") == F.col("p")))
            .withColumn("_copies", F.col("passes") + (F.col("_before") + F.col("_place") <= F.col("last_take")).cast("int")))
    return whole.unionByName(part.select(whole.columns))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken for every row of docs (doc_id, text, source and any others).

    size is the number of words, 0 for a NULL or empty text; copies is how often
    the mix has the document, taken is size * copies.  A NULL source is a source
    of its own, the last one.  Documents without words have the whole passes of
    their source.  Rows that share a doc_id are told apart by their text; of rows
    that are equal in both, the quota takes a number, no matter which.  An empty
    table gives an empty one.
    """
    sized, rules = decisions(docs, **options)
    return _with_copies(sized, rules).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", F.col("_copies").alias("copies"),
        (F.col("_size") * F.col("_copies")).alias("taken"))


def mixed(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The rows of the mix: each row of docs as often as `mix` says, with the columns of docs."""
    _, rules = decisions(docs, seed=seed, **options)
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_keys(docs, seed))
    chosen = _with_copies(rows, rules).where("_copies > 0")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")
