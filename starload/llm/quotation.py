"""Quotation linking in conversations, in SQL functions only.

A line's quote level is the number of `>` marks that it begins with.  Lines of
one level that follow each other are a passage.  Passages, and their single
lines, are normalised (marks and outer blanks away, lower case, runs of blanks
as one) and hashed; so are the own lines of every message, its own blocks and
its whole own text.  A quoted passage is joined to the latest earlier message of
its conversation that has a unit with the same hash.  A message replies to the
one that it quotes most of at its lowest quote level; one of which it quotes
nothing but short units only if there is no other.  Following replies upwards
gives the message that a thread began with, and conversations in the order of
(thread, turn) have every reply after its original and before later threads.

A conversation or a text that fills a large part of the table is cut into slices
of its turns; replies are followed by doubling, so depth costs its logarithm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starload.operators.skew import Scan, keyed_scan, slice_hot_keys
from starload.scratch import materialise

#: One class without a group: a repeated group would take one call per mark.
MARKS = r"^[\s>]*>\s?"
#: Among several originals, one with a unit of so many characters goes before those with shorter ones (a greeting, "ok").
LONG_CHARACTERS = 12


def lines_of(text: Column) -> Column:
    """(level, body) of every line of a text."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")
    return F.transform(lines, lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), r"[^>]", "")).alias("level"),
        F.regexp_replace(line, MARKS, "").alias("body")))


def passages_of(lines: Column) -> Column:
    """(level, lines) of every maximal run of lines of one level."""
    numbers = F.sequence(F.lit(1), F.size(lines))
    starts = F.filter(numbers, lambda i: (i == 1) | (F.element_at(lines, i)["level"] != F.element_at(
        lines, F.greatest(i - 1, F.lit(1)))["level"]))
    stops = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(lines) + 1))
    return F.zip_with(starts, stops, lambda a, b: F.struct(
        F.element_at(lines, a)["level"].alias("level"),
        F.transform(F.slice(lines, a, b - a), lambda line: line["body"]).alias("lines")))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _units(lines: Column) -> Column:
    """The lines of a passage and the passage as a whole."""
    return F.concat(lines, F.array(F.array_join(lines, " ")))


def _hashed(rows: DataFrame, units: Column, *keep: str | Column) -> DataFrame:
    unit = rows.select(*keep, F.explode(units).alias("unit")).withColumn("unit", normalised(F.col("unit")))
    return (unit.where(F.length("unit") > 0)
            .withColumn("hash", F.xxhash64("unit")).withColumn("more", F.xxhash64("unit", F.lit(1)))
            .withColumn("characters", F.length("unit")).drop("unit"))


def parsed(messages: DataFrame) -> DataFrame:
    """messages with `_passages`, `_own` (their own lines) and `own_text`."""
    with_lines = messages.withColumn("_lines", lines_of(F.col("text")))
    own = F.transform(F.filter("_lines", lambda line: line["level"] == 0), lambda line: line["body"])
    return (with_lines.withColumn("_passages", passages_of(F.col("_lines"))).withColumn("_own", own)
            .withColumn("own_text", F.when(F.col("text").isNotNull(), F.trim(F.array_join("_own", "\n"), F.lit("\n ")))))


def replies(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, linked): the turn that a message answers, and how many of its quoted units were found."""
    rows = parsed(messages.select("conv_id", "turn", "text").where("conv_id IS NOT NULL AND turn IS NOT NULL"))
    quoted = rows.select("conv_id", "turn", F.explode(F.filter("_passages", lambda p: p["level"] > 0)).alias("p"))
    quotes = _hashed(quoted, _units(F.col("p.lines")), "conv_id", "turn", F.col("p.level").alias("level"))
    quotes = materialise(quotes.groupBy("conv_id", "turn", "hash", "more").agg(
        F.min("level").alias("level"), F.max("characters").alias("characters")), "quotes")
    blocks = F.flatten(F.transform(F.filter("_passages", lambda p: p["level"] == 0), lambda p: _units(p["lines"])))
    own = _hashed(rows.where("exists(_passages, p -> p.level = 0)"), F.concat(blocks, F.array(F.col("own_text"))),
                  "conv_id", "turn").drop("characters").distinct()
    wanted = quotes.select("conv_id", "hash", "more").distinct()
    originals = own.join(wanted, ["conv_id", "hash", "more"], "left_semi")

    # In the order of turns, a quote comes before an original of the same turn: nothing quotes itself.
    both = (quotes.withColumn("kind", F.lit(0)).withColumn("original", F.lit(None).cast("long"))
            .unionByName(originals.select("conv_id", "turn", "hash", "more", F.lit(None).cast("int").alias("level"),
                                          F.lit(None).cast("int").alias("characters"), F.lit(1).alias("kind"),
                                          F.col("turn").cast("long").alias("original"))))
    keys, order = ["conv_id", "hash", "more"], ["turn", "kind"]
    placed = keyed_scan(slice_hot_keys(both, keys, order), keys, order, {"at": Scan("latest", F.col("original"))})
    found = placed.where("kind = 0 AND at IS NOT NULL")
    weight = (found.groupBy("conv_id", "turn", "level", "at")
              .agg(F.sum("characters").alias("weight"), F.count(F.lit(1)).alias("units"),
                   (F.max("characters") >= LONG_CHARACTERS).alias("long")))
    return weight.groupBy("conv_id", "turn").agg(
        F.max(F.struct("long", -F.col("level"), "weight", "at")).alias("best"), F.sum("units").alias("linked")).select(
        "conv_id", "turn", F.col("best.at").alias("reply_to"), "linked")


def threads(found: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, linked, thread, depth): the turn on top of each chain of replies, and how far up it is."""
    pointers = materialise(found.withColumn("thread", F.col("reply_to")).withColumn("depth", F.lit(1)), "threads")
    while True:
        above = pointers.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"),
                                F.col("thread").alias("up"), F.col("depth").alias("far"))
        same = (pointers["conv_id"] == above["c"]) & (pointers["thread"] == above["t"])
        joined = pointers.join(above, same, "left")
        following = materialise(joined.select(
            "conv_id", "turn", "reply_to", "linked", F.coalesce("up", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("far", F.lit(0))).alias("depth"), F.col("up").isNotNull().alias("moved")), "threads")
        pointers = following.drop("moved")
        if following.where("moved").isEmpty():
            return pointers


def linked_conversations(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, in reply order by (conv_id, thread, turn).

    Takes conv_id, turn, role, text and any other columns; returns conv_id,
    turn, role, own_text, n_quoted_lines, n_quotes (passages), n_linked (quoted
    units found again), reply_to, thread and depth for every row.  A message that
    quotes nothing known is the beginning of a thread of its own.  Messages that
    share conv_id and turn share what they reply to.  A NULL text has a NULL
    own_text and no quotes; a message without conv_id or turn is linked with
    nothing.  An empty table gives an empty one.
    """
    found = threads(replies(messages)).select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "reply_to", "linked", "thread", "depth")
    rows = parsed(messages.select("conv_id", "turn", "role", "text"))
    joined = rows.join(found, (rows["conv_id"] == found["_conv"]) & (rows["turn"] == found["_turn"]), "left")
    quoted = F.filter("_passages", lambda p: p["level"] > 0)
    return joined.select(
        "conv_id", "turn", "role", "own_text",
        F.size(F.filter("_lines", lambda line: line["level"] > 0)).cast("long").alias("n_quoted_lines"),
        F.size(quoted).cast("long").alias("n_quotes"), F.coalesce("linked", F.lit(0)).cast("long").alias("n_linked"),
        "reply_to", F.coalesce(F.col("thread"), F.col("turn").cast("long")).alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
