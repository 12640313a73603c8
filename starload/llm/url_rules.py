"""URL rules as a sort-merge range join, in SQL functions only.

A host with its labels in reverse order makes a host and all its subdomains one
range of keys; a rule's path makes all paths that begin with it one.  Rules and
urls are put in one order.  Walking along it, a rule is put on a stack where its
range begins and taken off where it ends; ranges are nested or apart, so the rule
on top is the most special one.  The height of the stack is a running sum, and the
rule on top is the last one that was put on at the present height: two ordered
scans, no pairs.  The order is cut into ranges that are scanned side by side, and
what crosses a cut comes from a summary with one row per range and height.

One sweep over hosts finds the most special host that has rules, which knows the
less special ones around it; a second sweep over (host with rules, path) finds the
longest path for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from starload.local import small_frame
from starload.operators.skew import SLICE, Scan, keyed_scan
from starload.scratch import materialise

#: Fixed values of the contract.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: The verdict on a url that no rule fits.
OTHERWISE = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END, START, POINT = 0, 1, 2


def rule_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("host", "path", "verdict")])
    return small_frame(spark, list(rules), schema)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a NULL url or one without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _host_key(host: Column) -> Column:
    """Labels in reverse order, each closed by a byte that no host has, so that a key begins with those of its parents."""
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, "\u0001"), F.lit("\u0001")).cast("binary")


def _path_key(host: Column, path: Column) -> Column:
    return F.concat(_host_key(host), F.unhex(F.lit("00")), path.cast("binary"))


def sweep(points: DataFrame, ranges: DataFrame) -> DataFrame:
    """points (key binary, tie, others) with `top`: the `value` of the smallest range around the key.

    ranges: (key binary, value), one row per prefix; a range is all keys that begin
    with its key.  `tie` tells points of one key apart, so that they can be cut.
    """
    value = ranges.schema["value"].dataType
    more = [c for c in points.columns if c not in ("key", "tie")]
    edges = [ranges.select("key", F.lit(START).alias("kind"), F.lit(0).cast("long").alias("tie"), F.lit(1).alias("step"), "value"),
             ranges.select(F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(END).alias("kind"),
                           F.lit(0).cast("long").alias("tie"), F.lit(-1).alias("step"), F.lit(None).cast(value).alias("value"))]
    every = points.select("key", F.lit(POINT).alias("kind"), "tie", F.lit(0).alias("step"),
                          F.lit(None).cast(value).alias("value"), *more)
    for edge in edges:
        every = every.unionByName(edge, allowMissingColumns=True)
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "kind", "tie"]
    cut = materialise(every.repartitionByRange(parts, *order).withColumn(SLICE, F.spark_partition_id() + 1), "sweep")
    # One row per range of the order: as many as partitions.
    net = cut.groupBy(SLICE).agg(F.sum("step").alias("net"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.broadcast(net.select(SLICE, F.coalesce(F.sum("net").over(before), F.lit(0)).alias("carried")))
    along = Window.partitionBy(SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    heights = (cut.join(carried, SLICE).withColumn("height", (F.col("carried") + F.sum("step").over(along)).cast("long"))
               .drop("carried", "step"))
    scanned = keyed_scan(heights, ["height"], order, {"top": Scan("latest", F.col("value"))})
    return scanned.where(F.col("kind") == POINT).select("key", "tie", *more, "top")


def judged(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of pages (page_id, url and any others).

    rules: (host, path, verdict); a rule fits its host and all subdomains if the
    path begins with the rule's.  The longest rule text wins, of equally long ones
    the one with the longer host.  Of rules that are equal but for the verdict,
    `block` wins.  A NULL url, one without `://` and one that no rule fits have no
    rule and the verdict `otherwise`.  Repeated rows stay repeated; an empty table
    gives an empty one, and without rules every verdict is `otherwise`.
    """
    host, path = host_and_path(F.col("url"))
    # Written once, so that the number of a row stays its own and equal rows can be told apart and cut.
    rows = materialise(pages.select("page_id", host.alias("host"), path.alias("path"),
                                    F.monotonically_increasing_id().alias("tie")), "urls")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    hosts = rules.select("host").distinct()
    parents = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(F.split("host", r"\."))),
        lambda i: F.array_join(F.slice(F.split("host", r"\."), i, F.size(F.split("host", r"\."))), "."))).alias("parent"))
    chains = (parents.join(hosts.select(F.col("host").alias("parent")), "parent")
              .groupBy("host").agg(F.array_sort(F.collect_set("parent")).alias("value")))
    by_host = sweep(rows.withColumn("key", _host_key(F.col("host"))),
                    chains.select(_host_key(F.col("host")).alias("key"), "value")).drop("key")
    tried = by_host.select("page_id", "host", "path", "tie", F.explode_outer("top").alias("at"))
    tried = materialise(tried, "tried")
    points = tried.where("at IS NOT NULL").withColumn("key", _path_key(F.col("at"), F.col("path")))
    by_path = sweep(points, rules.select(_path_key(F.col("host"), F.col("path")).alias("key"),
                                         F.struct("host", "path", "verdict").alias("value")))
    found = by_path.select("page_id", "tie", "host", "path", "top").unionByName(
        tried.where("at IS NULL").select("page_id", "tie", "host", "path"), allowMissingColumns=True)
    rank = F.when(F.col("top").isNotNull(), F.struct(
        (F.length("top.host") + F.length("top.path")).alias("size"), F.length("top.host").alias("host_size"), "top"))
    best = found.groupBy("tie", "page_id", "host", "path").agg(F.max(rank).alias("best"))
    return best.select("page_id", "host", "path", F.concat("best.top.host", "best.top.path").alias("rule"),
                       F.coalesce("best.top.verdict", F.lit(otherwise)).alias("verdict"))
