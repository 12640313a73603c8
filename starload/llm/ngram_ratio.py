"""Quality rules: fixed limits on a document, then a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words, as they are written, are hashed into buckets.
Two multinomials over the buckets, one of trusted documents and one of all
documents, give every bucket the logarithm of its ratio; a document's mean over
its n-grams is compared with a fixed threshold.  Everything is SQL functions:
counts are pre-aggregated per bucket, and the table of ratios (rounded to six
places), whose size is a parameter, is a constant that a document looks into
without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starload.llm.common import spark_words
from starload.scratch import materialise

BUCKETS = 1 << 13
#: Up to so many ids of trusted documents are broadcast, so that no text moves; more are joined by a shuffle.
SMALL = 2_000_000
#: Least mean log ratio per n-gram.
THRESHOLD = -0.15
#: Fixed values of the contract.
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


def bound(value: Column, body) -> Column:
    """body(value) with value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def with_next(words: Column, use) -> Column:
    """use(word, next word) for every word; the last one has the next word NULL."""
    return F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), use)


def bucket(buckets: int, *words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(buckets)).cast("int")


def buckets_of(words: Column, buckets: int = BUCKETS) -> Column:
    """The buckets of all words and of all pairs of neighbours."""
    return F.array_compact(F.flatten(with_next(words, lambda a, b: F.array(
        bucket(buckets, a), F.when(b.isNotNull(), bucket(buckets, a, b))))))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of so many words that occurs twice or more in the text."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)),
                         lambda i: F.xxhash64(F.slice(words, i, window)))

    def covered(places: Column) -> Column:
        steps = F.zip_with(places, F.slice(places, 2, F.size(places)),
                           lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window)))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def places(keyed: Column) -> Column:
        # A window is repeated if its neighbour in the order of hashes has the same one.
        later = F.zip_with(keyed, F.slice(keyed, 2, F.size(keyed)), lambda a, b: a["h"] == b["h"])
        return bound(later, lambda same: F.sort_array(F.array_compact(F.transform(keyed, lambda k, i: F.when(
            F.coalesce(F.get(same, i), F.lit(False)) | F.coalesce(F.get(same, i - 1), F.lit(False)), k["i"])))))

    def repeated(found: Column) -> Column:
        keyed = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # Only texts with an equal pair of windows pay for finding out where they are.
        return (F.when(F.size(F.array_distinct(found)) == F.size(found), 0)
                .otherwise(bound(keyed, lambda k: bound(places(k), covered))))
    return F.when(F.size(words) <= window, 0).otherwise(bound(hashes, repeated)).cast("long")


def base(rows: DataFrame) -> DataFrame:
    """rows (text, _words) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": F.when(F.instr(text, "\n") == 0, 0)
        .otherwise(bound(lines, lambda every: F.size(every) - F.size(F.array_distinct(every)))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")),
    }).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                  | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the documents of quality 1."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def bucket_counts(docs: DataFrame, buckets: int, name: str) -> DataFrame:
    """(bucket, name): how many words and pairs of docs (text) fall into each bucket that has any."""
    words = docs.select(spark_words("text").alias("words"))
    pairs = words.select(F.explode(with_next(F.col("words"), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p"))
    both = F.array(bucket(buckets, F.col("p.a")), F.when(F.col("p.b").isNotNull(), bucket(buckets, F.col("p.a"), F.col("p.b"))))
    return (pairs.select(F.explode(both).alias("bucket")).where("bucket IS NOT NULL")
            .groupBy("bucket").agg(F.count(F.lit(1)).alias(name)))


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row with `ratios`, the log ratio of every bucket: trusted against all, both smoothed by one."""
    ids = materialise(trusted, "trusted")
    ids = F.broadcast(ids) if ids.count() <= SMALL else ids
    mine = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every
    for rows, name in ((docs, "n_all"), (mine, "n_trusted")):
        filled = filled.join(bucket_counts(rows, buckets, name), "bucket", "left")
    filled = filled.select("bucket", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_all", "n_trusted")])
    table = filled.agg(F.sum("n_all").alias("sum_all"), F.sum("n_trusted").alias("sum_trusted"),
                       F.array_sort(F.collect_list(F.struct("bucket", "n_all", "n_trusted"))).alias("b"))
    ratio = F.transform("b", lambda x: F.log((x["n_trusted"] + 1) / (F.col("sum_trusted") + buckets))
                        - F.log((x["n_all"] + 1) / (F.col("sum_all") + buckets)))
    return table.select(F.when(F.col("sum_trusted") > 0, ratio)
                        .otherwise(F.array_repeat(F.lit(0.0), buckets)).alias("ratios"))


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """The base columns, `ratio` (mean log ratio per n-gram) and kept for every row of docs (doc_id, text and any others).

    A NULL text has no words.  A text without words has ratio 0 and fails the
    base.  Without trusted documents every ratio is 0.  Repeated rows have equal
    results, an empty table gives an empty one.
    """
    # As many numbers as buckets come to the driver and go back as a constant of the plan: no join.
    table = ratios(docs, trusted_ids(labels), buckets).first()["ratios"]
    value = F.split(F.lit(",".join(f"{r:.6f}" for r in table)), ",").cast("array<double>")
    found = base(docs.select("doc_id", "text").withColumn("_words", spark_words("text")))
    sums = with_next(F.col("_words"), lambda a, b: F.get(value, bucket(buckets, a)) + F.when(
        b.isNotNull(), F.get(value, bucket(buckets, a, b))).otherwise(0.0))
    total = F.aggregate(sums, F.lit(0.0), lambda t, r: t + r)
    scored = found.withColumn("ratio", F.when(F.col("n_words") > 0, total / (2 * F.col("n_words") - 1)).otherwise(0.0))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "ratio", (~F.col("base_failed") & (F.col("ratio") >= threshold)).alias("kept"))
