"""What several operators share: reading, folds of labelled rows, words and 64-bit mixing."""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starload.scratch import materialise

#: The characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def held_out(doc_id: str, folds: int, remainder: int) -> Column:
    return F.coalesce(fold(doc_id, folds) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, bound: int,
                    seed: int = 7) -> DataFrame:
    """(doc_id, text, label) of at most `bound` labelled documents, one row each, the same ones in every run.

    The bound is on what a classifier is fitted with, so its ids can be
    broadcast.  `usable` is a condition on doc_id.  A document that is labelled
    more than once takes its largest label, one with several texts its largest
    text.  The rows are written to the shared folder, because fitting reads them
    more than once.
    """
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
           .orderBy(F.xxhash64(F.col("doc_id"), F.lit(seed)), "doc_id").limit(bound))
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return materialise(texts.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label")), "labelled")


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcasts a fitted model together with its code; the function gives it back in a task."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def give_back() -> None:
    """Returns freed memory to the system, where the C library can: a worker lives on after its task."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def spark_words(text: str | Column) -> Column:
    """The words of a text as an array; empty for a NULL text or one without words."""
    column = F.col(text) if isinstance(text, str) else text
    trimmed = F.trim(F.coalesce(column, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of a text, encoded.  bytes.split and bytes.lower know ASCII only, which is what is asked for."""
    data = utf8(text)
    return (data.lower() if lower else data).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x

