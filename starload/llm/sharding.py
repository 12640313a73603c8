"""Placement of documents on shards by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a prime-sized table,
given by an offset and a step; as the size is prime, every step visits all
slots.  The shards take turns, each claiming its most preferred slot that is
still free, until the table is full.  So shards get equally many slots, give or
take one, and when a shard is added or removed few slots change hands.  A
document's slot is a hash of its id, and the table, whose size is a parameter
and not a property of the data, is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starload.local import small_frame

#: A prime of more than a hundred times the number of shards keeps them within one per cent of each other.
TABLE_SIZE = 16_381
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
MOST_SLOTS = 4_194_301


def _number(name: str, salt: str, below: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big") % below


def slot_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[str]:
    """The shard of every slot.  Names must be distinct; their order does not matter."""
    names = sorted(set(shards))
    if not names or len(names) != len(shards) or len(names) > size:
        raise ValueError("shards must be distinct, at least one and no more than slots")
    if size > MOST_SLOTS or size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError(f"the table size must be a prime up to {MOST_SLOTS}")
    following = [_number(n, "offset", size) for n in names]
    steps = [_number(n, "step", size - 1) + 1 for n in names]
    owner: list[str | None] = [None] * size
    free = size
    while True:
        for i, name in enumerate(names):
            while owner[following[i]] is not None:
                following[i] = (following[i] + steps[i]) % size
            owner[following[i]] = name
            free -= 1
            if not free:
                return owner


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard): as many rows as slots."""
    schema = T.StructType([T.StructField("slot", T.LongType()), T.StructField("shard", T.StringType())])
    return small_frame(spark, list(enumerate(slot_table(shards, size))), schema)


def slot_of(key: str | Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: its 64-bit hash modulo the size.  A NULL key has the slot of the hash's seed."""
    return F.pmod(F.xxhash64(key), F.lit(size))


def place(rows: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """All rows and columns, with `slot` and `shard` (which replace columns of these names).

    Rows of one key go to one shard, whatever else they hold; repeated rows stay
    repeated.  A NULL key is a key like others.  An empty table gives an empty one.
    """
    names = [c for c in rows.columns if c not in ("slot", "shard")]
    slots = table_frame(rows.sparkSession, shards, size)
    left = rows.select(F.struct(*names).alias("row"), slot_of(rows[key], size).alias("slot"))
    return left.join(F.broadcast(slots), "slot").select("row.*", "slot", "shard")
