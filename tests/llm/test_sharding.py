from collections import Counter

import pytest
from llm.llm_data import sorted_rows

from starload.llm.sharding import SHARDS, TABLE_SIZE, place, slot_table, table_frame


def test_turns_by_preference():
    """Replays the turns with explicit orders of preference."""
    from starload.llm.sharding import _number
    names, size = ["a", "b", "c"], 31
    orders = {n: [(_number(n, "offset", size) + k * (_number(n, "step", size - 1) + 1)) % size for k in range(size)] for n in names}
    table = {}
    while len(table) < size:
        for n in names:
            if len(table) < size:
                table[next(s for s in orders[n] if s not in table)] = n
    assert slot_table(["c", "a", "b"], size) == [table[i] for i in range(size)]


def test_even_and_stable():
    before, after = slot_table(SHARDS), slot_table(SHARDS[:-1])
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(before) == TABLE_SIZE
    moved = sum(a != b for a, b in zip(before, after) if a != SHARDS[-1])
    assert moved < 0.05 * TABLE_SIZE


def test_bad_tables():
    for shards, size in (([], 7), (["a", "a"], 7), (["a"], 9), (list("abcdefgh"), 7)):
        with pytest.raises(ValueError):
            slot_table(shards, size)


def test_rows_and_columns_stay(spark, docs):
    df = docs([(1, "a"), (1, "b"), (None, None), (2, "c"), (2, "c")], slot="old", row=3)
    got = place(df, shards=("x", "y"), size=101)
    assert got.columns == ["doc_id", "text", "lang", "source", "row", "slot", "shard"]
    assert got.count() == 5 and got.where("shard IS NULL").isEmpty()
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.doc_id, set()).add(r.shard)
    assert all(len(s) == 1 for s in by_id.values())
    table = dict(table_frame(spark, ("x", "y"), 101).collect())
    assert all(table[r.slot] == r.shard for r in got.collect())
    assert place(docs([])).collect() == []
    assert sorted_rows(place(df)) == sorted_rows(place(df))
