import itertools
import random

import numpy as np
import pytest
from llm.llm_data import prose, sorted_rows


from starload.llm import neardup
from starload.llm.neardup import Shape, Signer, components, drop_near_duplicates, near_duplicates, shingles


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*[words[i:] for i in range(size)])) if len(words) >= size else frozenset([tuple(words)])


def brute(rows, size):
    """component_id by all pairs; rows of one id are one document."""
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    named = [(i, sets_of(t, size)) for i, t in rows if i is not None]
    for i, _ in named:
        parent[i] = i
    for (i, a), (j, b) in itertools.combinations(named, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def near_copies(seed=3, groups=12, copies=14):
    pick, rows = random.Random(seed), []
    for g in range(groups):
        base = prose(g, pick.randint(3, 90))
        for _ in range(copies):
            words = list(base)
            for _ in range(pick.randint(0, max(1, len(words) // 14))):
                words[pick.randrange(len(words))] = prose(pick.randrange(10 ** 6), 1)[0]
            rows.append((len(rows) * 3 % 1009, " ".join(words)))
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_same_components_as_all_pairs(docs, size):
    rows = near_copies()
    found = near_duplicates(docs(rows, key=1, node=2, kept=3, component=4), Shape(words=size)).toPandas()
    expected = brute(rows, size)
    assert dict(zip(found.doc_id, found.component_id)) == expected
    assert (found.kept == (found.doc_id == found.component_id)).all()
    assert dict(zip(found.doc_id, found.n_shingles)) == {i: len(sets_of(t, size)) for i, t in rows}


def test_one_large_group_of_copies_that_differ_more_and_more(docs, monkeypatch):
    monkeypatch.setattr(neardup, "RARE", 5)
    monkeypatch.setattr(neardup, "CENTRES_AT_ONCE", 2)
    pick, base, rows = random.Random(5), prose(1, 60), []
    for i in range(90):
        words = list(base)
        for _ in range(pick.randint(0, 9)):
            words[pick.randrange(len(words))] = prose(pick.randrange(40), 1)[0]
        rows.append((i, " ".join(words)))
    found = near_duplicates(docs(rows), Shape(words=2)).toPandas()
    assert dict(zip(found.doc_id, found.component_id)) == brute(rows, 2)


def test_nulls_empty_repeated_and_very_long(docs):
    long = " ".join(prose(9, 30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (None, "one"), (None, None),
            (7, long), (8, long + " end"), (7, long), (9, "a b c"), (9, "x y z"), (10, "x  y\nZ")]
    found = sorted_rows(near_duplicates(docs(rows), Shape(words=2)))
    assert (1, 0, 1, True) in found and (2, 0, 2, True) in found and (3, 0, 3, True) in found
    assert (4, 1, 4, True) in found and (5, 1, 4, False) in found
    assert (None, 1, None, True) in found or (None, 1, 4, True) in found
    assert [r[2] for r in found if r[0] == 8] == [7] and [r[2:] for r in found if r[0] == 7] == [(7, True)] * 2
    assert {r[2] for r in found if r[0] in (9, 10)} == {9}
    assert len(found) == len(rows)
    assert near_duplicates(docs([])).collect() == []
    assert near_duplicates(docs([(1, None)])).count() == 1


def test_dropping_keeps_columns(docs):
    rows = [(1, "a b c d e f g h", "en", "s"), (2, "a b c d e f g h", None, None), (3, "else", "fr", "t"), (None, "a b", "x", "y")]
    kept = drop_near_duplicates(docs(rows, kept="no", component_id=5))
    assert kept.columns == ["doc_id", "text", "lang", "source", "kept", "component_id"]
    assert sorted_rows(kept.select("doc_id")) == sorted([(1,), (3,), (None,)], key=repr)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert dict(components(links).collect()) == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_signatures_agree_as_often_as_sets_do():
    signer, random_ = Signer(Shape(bands=500, rows=2)), np.random.default_rng(0)
    for size in (5, 200, 3000):
        values = np.sort(random_.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        part = values[: int(size * 0.8)]
        agree = (signer.signature(values) == signer.signature(part)).mean()
        assert abs(agree - len(part) / size) < 0.08
    assert len(shingles("A b  a B", 2)) == 2 and len(shingles("a", 2)) == 1 and len(shingles(None, 2)) == 0


def test_dropping_keeps_one_row_of_every_group(docs):
    same = "a b c d e f g h i j"
    rows = [(5, same), (5, same), (None, same), (None, same), (4, same + " k"), (4, "quite another text of its own"),
            (7, None), (7, None), (8, ""), (None, "l m n o p q"), (None, "l m n o p q"), (9, "x")]
    df = docs(rows, _place=1, component_id=2)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted_rows(kept.select("doc_id", "text")) == sorted(
        [(4, same + " k"), (4, "quite another text of its own"), (7, None), (7, None), (8, ""), (None, "l m n o p q"), (9, "x")],
        key=repr)


def test_a_row_without_id_links_others(docs):
    words = [f"w{i}" for i in range(40)]
    chain = [" ".join(words), " ".join(words + ["x1", "x2", "x3", "x4"]), " ".join(words + [f"x{i}" for i in range(1, 9)])]
    kept = drop_near_duplicates(docs([(1, chain[0]), (None, chain[1]), (2, chain[2])]))
    assert sorted_rows(kept.select("doc_id")) == [(1,)]
