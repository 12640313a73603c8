import itertools
import random

import pytest
from llm.llm_data import prose, sorted_rows

from starload.llm.mixing import fit_lengths, mix, mixed, quotas_of, targets


def test_targets_cap_and_share_again():
    got = dict(targets([("b", 100), ("a", 10), (None, 50)]))
    # 240 words by 5, 2, 1: a is capped at 20, then b at 146.67 of 220 by 2 and 1.
    assert got["a"] == 20.0 and got["b"] == pytest.approx(220 * 2 / 3) and got[None] == pytest.approx(220 / 3)
    assert [s for s, _ in targets([(None, 1), ("\U0001F600", 1), ("￿", 1)])] == ["￿", "\U0001F600", None]
    assert targets([]) == [] and targets([("a", 0)]) == [("a", 0.0)]


def test_exact_fit_against_all_choices():
    pick = random.Random(1)
    for _ in range(60):
        lengths = pick.sample(range(1, 30), 4)
        counts = [pick.randint(0, 3) for _ in lengths]
        budget = pick.randint(0, 90)
        best = max(s for s in (sum(a * b for a, b in zip(lengths, c)) for c in
                               itertools.product(*[range(n + 1) for n in counts])) if s <= budget)
        taken = fit_lengths(lengths, counts, budget)
        assert sum(a * b for a, b in zip(lengths, taken)) == best
        assert all(t <= c for t, c in zip(taken, counts))


def test_quotas_stay_within_counts_and_near_the_budget():
    pick = random.Random(2)
    for _ in range(20):
        sizes = pick.sample(range(1, 20_000), 60)
        counts = [pick.randint(1, 40) for _ in sizes]
        budget = pick.randint(0, sum(s * c for s, c in zip(sizes, counts)))
        taken = quotas_of(sizes, counts, budget)
        words = sum(s * t for s, t in zip(sizes, taken))
        assert words <= budget and all(0 <= t <= c for t, c in zip(taken, counts))
        assert budget - words < max(sizes)
    assert quotas_of([7], [1000], 5000) == [714] and quotas_of([0, 5], [3, 2], 4) == [0, 0]


def test_every_source_comes_near_its_target(docs):
    pick, rows = random.Random(4), []
    for source, number in (("x", 40), ("y", 25), (None, 30), ("z", 5)):
        for _ in range(number):
            rows.append((len(rows), " ".join(prose(len(rows), pick.choice([1, 3, 8, 8, 8, 21, 60]))), "en", source))
    df = docs(rows, _size=1, size="?", rule=0, passes=9)
    got = mix(df).toPandas()
    words = {i: len(t.split()) for i, t, _, _ in rows}
    assert dict(zip(got.doc_id, got["size"])) == words
    source = {i: s for i, _, _, s in rows}
    sums = {s: sum(n for i, n in words.items() if source[i] == s) for s in set(source.values())}
    expected = dict(targets(list(sums.items())))
    for s, total in sums.items():
        mine = got[got.doc_id.map(lambda i: source[i] == s)]
        assert (mine.source_size == total).all() and (mine.target == expected[s]).all()
        assert 0 <= expected[s] - mine.taken.sum() < 2
    assert (got.taken <= 2 * got["size"]).all()
    assert sorted_rows(mix(df)) == sorted_rows(mix(df))
    repeated = mixed(df)
    assert repeated.columns == df.columns
    assert repeated.toPandas().groupby("doc_id").size().to_dict() == dict(
        (i, c) for i, c in zip(got.doc_id, got.copies) if c)


def test_one_length_is_cut_into_ranges(docs):
    rows = [(i, f"same length {i}", None, "a") for i in range(500)] + [(1000 + i, "one two three", None, "b") for i in range(700)]
    got = mix(docs(rows), weights=(1.0, 5.0), share=0.5).toPandas()
    for flag in (True, False):
        mine = got[(got.doc_id < 1000) == flag]
        assert 0 <= mine.target.iloc[0] - mine.taken.sum() < 3
    assert got.copies.nunique() > 1


def test_nulls_empty_texts_and_empty_tables(docs):
    rows = [(1, None, None, "a"), (2, "", None, None), (None, "a b", None, "a"), (4, "c d", None, None), (4, "c d", None, None)]
    got = sorted_rows(mix(docs(rows)).select("doc_id", "size", "source_size"))
    assert got == sorted([(1, 0, 2), (2, 0, 4), (None, 2, 2), (4, 2, 4), (4, 2, 4)], key=repr)
    assert mix(docs([])).collect() == [] and mixed(docs([])).collect() == []


def test_equal_rows_are_taken_by_number(docs):
    hot = [(None, "one two three", None, "a")] * 1000 + [(7, "four five", None, "b")] * 300
    rows = hot + [(100 + i, f"other text of {i}", None, "a") for i in range(50)]
    df = docs(rows, _part=1, _place=2).repartition(5)
    got = mix(df, weights=(1.0, 1.0), share=0.5).toPandas()
    assert len(got) == len(rows)
    for flag in (True, False):
        mine = got[(got.doc_id == 7) == flag]
        assert 0 <= mine.target.iloc[0] - mine.taken.sum() < 4
    repeated = mixed(df, weights=(1.0, 1.0), share=0.5)
    assert repeated.columns == df.columns and repeated.count() == got.copies.sum()


def test_long_documents_meet_a_target_that_can_be_met():
    assert quotas_of([8000, 6000, 4500], [1, 1, 1], 10_500) == [0, 1, 1]
    assert quotas_of([7, 5], [2, 2], 14) == [2, 0]  # the even share of one each is given back
    pick = random.Random(6)
    for _ in range(20):
        sizes, counts = pick.sample(range(2_000, 20_000), 6), [1] * 6
        budget = pick.randint(0, 60_000)
        best = max(s for s in (sum(a * b for a, b in zip(sizes, c)) for c in itertools.product((0, 1), repeat=6)) if s <= budget)
        if budget <= 4 * max(sizes):
            assert sum(s * t for s, t in zip(sizes, quotas_of(sizes, counts, budget))) == best
