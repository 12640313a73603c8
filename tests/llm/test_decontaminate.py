import random
import tracemalloc

import pytest
from llm.llm_data import prose, sorted_rows

from starload.llm import decontaminate
from starload.llm.decontaminate import Passages, banded, compared, contaminated, places_in, without_benchmark


def distance(passage, text):
    """(fewest edits, earliest stop) of the passage anywhere in the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


def spoilt(text, edits, pick):
    text = list(text)
    for _ in range(edits):
        at, kind = pick.randrange(len(text)), pick.choice("sid")
        if kind == "s":
            text[at] = pick.choice("abcxyz")
        elif kind == "i":
            text.insert(at, pick.choice("abcxyz "))
        elif len(text) > 1:
            del text[at]
    return "".join(text)


@pytest.fixture()
def benchmark(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string")
    return make


def test_alignment_against_cell_by_cell():
    pick = random.Random(1)
    for _ in range(150):
        passage = "".join(pick.choice("abc ") for _ in range(pick.randint(1, 25)))
        region = "".join(pick.choice("abc ") for _ in range(pick.randint(0, 9))) + spoilt(passage, pick.randint(0, 4), pick)
        edits, stop = distance(passage, region)
        got = banded(passage, region, len(passage))
        assert got[2] == edits and got[1] == stop and got[0] <= got[1]
        inner = distance(passage, region[got[0]:got[1]])
        assert inner[0] == edits
        if edits:
            assert banded(passage, region, edits - 1) is None


def test_nothing_within_the_budget_is_lost():
    pick, passages = random.Random(2), [" ".join(prose(i, 30)) for i in range(12)]
    known = Passages(list(range(12)), passages)
    for round_ in range(120):
        item = pick.randrange(12)
        words = prose(1000 + round_, 80)
        body = spoilt(passages[item], pick.randint(0, int(known.edits[item]) + 3), pick)
        text = compared(" ".join(words[:40]) + " " + body + " " + " ".join(words[40:]))
        expected = {i for i, p in enumerate(passages) if distance(p, text)[0] <= known.edits[i]}
        assert {m[0] for m in known.matches(['before', text, passages[0]])[1]} == expected


def test_places_are_those_of_the_whole_text(docs, benchmark):
    passage = " ".join(prose(1, 30))
    text = "\n\t Ä  " + "x " * 40_000 + passage.upper().replace(" ", "\n ") + " tail"
    got = contaminated(docs([(5, text), (6, "x " * 90)], matches=1), benchmark([(9, passage)])).orderBy("doc_id").collect()
    match = got[0].matches[0]
    assert compared(text[match.start:match.stop]) == passage and match.edits == 0 and match.item_id == 9
    assert [(r.doc_id, r.n_items, r.is_contaminated) for r in got] == [(5, 1, True), (6, 0, False)]
    assert places_in(" a  b\n") == [1, 3, 4] and compared(" A \n B") == "a b"


def test_edge_cases(docs, benchmark):
    passage = " ".join(prose(1, 30))
    rows = [(1, None), (2, ""), (None, passage), (4, passage), (4, passage), (5, "go on"), (6, "ago on")]
    odd = benchmark([(1, passage), (2, None), (3, " "), (None, "go on"), (4, "go on"), (1, passage)])
    found = {(r.doc_id, r.is_contaminated) for r in contaminated(docs(rows), odd).collect()}
    assert found == {(1, False), (2, False), (None, True), (4, True), (5, True), (6, False)}
    kept = without_benchmark(docs(rows, row=1, matches="m"), odd)
    assert kept.columns == ["doc_id", "text", "lang", "source", "row", "matches"]
    assert sorted_rows(kept.select("doc_id")) == [(1,), (2,), (6,)]
    assert contaminated(docs([]), odd).collect() == []
    assert without_benchmark(docs(rows), benchmark([])).count() == len(rows)


def test_blocks_find_what_one_block_finds(docs, benchmark, monkeypatch):
    passages = [(i, " ".join(prose(i, 25))) for i in range(6)]
    df = docs([(i, "before " + t + " after") for i, t in passages])
    whole = sorted_rows(contaminated(df, benchmark(passages)))
    many = list(decontaminate.blocks(benchmark(passages), 200))
    assert len(many) > 2 and sum(len(b.ids) for b in many) == 6
    monkeypatch.setattr(decontaminate, "blocks", lambda b: many)
    assert sorted_rows(contaminated(df, benchmark(passages))) == whole


def test_ten_per_cent_of_short_passages():
    """Passages of 10 to 40 characters, with as many edits as a tenth of them: found; with more: not."""
    pick = random.Random(8)
    passages = ["".join(pick.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)) for size in range(10, 41)]
    passages = [compared("x" + p[1:-1] + "x") for p in passages]
    known = Passages(list(range(len(passages))), passages)
    assert known.edits.tolist() == [len(p) // 10 for p in passages] and (known.bound >= 1).all()
    for item, passage in enumerate(passages):
        for edits in (len(passage) // 10, len(passage) // 10 + 2):
            for _ in range(6):
                text = compared(" ".join(prose(pick.randrange(10 ** 6), 6)) + " " + spoilt(passage, edits, pick) + " end of it")
                found = {m[0] for m in known.matches([text])[0]}
                expected = {i for i, p in enumerate(passages) if distance(p, text)[0] <= len(p) // 10}
                assert found == expected


def test_shared_grams_of_runs_are_those_of_all_pairs():
    """Repetitive passages: places that follow each other are counted as ranges of diagonals, in pieces of any size."""
    pick = random.Random(9)
    passages = ["=" * 60, "ab" * 20, "=" * 20 + "abc" * 7, "=" * 12 + "x" + "=" * 12]
    texts = ["=" * 200, "=" * 30 + "ab" * 40 + "=" * 9, "".join(pick.choice("=ab") for _ in range(300)), "=" * 19]
    known = Passages(list(range(len(passages))), passages)
    for round_ in range(2):
        for text in texts:
            expected = {i for i, p in enumerate(passages) if distance(p, text)[0] <= len(p) // 10}
            assert {m[0] for m in known.matches(["before", text])[1]} == expected
        decontaminate.PIECE, before = 16, decontaminate.PIECE
    decontaminate.PIECE = before


def test_repetitive_text_needs_bounded_memory():
    known = Passages([1, 2], ["=" * 60, "ab " * 20])
    resource_free = tracemalloc.start() or tracemalloc.get_traced_memory()[0]
    found = known.matches(["=" * 1_000_000])[0]
    peak = tracemalloc.get_traced_memory()[1] - resource_free
    tracemalloc.stop()
    assert 15_000 < len(found) <= 1_000_000 // 60 and {m[0] for m in found} == {0} and peak < 600e6
