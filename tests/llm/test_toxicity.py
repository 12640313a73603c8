import math
import random
from collections import Counter

import numpy as np
import pytest
from llm.llm_data import prose, sorted_rows
from pyspark.sql import functions as F

from starload.llm import toxicity
from starload.llm.common import labelled_sample
from starload.llm.toxicity import Index, hashed, isotonic, judged, pack, terms_of, weights_of, without_toxic

BAD = ["villain", "scoundrels", "rotter", "blackguard"]


def corpus(number=240, seed=1):
    pick, rows, marks = random.Random(seed), [], []
    for i in range(number):
        words, toxic = prose(i, pick.randint(5, 60)), int(i % 4 == 0)
        if toxic:
            for _ in range(pick.randint(2, 5)):
                words.insert(pick.randrange(len(words)), pick.choice(BAD))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, toxic))
    return rows, marks


def some_index(seed=0, examples=300, terms=40, most=6):
    """An index over random counts, in buckets as tasks make them, and the counts of its examples."""
    pick = random.Random(seed)
    counts = [Counter({f"t{t}": pick.randint(1, 4) for t in pick.sample(range(terms), pick.randint(0, most))})
              for _ in range(examples)]
    labels = np.array([pick.randint(0, 1) for _ in counts])
    found = [hashed(c) for c in counts]
    term, times = (np.concatenate(x) for x in zip(*found))
    place = np.repeat(np.arange(examples), [len(f[0]) for f in found])
    buckets = [(int(own.sum()), pack(term[own], place[own], times[own], labels[place[own]], int(labels.sum()), examples))
               for own in (term % 3 == i for i in range(3))]
    return Index(buckets, 1000 - np.arange(examples), labels), counts, labels


def plain_vector(counts, seen, weight):
    """(1 + log tf) * weight of the known terms of a text, of length 1."""
    v = {t: (1 + math.log(n)) * weight[t] for t, n in counts.items() if seen.get(t)}
    length = math.sqrt(sum(x * x for x in v.values())) or 1.0
    return {t: x / length for t, x in v.items()}


def plain_weights(counts, labels):
    seen, with_1 = Counter(), Counter()
    for c, label in zip(counts, labels):
        seen.update(c.keys())
        with_1.update(c.keys() if label else ())
    names = list(seen)
    made = weights_of(np.array([seen[t] for t in names]), np.array([with_1[t] for t in names]), int(labels.sum()), len(counts))
    return seen, dict(zip(names, made))


@pytest.mark.parametrize("common", [toxicity.COMMON, 7, 0])
def test_neighbours_are_those_of_all_cosines(common, monkeypatch):
    monkeypatch.setattr(toxicity, "COMMON", common)
    index, counts, labels = some_index()
    seen, weight = plain_weights(counts, labels)
    every = [plain_vector(c, seen, weight) for c in counts]
    pick = random.Random(5)
    for _ in range(100):
        asked = Counter({f"t{t}": pick.randint(1, 3) for t in pick.sample(range(45), pick.randint(0, 5))})
        mine = plain_vector(asked, seen, weight)
        cosines = np.array([sum(x * v.get(t, 0.0) for t, x in mine.items()) for v in every])
        best = [p for p in np.lexsort((np.arange(len(cosines)), -np.round(cosines, 6)))[:toxicity.NEIGHBOURS] if cosines[p] > 0]
        ((places, found),) = index.nearest_of([index.vector(*hashed(asked))])
        assert np.allclose(found, cosines[best], atol=1e-6) and np.allclose(cosines[places], found, atol=1e-6)
        assert (np.diff(np.round(found, 12)) <= 0).all()


def test_skipped_blocks_change_no_neighbour(monkeypatch):
    index, counts, _ = some_index(seed=3, examples=2000, terms=4000, most=60)
    vectors = [index.vector(*hashed(c)) for c in counts[:200]]
    skipped, real = [], Index.open_blocks
    monkeypatch.setattr(Index, "open_blocks", staticmethod(lambda u, v: (skipped.append((~real(u, v)).mean()), real(u, v))[1]))
    pruned = list(index.nearest_of(vectors))
    monkeypatch.setattr(Index, "open_blocks", staticmethod(lambda u, v: np.ones(len(u), bool)))
    full = list(index.nearest_of(vectors))
    assert np.mean(skipped) > 0.1
    for (a, b), (c, d) in zip(pruned, full):
        assert a.tolist() == c.tolist() and b.tolist() == d.tolist()


def test_leave_one_out_does_not_see_the_label(monkeypatch):
    """The vector of an example is the one that an index without it would give to its text."""
    index, counts, labels = some_index(seed=4, examples=60)
    for place in range(60):
        others = [c for i, c in enumerate(counts) if i != place]
        seen, weight = plain_weights(others, np.delete(labels, place))
        expected = plain_vector(counts[place], seen, weight)
        at, weights = index.vector(*hashed(counts[place]), place)
        own = {int(hashed(Counter([t]))[0][0]): x for t, x in expected.items()}
        assert {int(t): round(float(x), 9) for t, x in zip(index.terms[at], weights)} == {t: round(x, 9) for t, x in own.items()}
        ((places, _),) = index.nearest_of([(at, weights)], [place])
        assert place not in places


def test_one_row_per_labelled_id_is_learnt_from(docs, labels):
    df = docs([(1, f"word{i}") for i in range(3000)] + [(2, "other"), (3, None)])
    sample = labelled_sample(df, labels([(1, 0, 0), (1, 0, 1), (2, 0, 0), (3, 0, 1)]), "toxic", F.lit(True), 10)
    assert sorted_rows(sample) == [(1, "word999", 1), (2, "other", 0), (3, None, 1)]


def test_isotonic_is_monotone_and_keeps_the_mean_order():
    knots, levels = isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.5]), np.array([0, 1, 0, 1, 1]))
    assert (np.diff(knots) > 0).all() and (np.diff(levels) >= 0).all()


def test_held_out_toxic_documents_are_found(docs, labels):
    rows, marks = corpus()
    got = judged(docs(rows, score=1.0, label=2, term="x", neighbours=0), labels(marks)).toPandas().set_index("doc_id")
    toxic = np.array([m[2] for m in marks], dtype=bool)
    held = got.held_out.reindex(range(len(rows))).to_numpy()
    predicted = got.predicted.reindex(range(len(rows))).to_numpy().astype(bool)
    assert predicted[held & toxic].mean() > 0.9 and predicted[held & ~toxic].mean() < 0.05
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert all(n[0]["label"] == 1 for n in got[got.predicted == 1].neighbours)


def test_labels_of_held_out_rows_are_not_learnt(docs, labels):
    rows, marks = corpus(160)
    from starload.llm.common import held_out
    df = docs(rows)
    held = {r[0] for r in df.where(held_out("doc_id", 4, 2)).select("doc_id").collect()}
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in marks]
    assert sorted_rows(judged(df, labels(marks)).drop("neighbours")) == sorted_rows(judged(df, labels(turned)).drop("neighbours"))


def test_edge_cases(docs, labels):
    rows, marks = corpus(120)
    long = " ".join(prose(1, 40_000) + ["rotter"] * 30)
    odd = [(None, "rotter scoundrels"), (1000, None), (1001, ""), (1002, long), (1003, "7 8 !"), (1003, "7 8 !")]
    got = judged(docs(rows + odd), labels(marks + [(None, 1, 1), (3, None, None)])).toPandas()
    assert len(got) == len(rows) + len(odd) and got.score.notna().all()
    assert got[got.doc_id.isna()].held_out.tolist() == [False] and got[got.doc_id.isna()].predicted.tolist() == [1]
    assert got[got.doc_id.isin([1000, 1001, 1003])].predicted.tolist() == [0] * 4
    assert judged(docs([]), labels([])).collect() == []
    assert set(judged(docs(rows), labels([])).select("predicted").distinct().collect()[0]) == {0}
    assert terms_of("Rotters rot")["rott*"] == 1


def test_filter_keeps_rows_and_columns(docs, labels):
    rows, marks = corpus(120)
    df = docs(rows + [(None, None)], row=1, s="x")
    kept = without_toxic(df, labels(marks))
    gone = {r[0] for r in judged(df, labels(marks)).where("predicted = 1").collect()}
    assert kept.columns == df.columns and gone
    assert sorted_rows(kept.select("doc_id")) == sorted([(i,) for i, _ in rows if i not in gone] + [(None,)], key=repr)


def test_near_copies_of_rare_toxic_examples_are_found(docs, labels):
    """Abusive words that only one sampled example has: no term of it tells labels apart by itself."""
    rows, marks = corpus()
    from starload.llm.common import fold
    rare = " ".join("qxzv" + "abcdefghij"[i] * 3 + "w" for i in range(10))
    df = docs([(i,) for i in range(1000, 1050)])
    learnt = df.where(fold("doc_id", 4) != 2).first().doc_id
    rows += [(learnt, rare), (2000, rare + " tari"), (2001, "vvv www uuu")]
    got = judged(docs(rows), labels(marks + [(learnt, 1, 1)])).toPandas().set_index("doc_id")
    assert got.neighbours[2000][0]["doc_id"] == learnt and got.neighbours[2000][0]["cosine"] > 0.9
    assert got.predicted[2000] == 1 and got.predicted[2001] == 0 and len(got.neighbours[2001]) == 0


def test_clean_documents_have_neighbours(docs, labels):
    rows, marks = corpus()
    got = judged(docs(rows), labels(marks)).toPandas().set_index("doc_id")
    clean = [i for i, _, toxic in marks if not toxic]
    assert (got.neighbours[clean].map(len) > 0).all()
