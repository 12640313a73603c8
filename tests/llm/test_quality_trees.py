import numpy as np
from llm.llm_data import prose, sorted_rows

from starload.llm.quality_trees import DEPTH, FEATURES, grow, judged, statistics_of


def test_flat_walk_equals_node_by_node():
    random = np.random.default_rng(0)
    rows = random.random((400, 6))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 3] > 0.7)).astype(float)
    trees = grow(rows, labels)
    found = trees.probabilities(rows)
    for i in range(0, 400, 17):
        total = trees.start
        for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf):
            at = 0
            for _ in range(DEPTH):
                at = 2 * at + 1 + int(rows[i, feature[at]] > cut[at])
            total += leaf[at - len(feature)]
        assert abs(found[i] - 1 / (1 + np.exp(-total))) < 1e-9
    assert ((found > 0.5) == labels.astype(bool)).mean() > 0.97


def test_statistics():
    s = dict(zip(FEATURES, statistics_of("AA AA b,\nb, c# 12!")))
    assert s["upper-case words"] == 2 / 6 and s["repeated neighbours"] == 2 / 6 and s["distinct words"] == 4 / 6
    assert statistics_of(None) == statistics_of(" \n") == [0.0] * len(FEATURES)
    assert len(statistics_of("x")) == len(FEATURES)


def corpus():
    rows, marks = [], []
    for i in range(240):
        words, good = prose(i, 20 + i % 40), i % 3 > 0
        if not good:
            words = [[w.upper() + "!!" for w in words], [w for w in words for _ in range(5)], [w + "###" for w in words]][i % 9 // 3]
        rows.append((i, " ".join(words)))
        marks.append((i, int(good), 0))
    return rows, marks


def test_held_out_quality(docs, labels):
    rows, marks = corpus()
    got = judged(docs(rows, score="x", label=9, s=1), labels(marks)).toPandas().set_index("doc_id").sort_index()
    truth = np.array([m[1] for m in marks])
    held = got.held_out.to_numpy()
    assert held.sum() > 20 and ((got.predicted == truth)[held]).mean() > 0.95
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()


def test_edge_cases(docs, labels):
    rows, marks = corpus()
    odd = [(None, "no id"), (900, None), (901, ""), (902, " ".join(prose(3, 50_000))), (903, "#"), (903, "#")]
    got = judged(docs(rows[:90] + odd), labels(marks[:90] + [(None, 1, 0), (4, None, None)])).toPandas()
    assert len(got) == 96 and got.score.notna().all() and got[got.doc_id == 903].score.nunique() == 1
    assert got[got.doc_id.isna()].held_out.tolist() == [False]
    assert {r.score for r in judged(docs(rows[:5]), labels([])).collect()} == {0.5}
    assert judged(docs([]), labels([])).collect() == []
    df = docs(rows[:60])
    assert sorted_rows(judged(df, labels(marks[:60]))) == sorted_rows(judged(df, labels(marks[:60])))


def test_the_end_of_a_text_is_in_a_stretch():
    from starload.llm.quality_trees import FEATURES, statistics_of
    words = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(90)]
    plain, junk = (dict(zip(FEATURES, statistics_of(" ".join(w)))) for w in (words, words[:60] + ["#JUNK"] * 30))
    for name in ("worst symbols", "worst upper-case words", "worst repeated neighbours"):
        assert plain[name] == 0 and junk[name] > 0.3
    assert junk["worst distinct words"] < 0.8 and plain["worst distinct words"] == 1
