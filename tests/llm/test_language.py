import random

import numpy as np
from pyspark.sql import functions as F

from starload.llm import language
from starload.llm.common import held_out
from starload.llm.language import identified, letters_in, segments_of, train

SOUNDS = {"aa": ["tho", "wen", "ish", "ring"], "bb": ["ção", "ñar", "lho", "ue"], "cc": ["sch", "ung", "ßer", "ei"]}


def text(code, seed, words):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice(SOUNDS[code]) for _ in range(pick.randint(1, 3))) for _ in range(words))


def small_network(seed=0):
    old = language.HIDDEN, language.STEPS
    language.HIDDEN, language.STEPS = 4, 0
    try:
        network = train([b"abc def", b"xyz uvw"], ["a", "b"])
    finally:
        language.HIDDEN, language.STEPS = old
    for value in network.parameters():
        value[...] = np.random.default_rng(seed).standard_normal(value.shape) * 0.3
    return network


def test_gradients_against_differences():
    network = small_network()
    random_ = np.random.default_rng(1)
    data = random_.integers(97, 105, (9, 3)).astype(np.uint8)
    data[6:, 0] = 0
    counts, labels = letters_in(data), np.array([0, 1, 1])

    def loss():
        chances = network.probabilities(data)[:, np.arange(3), labels]
        return float(-(np.log(chances.astype(float)) * counts).sum() / counts.sum())
    gradients = network.learn(data, counts, labels)
    for value, gradient in zip(network.parameters(), gradients):
        for place in [tuple(random_.integers(0, n) for n in value.shape) for _ in range(12)]:
            if value.shape[0] == 256:
                place = (int(data[int(random_.integers(0, 6)), 1]), place[1])
            kept = value[place]
            value[place] = kept + 1e-2
            above = loss()
            value[place] = kept - 1e-2
            below = loss()
            value[place] = kept
            assert abs((above - below) / 2e-2 - gradient[place]) < 2e-3


def test_padding_and_batches_do_not_matter():
    network = small_network(2)
    texts = [text("aa", i, 1 + 9 * i) for i in range(40)] + [None, "", "42 !"]
    alone = [network.pooled([t])[0] for t in texts]
    together = network.pooled(texts)
    assert [a[0] for a in alone] == [b[0] for b in together]
    assert np.allclose([a[1] for a in alone], [b[1] for b in together], atol=1e-5)
    assert segments_of(b"x" * 129).shape == (2, 128) and together[-3:] == [("und", 0.0)] * 3


def test_held_out_languages_and_edge_cases(docs):
    rows = [(i, text(code, i, 4 + i % 50), code, "s") for i, code in enumerate(list(SOUNDS) * 70)]
    odd = [(None, text("aa", 1, 30), "aa"), (900, None, "aa"), (901, "", "bb"), (902, " 12 ", "cc"),
           (903, text("cc", 5, 20_000), None), (904, "ß", "cc"), (904, "ß", "cc")]
    got = identified(docs(rows + odd, lang_pred="x", score=1, label=2)).toPandas()
    assert len(got) == len(rows) + len(odd) and got.score.between(0, 1).all()
    truth = {r[0]: r[2] for r in rows}
    held = got[got.held_out & got.doc_id.isin(list(truth))]
    assert len(held) > 20 and (held.lang_pred == held.doc_id.map(truth)).mean() > 0.95
    assert got[got.doc_id.isin([900, 901, 902])].lang_pred.tolist() == ["und"] * 3
    assert got[got.doc_id == 903].lang_pred.tolist() == ["cc"] and got[got.doc_id.isna()].held_out.tolist() == [False]


def test_nothing_to_learn_from(docs):
    got = identified(docs([(1, "some text", None), (2, None, None)])).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert identified(docs([])).collect() == []


def test_only_rows_with_a_language_are_learnt_from_each_by_its_own(docs):
    rows = [(1, "eins", "de"), (1, "zwei", None), (1, "one", "en"), (2, None, "en"), (None, "three", "en"), (3, "one", "en"),
            (4, "one", "en"), (4, "one", "en")]
    learnt = language.learnt_rows(docs(rows), F.col("doc_id").isNotNull())
    assert sorted((r.doc_id, r.text, r.lang) for r in learnt.collect()) == [
        (1, "eins", "de"), (1, "one", "en"), (3, "one", "en"), (4, "one", "en")]


def test_every_language_is_in_the_sample(docs):
    df = docs([(i, f"word {i}", "xx") for i in range(20_000)] + [(30_000, "seldom " * 40, "yy")])
    learnt = language.learnt_rows(df, F.lit(True), 100)
    assert {r.lang: r["count"] for r in learnt.groupBy("lang").count().collect()} == {"xx": 100, "yy": 1}


def test_segments_come_from_whole_texts(docs):
    long = "".join(f"{i:08d}" for i in range(16 * 40))
    learnt = language.learnt_rows(docs([(1, long, "xx"), (2, "", "xx"), (3, "é" * 70, "yy")]), F.lit(True))
    got = language.learnt_segments(learnt).orderBy("lang", "rank").collect()
    expected = [bytes(s).rstrip(b"\0") for s in segments_of(long.encode())]
    assert sorted(bytes(r.data) for r in got if r.lang == "xx") == sorted(expected)
    assert b"".join(sorted((bytes(r.data) for r in got if r.lang == "yy"), key=len, reverse=True)) == ("é" * 70).encode()
    few = language.learnt_segments(learnt, 10).where("lang = 'xx'").collect()
    assert len(few) == 10 and max(expected.index(bytes(r.data)) for r in few) > 16  # beyond the beginning


def test_a_rare_language_is_predicted(docs):
    """One document in 20,000: the sample is bounded per language."""
    rows = [(i, text("aa", i % 500, 12), "aa") for i in range(20_000)] + [(50_001, text("bb", 7, 3000), "bb"), (50_005, text("bb", 8, 50))]
    df = docs(rows)
    assert df.where("doc_id = 50001").select(held_out("doc_id", 5, 0)).first()[0] is False
    got = {r.doc_id: r.lang_pred for r in identified(df).where("doc_id > 49990 OR doc_id < 5").collect()}
    assert got[50_005] == "bb" and {got[i] for i in range(5)} == {"aa"}
