import random
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest
from llm.llm_data import sorted_rows

from starload.llm import spelling
from starload.llm.spelling import PositionIndex, Shape, near_words, variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(rows, shape=Shape()):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % shape.every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= shape.least_length:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= shape.least_n}
    near = defaultdict(list)
    for a in n:
        for b in n:
            if one_edit(a, b):
                near[a].append(b)
    best = {a: min(near[a], key=lambda b: (-n[b], b)) for a in near}
    form = {a: b for a, b in best.items() if n[b] >= shape.factor * n[a]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n), key=repr)


def got(df, shape=Shape()):
    return sorted_rows(variants(df, shape).select("word", "form", "root", "n", "n_near", "form_n"))


def some_words(seed, number, alphabet="abé", least=6, most=12):
    pick = random.Random(seed)
    return sorted({"".join(pick.choice(alphabet) for _ in range(pick.randint(least, most))) for _ in range(number)})


def test_position_index_against_all_pairs():
    words = some_words(1, 300) + ["aaaaaa", "aaaaaaa", "a" * 70, "a" * 71, "a" * 69 + "b"]
    words = sorted(set(words))
    index = PositionIndex(words)
    import numpy as np
    everyone = spelling._bits(np.ones(len(words), bool))
    for at, word in enumerate(words):
        for half in (3, len(word) // 2):
            for first in (True, False):
                bits = index.near(np.array([at]), everyone, half, first).view(np.uint8)
                found = {words[i] for i in np.flatnonzero(np.unpackbits(bits, bitorder="little")[:len(words)])}
                assert found == {w for w in words if one_edit(word, w) and (w[:half] == word[:half]) == first}


@pytest.mark.parametrize("cell", [4096, 16, 3])
def test_against_all_pairs_whatever_the_cells(spark, cell):
    words = some_words(2, 400)
    counts = {w: 5 + i % 7 for i, w in enumerate(words)}
    df = spark.createDataFrame(pd.DataFrame({"word": words, "n": [counts[w] for w in words]}), "word string, n long")
    found = {r.word: (r.n_near, r.other_n, r.other) for r in near_words(df, Shape(cell=cell)).collect()}
    expected = {}
    for a in words:
        near = [b for b in words if one_edit(a, b)]
        if near:
            best = min(near, key=lambda b: (-counts[b], b))
            expected[a] = len(near), counts[best], best
    assert found == expected


def test_documents_against_brute_force(docs):
    pick, rows = random.Random(3), []
    stems = ["schooner", "Schooners", "lantern", "lanterns", "naïveté", "naivete", "harbour", "harbor", "ÀÉÎõü", "abc", "x"]
    often = [stems[0]] * 30 + [stems[2]] * 20 + [stems[6]] * 25 + stems
    for i in range(700):
        rows.append((i, " ".join(pick.choice(often) for _ in range(pick.randint(1, 12))) + "."))
    rows += [(None, "schooner lanterm " * 6), (None, None), (9000, ""), (9001, "1 2 3!"), (9002, "schoonerschooner " * 5),
             (9003, "q" * 100_000), (7, rows[7][1])]
    result = got(docs(rows, word="w", n=1, form="f", run="r"))
    assert result == brute(rows)
    assert any(r[1] for r in result) and any(r[2] != r[0] for r in result)
    assert got(docs(rows), Shape(every=3, least_n=2)) == brute(rows, Shape(every=3, least_n=2))


def test_forms_are_followed_to_the_last_and_ties_go_to_the_smaller_word(docs):
    rows = [(i, t) for i, t in enumerate(["aaaaaab " * 5, "aaaaabb " * 25, "aaaabbb " * 125, "zzzzzza " * 5 + "zzzzzzb " * 30 + "zzzzzzc " * 30])]
    result = {r[0]: r for r in got(docs(rows), Shape(every=2 ** 40))}
    assert result["aaaaaab"][1:3] == ("aaaaabb", "aaaabbb") and result["aaaabbb"][1:3] == (None, "aaaabbb")
    assert result["zzzzzza"][1] == "zzzzzzb"


def test_empty_tables(docs):
    assert got(docs([])) == [] and got(docs([(1, None), (2, "short words only")])) == []
