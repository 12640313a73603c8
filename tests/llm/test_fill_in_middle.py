import hashlib
import random
import re

import numpy as np
from llm.llm_data import prose, sorted_rows

from starload.llm import fill_in_middle as fim
from starload.llm.fill_in_middle import Fenwick, Units, digests, transformed

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def expected(doc_id, text):
    """The contract, over the list of all units."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 20:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


ODD = [None, "", " ", "abc", "a<P>b", "<S", "P>", "<<M<P", "ab\ncd\r\n\n", "né à \U0001F600\U0001F600 ok", "中文字符。" * 50, "é",
       "x" * 10_000, "é" * 10_000, "<" * 9_000, "\x00a\x7fb"]


def test_cuts_of_every_block_size_against_the_list_of_units():
    pick = random.Random(1)
    for text in [t or "" for t in ODD[:11]] + [" ".join(prose(i, 40)) + " é中\U0001F600" * (i % 3) for i in range(6)]:
        units = UNIT.findall(text)
        for block in (1, 2, 3, 7, 64, 4096):
            found = Units(text.encode(), block)
            assert (found.n, found.chars) == (len(units), len(text))
            for k in {0, 1, len(units), *(pick.randint(0, len(units)) for _ in range(20))}:
                head = "".join(units[:k])
                assert found.cut(min(k, len(units))) == (len(head.encode()), len(head))


def test_fenwick_finds_the_block_of_every_number():
    pick = np.random.default_rng(2)
    for size in (1, 2, 5, 16, 33):
        counts = pick.integers(0, 3, (size, 2))
        tree, sums = Fenwick(counts), np.cumsum(counts, axis=0)
        for number in range(1, int(sums[-1, 0]) + 1):
            block = int(np.searchsorted(sums[:, 0], number))
            place, before = tree.find(number)
            assert place == block and before.tolist() == (sums[block] - counts[block]).tolist()


def test_against_the_contract_and_back(docs):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "ab cd"), (None, None), (3, "abc"), (3, "abc")]
    rows += [(100 + i, " ".join(prose(i, 30)) + ("\n<tag> é" * (i % 4))) for i in range(150)]
    df = docs(rows, n=7, form="?", output="x", fim=1, prefix_chars="y")
    got = sorted_rows(transformed(df).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output"))
    assert got == sorted([(i, *expected(i, t)) for i, t, *_ in rows], key=repr)
    assert {f for _, _, f, *_ in got} == {"plain", "psm", "spm"}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    hashed = sorted_rows(digests(df).select("doc_id", "form", "output_sha256", "restored_sha256"))
    assert hashed == sorted([(i, expected(i, t)[1], sha(expected(i, t)[4]), sha(t)) for i, t, *_ in rows], key=repr)


def test_long_text_and_empty_table(docs):
    long = " ".join(prose(3, 300_000)) + "é" * 10
    found = Units(long.encode())
    assert found.n == len(UNIT.findall(long))
    (row,) = digests(docs([(5, long)])).collect()
    assert row.restored_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert digests(docs([])).collect() == []


def test_other_shapes(docs):
    df = docs([(i, "ab cd ef") for i in range(60)])
    forms = {r.form for r in transformed(df, fim.Shape(seed=2, cut_percent=100, suffix_first_percent=100)).collect()}
    assert forms == {"spm"}
    assert {r.output for r in transformed(df, fim.Shape(cut_percent=0)).collect()} == {"ab cd ef"}
