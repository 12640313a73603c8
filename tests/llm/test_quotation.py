from llm.llm_data import prose, sorted_rows

from starload.llm.quotation import linked_conversations, lines_of, passages_of

A, B, C = (" ".join(prose(i, 12)) for i in (1, 2, 3))


def talk(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string, _own int")


def message(conv, turn, text, role="user"):
    return (conv, turn, role, text, "x", 1)


def by_turn(df):
    return {(r.conv_id, r.turn): r for r in df.collect()}


def test_levels_and_passages(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("own\n> one\n>> two\n> > two\n>one again\r\nlast > not",)], "text string")
    lines = df.select(lines_of(F.col("text")).alias("l"), passages_of(lines_of(F.col("text"))).alias("p")).first()
    assert [(x.level, x.body) for x in lines.l] == [
        (0, "own"), (1, "one"), (2, "two"), (2, "two"), (1, "one again"), (0, "last > not")]
    assert [(p.level, p.lines) for p in lines.p] == [
        (0, ["own"]), (1, ["one"]), (2, ["two", "two"]), (1, ["one again"]), (0, ["last > not"])]


def test_replies_threads_and_own_text(spark):
    got = by_turn(linked_conversations(talk(spark, [
        message(1, 0, A), message(1, 1, B), message(1, 2, f"> {A.upper()}\nyes\n"),
        message(1, 3, f">> {A}\n>  yes\nno, and {C}"), message(1, 4, f"> no, and {C}\n>>> {B}\nfine then"),
        message(1, 5, f"> {A}\n> unknown words that nobody wrote"), message(2, 0, f"> {A}\nanother conversation")])))
    assert {t: (r.reply_to, r.thread, r.depth) for (c, t), r in got.items() if c == 1} == {
        0: (None, 0, 0), 1: (None, 1, 0), 2: (0, 0, 1), 3: (0, 0, 1), 4: (3, 0, 2), 5: (0, 0, 1)}
    assert got[1, 2].own_text == "yes" and got[1, 4].own_text == "fine then" and got[1, 5].own_text == ""
    assert got[1, 3].n_quotes == 2 and got[1, 3].n_quoted_lines == 2 and got[1, 5].n_linked == 1
    assert (got[2, 0].reply_to, got[2, 0].thread, got[2, 0].n_linked) == (None, 0, 0)
    order = [t for _, _, t in sorted((c, r.thread, t) for (c, t), r in got.items() if c == 1)]
    assert order == [0, 2, 3, 4, 5, 1]


def test_the_latest_earlier_original(spark):
    got = by_turn(linked_conversations(talk(spark, [
        message(1, 0, A), message(1, 1, A), message(1, 2, f"> {A}\nwhich one"), message(1, 3, A), message(1, 4, f"> {A}\n")])))
    assert got[1, 2].reply_to == 1 and got[1, 4].reply_to == 3


def test_several_lines_and_a_long_chain(spark):
    rows = [message(1, 0, f"{A}\n{B}\n{C}")]
    rows += [message(1, i, f"> line number {i - 1} of the chain\nline number {i} of the chain") for i in range(2, 40)]
    rows[1:1] = [message(1, 1, f"> {A}\n> {B}\n> {C}\nline number 1 of the chain")]
    got = by_turn(linked_conversations(talk(spark, rows)))
    assert got[1, 1].n_linked == 4 and got[1, 39].thread == 0 and got[1, 39].depth == 39


def test_hot_conversation_is_cut(spark, monkeypatch):
    from starload.operators import skew
    rows = [message(7, i, A if i % 2 == 0 else f"> {A}\nanswer {i}") for i in range(400)]
    plain = sorted_rows(linked_conversations(talk(spark, rows)))
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    monkeypatch.setattr(skew.slice_hot_keys, "__defaults__", (50, None))
    assert sorted_rows(linked_conversations(talk(spark, rows))) == plain
    assert {r[7] for r in plain if r[1] == 5} == {4}


def test_edge_cases(spark):
    rows = [message(None, 0, f"> {A}"), message(1, None, f"> {A}\nme"), message(1, 0, None), message(1, 1, ""),
            message(1, 2, ">"), message(1, 2, ">"), message(1, 3, A + "\n" + "word " * 30_000), message(1, 4, f"> {A}\nok", None)]
    got = linked_conversations(talk(spark, rows)).collect()
    assert len(got) == len(rows)
    assert [(r.reply_to, r.role) for r in got if r.turn == 4] == [(3, None)]
    assert [r.own_text for r in got if r.turn == 0 and r.conv_id == 1] == [None]
    assert all(r.reply_to is None for r in got if r.turn != 4)
    assert linked_conversations(talk(spark, [])).collect() == []


def test_short_quotes_are_linked(spark):
    got = by_turn(linked_conversations(talk(spark, [
        message(1, 0, A), message(1, 1, "go ahead"), message(1, 2, "> Go  ahead\nnot sure"), message(1, 3, "> not sure\nok"),
        message(1, 4, "> ok\n> "), message(2, 0, "今天天气很好"), message(2, 1, "> 今天天气很好\n是的"), message(2, 2, "> 是的\n")])))
    assert {k: (r.reply_to, r.thread, r.depth) for k, r in got.items()} == {
        (1, 0): (None, 0, 0), (1, 1): (None, 1, 0), (1, 2): (1, 1, 1), (1, 3): (2, 1, 2), (1, 4): (3, 1, 3),
        (2, 0): (None, 0, 0), (2, 1): (0, 0, 1), (2, 2): (1, 0, 2)}


def test_length_chooses_among_several_originals(spark):
    got = by_turn(linked_conversations(talk(spark, [
        message(1, 0, A), message(1, 1, "ok"), message(1, 2, f"> {A}\n> ok\nboth")])))
    assert got[1, 2].reply_to == 0 and got[1, 2].n_linked == 2


def test_very_many_marks(spark):
    """A pattern with a repeated group would take one call per mark."""
    rows = [(1, 0, "user", "hello there"), (1, 1, "user", ">" * 100_000 + " hello there\nyes"), (1, 2, "user", "> " * 50_000)]
    got = linked_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    found = {r.turn: (r.n_quoted_lines, r.reply_to) for r in got.collect()}
    assert found == {0: (0, None), 1: (1, 0), 2: (1, None)}
