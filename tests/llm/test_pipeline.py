import hashlib
import itertools
import random
from collections import Counter

import corpus_pipeline
from llm.llm_data import prose
from pyspark.sql import functions as F

from starload.llm import toxicity
from starload.llm.mixing import targets


BAD = ["villain", "scoundrels", "rotter", "blackguard"]


def test_all_stages_on_planted_cases(spark, tmp_path):
    pick, rows, marks = random.Random(6), [], []
    passages = [" ".join(prose(5000 + i, 30)) for i in range(4)]
    for i in range(300):
        words, toxic = prose(i, pick.randint(15, 90)), i % 10 == 0
        if toxic:
            for _ in range(4):
                words.insert(pick.randrange(len(words)), pick.choice(BAD))
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 1))
        marks.append((i, 1, int(toxic)))
    copies = [(400 + i, rows[i][1] + (" tail" if i % 2 and len(rows[i][1].split()) > 40 else ""), "en", "s1", 1) for i in range(1, 60, 3)]
    leaks = [(500 + i, " ".join(prose(700 + i, 20)) + " " + passages[i % 4], "en", "s2", 1) for i in range(8)]
    toxic = [(600 + i, " ".join(prose(800 + i, 20) + BAD), "en", "s0", 1) for i in range(8)]
    sf_dir = str(tmp_path)
    spark.createDataFrame(rows + copies + leaks + toxic, "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{sf_dir}/out-{name}")
        docs = spark.read.parquet(f"{sf_dir}/out-{name}")
        kept[name] = docs.toPandas()
        assert list(docs.columns) == (columns if name != "sharding" else [*columns, "slot", "shard"])
    clean = {i for i in range(300) if i % 10}
    assert not set(kept["toxicity"].doc_id) & {r[0] for r in toxic}
    assert clean <= set(kept["near_dedup"].doc_id) and not set(kept["near_dedup"].doc_id) & {r[0] for r in copies}
    assert not set(kept["decontamination"].doc_id) & {r[0] for r in leaks} and clean <= set(kept["decontamination"].doc_id)
    assert set(kept["mixing"].doc_id) <= set(kept["decontamination"].doc_id)
    assert len(kept["sharding"]) == len(kept["mixing"]) and kept["sharding"].groupby("doc_id").shard.nunique().max() == 1
    rerun = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert sorted(rerun.doc_id) == sorted(kept["sharding"].doc_id)
    assert corpus_pipeline.ORACLE_SQL is None


def five_word_sets(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(*[words[i:] for i in range(5)])) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def groups_of(texts):
    """For each text the places of its group: near copies by all pairs, and what they reach."""
    sets, group = [five_word_sets(t) for t in texts], list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = root(i), root(j)
            group[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def odd_corpus():
    pick, rows, marks = random.Random(16), [], []
    passages = [" ".join(prose(5000 + i, 30)) for i in range(3)]
    for i in range(90):
        words = prose(i, pick.randint(8, 60))
        if i % 9 == 0:
            for _ in range(4):
                words.insert(pick.randrange(len(words)), pick.choice(BAD))
        rows.append((i, " ".join(words), f"s{i % 3}" if i % 4 else None))
        marks.append((i, 1, int(i % 9 == 0)))
    near = [(200 + i, rows[i][1] + " x", "s1") for i in range(1, 40, 4)]
    leaks = [(300 + i, "before " + passages[i % 3][:-(i % 2) or None] + " after " + " ".join(prose(900 + i, 5)), "s2") for i in range(6)]
    odd = [(None, None, None), (None, rows[5][1], "s0"), (None, rows[5][1], "s0"), (7, rows[7][1], "s1"), (7, rows[7][1], "s1"),
           (7, "another text under a known id", "s1"), (400, "", "s2"), (401, None, "s2"), (402, " \n\t ", None), (403, "one", "s0"),
           (404, "ONE", "s0"), (405, " ".join(prose(77, 20_000)), "s2"), (406, ">" * 2000 + "=" * 2000, None)]
    return rows + near + leaks + odd, marks + [(None, 1, 1), (5, None, None)], passages


def written(spark, folder, rows, marks, passages):
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, source string, lang string")
    docs = docs.withColumns({c: F.lit(c) for c in ("row", "label", "node", "component_id", "matches", "_copies", "key", "range", "s")})
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_every_stage_against_brute_force_with_odd_rows(spark, tmp_path):
    rows, marks, passages = odd_corpus()
    folder = str(tmp_path)
    docs = written(spark, folder, rows, marks, passages)
    columns, before = docs.columns, docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        judged = {r.doc_id: r.predicted for r in toxicity.judged(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
        stage(spark, docs, folder).write.parquet(f"{folder}/odd-{name}")
        docs = spark.read.parquet(f"{folder}/odd-{name}")
        after = docs.collect()
        texts, left = [r.text for r in before], Counter((r.doc_id, r.text) for r in after)
        if name == "toxicity":
            assert left == Counter((r.doc_id, r.text) for r in before if r.doc_id is None or r.doc_id == 7 or not judged[r.doc_id])
        elif name == "near_dedup":
            chosen = {}
            for place, group in enumerate(groups_of(texts)):
                key = group if five_word_sets(texts[place]) else ("own", place)
                row = before[place]
                rank = (row.doc_id is None, row.doc_id or 0, hashlib.sha256((row.text or "").encode()).hexdigest())
                if key not in chosen or rank < chosen[key][0]:
                    chosen[key] = (rank, (row.doc_id, row.text))
            assert left == Counter(row for _, row in chosen.values())
        elif name == "decontamination":
            clean = [r for r in before if not any(leaked(p, r.text) for p in passages)]
            assert left == Counter((r.doc_id, r.text) for r in clean) and len(clean) < len(before)
        elif name == "mixing":
            there = Counter((r.doc_id, r.text) for r in before)
            assert all(n <= 2 * there[row] for row, n in left.items())
            size = Counter()
            for r in before:
                size[r.source] += len((r.text or "").split())
            for source, target in targets(list(size.items())):
                words = [len(r.text.split()) for r in after if r.source == source and r.text]
                # What is missing is less than a word, or than any document that could be taken once more.
                more = [len(r.text.split()) for r in before if r.source == source and r.text and left[r.doc_id, r.text] < 2]
                gap = target - sum(words)
                assert gap >= 0 and (gap < 1 or all(n == 0 or n > gap for n in more))
        else:
            assert left == Counter((r.doc_id, r.text) for r in before)
        assert docs.columns[:len(columns)] == columns
        before = after


def leaked(passage, text):
    """The passage with at most a tenth of its characters edited, anywhere in the text: cell by cell."""
    text, most = " ".join((text or "").lower().split()), len(passage) // 10
    if passage in text or len(text) > 5000:
        return passage in text
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row) <= most


def test_empty_tables(spark, tmp_path):
    rows, marks, passages = odd_corpus()
    for name, given in (("none", ([], [], [])), ("no-labels", (rows[:20], [], passages)), ("no-benchmark", (rows[:20], marks, []))):
        (tmp_path / name).mkdir()
        docs = written(spark, str(tmp_path / name), *given)
        got = corpus_pipeline.run(spark, str(tmp_path / name))
        assert got.columns[:len(docs.columns)] == docs.columns and (got.count() > 0) == bool(given[0])
