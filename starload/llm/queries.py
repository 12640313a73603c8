"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starload.llm import (
    cover_tree, decontaminate, fill_in_middle, language, mixing, neardup, ngram_ratio, quality_trees, quotation, sharding,
    spelling, toxicity, url_rules,
)
from starload.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function
    return register


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(r"""
WITH RECURSIVE
     lines AS (
       SELECT conv_id, turn, place, unnest(raws) AS raw, generate_subscripts(raws, 1) AS pos
       FROM (SELECT conv_id, turn, row_number() OVER () AS place,
                    string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS raws FROM conversations)),
     levels AS (
       SELECT conv_id, turn, place, pos, length(regexp_replace(regexp_extract(raw, '^[\s>]*>\s?'), '[^>]', '', 'g')) AS level,
              regexp_replace(raw, '^[\s>]*>\s?', '') AS body FROM lines),
     runs AS (
       SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY place ORDER BY pos) AS run
       FROM (SELECT *, coalesce(level <> lag(level) OVER (PARTITION BY place ORDER BY pos), true) AS fresh FROM levels)),
     passages AS (
       SELECT conv_id, turn, place, level, run, list(body ORDER BY pos) AS bodies FROM runs GROUP BY ALL),
     told AS (
       SELECT place, sum(CASE WHEN level > 0 THEN len(bodies) ELSE 0 END)::BIGINT AS n_quoted_lines,
              count(*) FILTER (level > 0) AS n_quotes, bool_or(level = 0) AS has_own,
              trim(coalesce(array_to_string(flatten(list(bodies ORDER BY run) FILTER (level = 0)), chr(10)), ''), chr(10) || ' ') AS own_text
       FROM passages GROUP BY place),
     units AS (
       SELECT conv_id, turn, level, unnest(list_append(bodies, array_to_string(bodies, ' '))) AS unit FROM passages
       UNION ALL SELECT m.conv_id, m.turn, 0, t.own_text FROM told t
                 JOIN (SELECT DISTINCT conv_id, turn, place FROM levels) m USING (place) WHERE has_own),
     normal AS (
       SELECT DISTINCT conv_id, turn, level, trim(regexp_replace(lower(unit), '\s+', ' ', 'g')) AS unit FROM units
       WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
     quotes AS (
       SELECT conv_id, turn, unit, min(level) AS level, length(unit) AS characters
       FROM normal WHERE level > 0 AND unit <> '' GROUP BY conv_id, turn, unit),
     found AS (
       SELECT q.conv_id, q.turn, q.level, q.unit, any_value(q.characters) AS characters, max(o.turn) AS original
       FROM quotes q JOIN normal o ON o.conv_id = q.conv_id AND o.unit = q.unit AND o.level = 0 AND o.turn < q.turn
       GROUP BY q.conv_id, q.turn, q.level, q.unit),
     weights AS (
       SELECT conv_id, turn, level, original, sum(characters) AS weight, count(*) AS units, max(characters) >= 12 AS long
       FROM found GROUP BY conv_id, turn, level, original),
     replies AS (
       SELECT conv_id, turn, first(original ORDER BY long DESC, level, weight DESC, original DESC)::BIGINT AS reply_to,
              sum(units)::BIGINT AS n_linked FROM weights GROUP BY conv_id, turn),
     up AS (
       SELECT conv_id, turn, reply_to AS thread, 1::BIGINT AS depth FROM replies
       UNION ALL SELECT up.conv_id, up.turn, r.reply_to, up.depth + 1
                 FROM up JOIN replies r ON r.conv_id = up.conv_id AND r.turn = up.thread),
     tops AS (SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM up GROUP BY conv_id, turn)
SELECT m.conv_id, m.turn, m.role, CASE WHEN m.text IS NOT NULL THEN told.own_text END AS own_text, told.n_quoted_lines,
       told.n_quotes, coalesce(r.n_linked, 0) AS n_linked, r.reply_to, coalesce(t.thread, m.turn::BIGINT) AS thread,
       coalesce(t.depth, 0) AS depth
FROM (SELECT *, row_number() OVER () AS place FROM conversations) m JOIN told USING (place)
     LEFT JOIN replies r ON r.conv_id = m.conv_id AND r.turn = m.turn
     LEFT JOIN tops t ON t.conv_id = m.conv_id AND t.turn = m.turn
""")
def op2_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.linked_conversations(table(spark, sf_dir, "conversations"))


#: Reachable over links, the own id included; `links` and `nodes` come before it.
REACHED_SQL = """
     reached AS (
       SELECT id, id AS other FROM nodes
       UNION SELECT reached.id, links.b FROM reached JOIN links ON links.a = reached.other)
"""


@query(f"""
WITH RECURSIVE
     words AS (
       SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     sets AS (
       SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
                ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
     grams AS (SELECT doc_id, len(s) AS size, unnest(s) AS gram FROM sets),
     links AS (
       SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id
       GROUP BY x.doc_id, y.doc_id, x.size, y.size HAVING 100 * count(*) >= 80 * (x.size + y.size - count(*))),
     nodes AS (SELECT doc_id AS id FROM documents),
     {REACHED_SQL.strip()}
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT id, min(other) AS component_id FROM reached GROUP BY id) ON id = doc_id
""")
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Shape(words=2))


@query()
def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


@query()
def op7_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_ratio.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
       ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
       ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
     rests AS (
       SELECT page_id, row_number() OVER () AS place,
              CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
       FROM pages),
     parts AS (
       SELECT page_id, place, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
       FROM rests),
     best AS (
       SELECT place, arg_max(rule_host || rule_path, 1000000 * length(rule_host || rule_path) + length(rule_host)) AS rule,
              arg_max(rule_verdict, 1000000 * length(rule_host || rule_path) + length(rule_host)) AS verdict
       FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
       GROUP BY place)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (place)
""")
def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"), url_rules.rule_frame(spark))


@query()
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


@query()
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


#: crc32 by its table, over the bytes of `<doc_id>:<run>`; letters beyond ASCII become single bytes before words are compared.
OP11_SQL = """
WITH RECURSIVE
     polynomial AS (
       SELECT list(list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
       FROM (SELECT unnest(range(256)) AS i)),
     runs AS (
       SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
     own AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 6 GROUP BY ALL),
     hashed AS (
       SELECT run, times, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(octet_length(encode(key))),
                  lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
       FROM (SELECT *, doc_id || ':' || run AS key FROM own), polynomial),
     spelled AS (
       SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, times FROM hashed),
     words AS (
       SELECT word, sum(times)::BIGINT AS n, translate(word, 'LETTERS', 'BYTES') AS bytes
       FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
     near AS (
       SELECT a.word, a.n, b.word AS other, b.n AS other_n
       FROM words a JOIN words b ON abs(length(a.bytes) - length(b.bytes)) <= 1 AND a.word <> b.word
            AND (left(a.bytes, 3) = left(b.bytes, 3) OR right(a.bytes, 3) = right(b.bytes, 3))
       WHERE levenshtein(a.bytes, b.bytes) = 1),
     best AS (
       SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
       FROM near GROUP BY word),
     formed AS (
       SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
              CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
       FROM words w LEFT JOIN best b ON w.word = b.word),
     followed AS (
       SELECT word, word AS at, form FROM formed
       UNION ALL
       SELECT f.word, f.form, g.form FROM followed f JOIN formed g ON f.form = g.word)
SELECT formed.word, formed.form, followed.at AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN followed ON formed.word = followed.word AND followed.form IS NULL
"""
#: The letters from U+00C0 to U+00FF and, for each, an ASCII character that no word has.
HIGH = "".join(map(chr, range(0xC0, 0x100)))
LOW = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.islower() and c not in "'")[:len(HIGH)]


@query(OP11_SQL.replace("LETTERS", HIGH).replace("BYTES", LOW))
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query(f"""
WITH RECURSIVE
     vectors AS (
       SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
       WHERE label IS NOT NULL AND len(embedding) > 0 AND list_max(list_transform(embedding, lambda x: abs(x))) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     links AS (
       SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
       ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.98),
     nodes AS (SELECT vec_id AS id FROM embeddings),
     {REACHED_SQL.strip()},
     numbers AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id, id = min(other) AS kept
FROM reached LEFT JOIN numbers ON numbers.a = id GROUP BY id
""")
def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("""
WITH drawn AS (
       SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
              sha256('1:' || doc_id) AS h FROM documents),
     cut AS (
       SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS a,
              ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS b,
              CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                        OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                   WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
       FROM drawn),
     parts AS (
       SELECT doc_id, text, n, form, array_to_string(units[:least(a, b)], '') AS prefix,
              array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
              array_to_string(units[greatest(a, b) + 1:], '') AS suffix
       FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""")
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))
