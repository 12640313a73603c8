import os
import re

import pytest

import __spark_entry__ as registered
from starload.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
#: The columns that each query has at least.
COLUMNS = {
    1: "doc_id held_out score predicted", 2: "conv_id turn own_text reply_to thread", 3: "doc_id n_shingles component_id kept",
    4: "doc_id held_out score predicted", 5: "doc_id matches is_contaminated", 6: "doc_id slot shard",
    7: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    8: "page_id host path rule verdict", 9: "doc_id held_out lang_pred score", 10: "doc_id size source_size target taken",
    11: "word form root n n_near form_n", 12: "vec_id n_links component_id kept",
    13: "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256"}


def test_every_operator_has_one_registered_query():
    numbers = sorted(int(re.fullmatch(r"op(\d+)_\w+", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(registered.queries())
    assert set(ORACLES) <= set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", [n for n in QUERIES if n != "op11_spelling"])
def test_one_row_per_row_of_the_table(spark, name):
    number = int(re.match(r"op(\d+)", name)[1])
    table = {2: "conversations", 8: "pages", 12: "embeddings"}.get(number, "documents")
    found = QUERIES[name](spark, SF)
    assert set(COLUMNS[number].split()) <= set(found.columns)
    assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
