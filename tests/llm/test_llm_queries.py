"""Queries over the whole small tables, against SQL or brute force."""

import pandas as pd
import pytest

from helpers import table
from quipuflow.llm.queries import oracle_sql, queries

COLUMNS = {
    "p1_found": ["page_id", "char_start", "char_end"],
    "p2_found": ["item_table", "item_key", "chunk_index"],
    "p3_found": ["first_id", "copy_id"],
    "p4_found": ["group_id", "head", "head_type", "tail"],
    "p5_found": ["name_a", "name_b"],
    "p6_found": ["page_id", "line_no"],
    "p7_found": ["page_id", "kind", "block_text"],
    "p8_ids": ["doc_id", "ids"],
    "p9_found": ["doc_id", "item_id"],
    "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, data, con, name):
    df = queries()[name](spark, data)
    assert df.columns == COLUMNS.get(name, df.columns)
    got = df.toPandas()
    assert len(got)
    if name in oracle_sql():
        assert table(got) == table(con.execute(oracle_sql()[name]).df())


def test_leaks_and_repetition_of_the_corpus(spark, data):
    from test_llm_units import plain_leaks, plain_share

    d = pd.read_parquet(f"{data}/documents.parquet")
    e = pd.read_parquet(f"{data}/eval_items.parquet")
    from test_llm_units import words

    grams = {}
    for i, t in zip(e.item_id, e.text):
        w = words(t)
        for k in range(len(w) - 9):
            grams.setdefault(tuple(w[k : k + 10]), set()).add(i)
    want = set()
    for i, t in zip(d.doc_id, d.text):
        w = words(t)
        for k in range(len(w) - 9):
            want |= {(i, x) for x in grams.get(tuple(w[k : k + 10]), ())}
    assert {tuple(r) for r in queries()["p9_found"](spark, data).collect()} == want
    assert {r.doc_id for r in queries()["p10_found"](spark, data).collect()} == {i for i, t in zip(d.doc_id, d.text) if plain_share(t) >= 0.3}
    assert plain_leaks([], [], 10) == set()
