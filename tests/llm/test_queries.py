"""The llm queries run over small tables, and agree with their SQL where there is some."""

import os

import duckdb
import pytest

from vellumine.llm.confusables import look
from vellumine.llm.oracle import oracle_sql
from vellumine.llm.queries import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
FOUND = {
    "p2_found": {"kind": "string", "name_lo": "string", "name_hi": "string"}, "p3_found": {"tbl": "string", "row_key": "bigint", "damage": "string"},
    "p4_found": {"tbl": "string", "key_lo": "bigint", "key_hi": "bigint"}, "p5_found": {"item_id": "bigint", "line_no": "int"},
    "p6_found": {"doc_id": "bigint", "item_id": "bigint"}, "p7_found": {"mix_id": "bigint", "source": "string"}, "p8_found": {"doc_id": "bigint"},
}


@pytest.mark.parametrize("name", sorted(FOUND))
def test_columns_and_distinct_rows(spark, name):
    df = queries()[name](spark, SF)
    assert dict(df.dtypes) == FOUND[name]
    rows = df.collect()
    assert rows and len(rows) == len(set(rows))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    result = con.execute(oracle_sql()[name])
    at = [[x[0] for x in result.description].index(c) for c in cols]
    order = lambda row: [(x is not None, round(x, 6) if isinstance(x, float) else str(x)) for x in row]
    got, wanted = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=order), sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=order)
    assert len(got) == len(wanted) and all(a == b or a == pytest.approx(b) for a, b in zip(got, wanted))


def test_one_form_of_both_tables(spark):
    got = queries()["p4_one_form"](spark, SF)
    assert dict(got.dtypes) == {"tbl": "string", "key": "bigint", "look": "string"}
    got, con = got.collect(), duckdb.connect()
    for tbl, key, text in (("content_list", "item_id", "text"), ("ref_records", "ref_key", "raw_text")):
        dealt = con.execute(f"SELECT {key}, {text} FROM '{SF}/{tbl}.parquet'").fetchall()
        order = lambda x: (x[0], x[1] is not None, x[1] or "")
        assert sorted(((r["key"], r["look"]) for r in got if r["tbl"] == tbl), key=order) == sorted(((k, None if t is None else look(t)) for k, t in dealt), key=order)
