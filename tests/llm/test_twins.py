"""Every registered query of the subpackage: against its SQL twin, or for the shape that its contract states."""

import duckdb
import pytest

from sluiceway.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
LONG, TEXT, FRACTION, TRUTH, INT = "bigint", "string", "double", "boolean", "int"

#: The columns that each contract names.
COLUMNS = {
    "op4_decontamination": {"doc_id": LONG, "item_id": LONG, "distance": INT, "found_end": LONG},
    "op7_ann": {"query_id": LONG, "rank": INT, "vec_id": LONG, "score": FRACTION},
    "op8_quality": {"doc_id": LONG, "held_out": TRUTH, "score": FRACTION, "predicted": INT},
    "op9_lm_scoring": {
        "doc_id": LONG, "held_out": TRUTH, "n_tokens": LONG, "n_known": LONG, "train_tokens": LONG, "base_score": FRACTION, "score": FRACTION,
    },
}


def value(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in df.columns]
    got = sorted((tuple(map(value, r)) for r in df.collect()), key=repr)
    assert got == sorted((tuple(value(r[i]) for i in order) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    assert dict(QUERIES[name](spark, SF).dtypes) == COLUMNS[name]
