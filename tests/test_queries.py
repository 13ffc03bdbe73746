"""Every registered query against its SQL twin, in DuckDB, on the smallest tables."""

import importlib.util
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
spark_entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(spark_entry)

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(value(t[i]) for i in order) for t in tuples), key=repr)


@pytest.mark.parametrize("name", sorted(spark_entry.QUERIES))
def test_query(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF)
    sql = spark_entry.oracle_sql()[name]
    expected = duck.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    assert got == comparable(expected.columns, expected.fetchall())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 1500
