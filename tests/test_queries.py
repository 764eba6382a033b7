"""Every registered query of the library at sf0.001: it agrees with its DuckDB oracle on names, rows and values."""

import duckdb
import pytest

import __spark_entry__ as E
from millrace.plans import catalog
from tests.conftest import SF
from tools.check import rows_of

TABLES = "documents pages conversations labels benchmark orders lineitem".split()

catalog.load_all()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"doc_id", "score", "rank"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_its_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLES:
        assert name == "str_stem" and got
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rel = con.sql(catalog.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, got) == rows_of(rel.columns, rel.fetchall())
