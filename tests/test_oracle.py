"""Every query with an oracle matches DuckDB on the same parquet tables (sf0.001)."""

import os

import duckdb
import pytest

from tools.oracle_check import family, rows

from .conftest import SF_SMALL

SLOW = {"linear_regression"}


def _names():
    from __spark_entry__ import oracle_sql

    return sorted(n for n in oracle_sql() if n not in SLOW)


@pytest.fixture(scope="module")
def duck():
    from tabula.session import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries

    sp = queries()[name](spark, SF_SMALL).toPandas()
    dk = duck.execute(oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    for c in sp.columns:
        if not (sp[c].isna().all() or dk[c].isna().all()):
            assert family(sp[c]) == family(dk[c]), c
    assert len(sp) == len(dk)
    assert rows(sp) == rows(dk)


def test_every_query_has_operator_id():
    from tabula.catalog import OPERATOR_IDS, QUERIES

    assert set(QUERIES) == set(OPERATOR_IDS)
    assert all(v.startswith("O-") for v in OPERATOR_IDS.values())


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["fold", "role", "n", "mean_z", "std_z"]
    assert df.count() == 10
