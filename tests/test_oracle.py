"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts"))

from check_oracle import TABLES, digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from entryflow.plans.catalog import QUERIES  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["email", "name", "entry_time", "day", "participation_number",
                          "promotion"]
    assert df.count() >= 0


def test_every_query_has_oracle_or_reason():
    assert set(QUERIES) <= set(E.oracle_sql())
