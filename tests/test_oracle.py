"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally)."""

import duckdb
import pytest

import __spark_entry__ as E
from kpiloom.plans.commerce import QUERIES as COMMERCE
from kpiloom.plans.commerce_sql import SQL as COMMERCE_SQL
from kpiloom.plans.student import twin, twin_full
from tests.conftest import SF01

QUERIES = {**COMMERCE, **twin.QUERIES, **twin_full.QUERIES}
SQL = {**COMMERCE_SQL, **twin.SQL, **twin_full.SQL}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    fix = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(fix(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    srows, scols = df.collect(), df.columns
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _norm(scols, srows) == _norm(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "jp_contact_count" in df.columns and "persist_num" in df.columns


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, duck, name):
    spark_types = dict(QUERIES[name](spark, SF01).dtypes)     # schema only, no job
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_types.items()} == duck_types
