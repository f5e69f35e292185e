"""Every query with SQL of its own, against DuckDB on the smallest tables."""

import decimal
import datetime
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# whole intakes take seconds each, so the suite runs the ones that differ most
SLOW = {
    f"load_{t}"
    for t in ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events", "conversations")
} | {"load_audit_log", "load_rejected_checks", "load_latest_view", "log_stamps", "newest_loads"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')")
    return con


def plain(value):
    if value is None:
        return "<null>"
    if isinstance(value, decimal.Decimal) and value == value.to_integral():
        return str(int(value))
    if isinstance(value, float):
        return repr(round(value, 6))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


OWN = set(contract.queries()) - set(contract.LLM_QUERIES)


def test_every_query_has_sql():
    assert set(contract.oracle_sql()) - set(contract.LLM_ORACLE) == OWN


@pytest.mark.parametrize("name", sorted(OWN - SLOW))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(contract.oracle_sql()[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == expected
