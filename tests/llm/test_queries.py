"""The registered queries of the folder against their SQL, and which of them have none."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from quayside.llm import queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


def test_all_are_registered():
    registered = contract.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered)
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in registered) == 1
    assert contract.corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(contract.oracle_sql()[name])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    expected = sorted(tuple(str(row[i]) for i in order) for row in result.fetchall())
    assert sorted(tuple(str(row[c]) for c in columns) for row in df.collect()) == expected
