"""Every registered query against its SQL twin."""

from __future__ import annotations

import __spark_entry__ as entry_module
import duckdb
import pytest
from conftest import DATA

from tessera.workload import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(QUERIES) and set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 4


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_twin(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    found = [(d[0], str(d[1])) for d in cursor.description]
    assert sorted(found) == sorted((f.name, TYPES[f.dataType.simpleString()]) for f in df.schema.fields)
    order = [[n for n, _ in found].index(c) for c in columns]

    def sortable(row):
        return tuple((x is None, str(x)) for x in row)

    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=sortable)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=sortable) == expected


@pytest.mark.parametrize("name", ["dual_search", "q10_area_texts", "q14_context_and_texts"])
def test_both_sources_answer(spark, name):
    found = {r.source for r in QUERIES[name](spark, DATA).select("source").collect()}
    assert found == {"search_reviews", "get_neighbourhood_context"}
