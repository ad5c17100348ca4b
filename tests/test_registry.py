"""Every registered query against its SQL counterpart on the given tables."""

import os

import pytest

import __spark_entry__ as entry_module
from stratafold.registry import spark_queries, sql_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(rows, order):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def test_every_query_has_sql():
    assert set(spark_queries.QUERIES) == set(sql_queries.QUERIES)
    assert set(spark_queries.QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(spark_queries.QUERIES))
def test_query(spark, duck, name):
    frame = spark_queries.QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    found = frame.select(*columns).collect()
    cursor = duck.execute(sql_queries.QUERIES[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(described) == columns
    assert {c: TYPES[t] for c, t in frame.dtypes} == described
    expected = cursor.fetchall()
    names = list(described)
    assert comparable(found, range(len(columns))) == comparable(expected, [names.index(c) for c in columns])
    assert found, "the query should give rows even on the smallest tables"
