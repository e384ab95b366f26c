"""Every registered query against its SQL twin, values and column types."""

import pytest

import __spark_entry__ as entry
from tidemark.plans.oracle import ORACLE
from tidemark.plans.registry import QUERIES
from tests.oracle_compare import both, connect, difference

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry.queries().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query(spark, con, small_dir, name):
    sql = entry.oracle_sql()[name]
    ours, theirs, types = both(spark, con, entry.queries()[name], sql, small_dir)
    assert not difference(ours, theirs)
    assert ours[1], "no rows compared"
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    assert {n: TYPES[t] for n, t in types.items()} == {row[0]: row[1] for row in described}


def test_entry(spark):
    assert entry.entry(spark).count() == 1
