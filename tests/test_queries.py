"""Every registered query against its DuckDB SQL on the smallest data set; those without SQL must give rows of a stable schema."""

import pytest

from tests.compare import connect, rows
from trackweave.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, db, name):
    got = rows(QUERIES[name](spark, SF).toArrow())
    want = rows(db.sql(ORACLES[name]).to_arrow_table())
    assert got == want


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(ORACLES) <= set(QUERIES) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
