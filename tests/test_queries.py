"""Every registered query runs and equals its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from suite.check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    status, n, _, note = compare(spark, duck, SF, name, QUERIES[name], ORACLES.get(name))
    assert status in ("ok", "rows", "EMPTY"), f"{status}: {note}"


def test_every_sql_text_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["arrondissement", "annee", "prix_m2_median"]
    assert df.count() > 0
