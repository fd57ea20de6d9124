"""Every query with an SQL counterpart gives the same rows."""

import pathlib

import pytest

import __spark_entry__ as registered
from tests import oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_matches_sql(spark, con, name):
    got = oracle.from_spark(registered.queries()[name](spark, SF))
    assert got == oracle.from_sql(con, registered.oracle_sql()[name])


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    result = registered.entry(spark)
    assert result.count() > 0
    assert {"score_ens", "threshold", "is_anomaly"} <= set(result.columns)
