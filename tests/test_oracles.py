"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from foldcast.plans.queries import QUERIES as OWN
from compare import connect, mismatch

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert mismatch(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(OWN) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert [r.fold for r in rows] == list(range(10))


def test_flagship_values(spark):
    """Known values of the minimum slice at sf0.01."""
    rows = QUERIES["seasonal_naive_wmape"](spark, "/root/testdata/sf0.01").orderBy("fold")
    expected = [83.126110, 79.172230, 80.492170, 79.771830, 79.911700, 80.202113, 78.985507,
                81.120145, 80.159081, 80.233463]
    assert [r.wMAPE for r in rows.collect()] == pytest.approx(expected, abs=2e-6)
