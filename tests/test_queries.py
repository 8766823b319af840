"""Every query of the reference's own operators against its SQL."""

import pytest
from oracle import connect, differences

from rasterloom.plans import derived, derived_levels  # noqa: F401  (registers its queries)

SF = __import__("os").environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(derived.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert differences(derived.QUERIES[name](spark, SF), con, derived.SQL[name]) == ""


def test_every_query_has_sql():
    assert set(derived.QUERIES) == set(derived.SQL)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10
