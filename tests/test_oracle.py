"""Every registered query against its SQL twin on the smallest generated tables."""

import os

import pytest
from check_oracle import connect, differences

from abacist.plans.catalog import QUERIES
from abacist.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated tables are absent")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, duck, name):
    assert differences(spark, duck, name, SF_DIR) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[0] == "user_name"
    # corpus queries may have no twin, but no twin stands alone
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
