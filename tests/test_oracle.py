import os

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    sqls = contract.oracle_sql()
    assert compare(spark, duck, name, contract.queries()[name], sqls[name], SF).startswith("ok")


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
