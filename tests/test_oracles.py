"""Every registered query against its SQL at the smallest scale, and the driver contract."""

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as contract
from workload import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.oracle
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    assert oracle.differences(contract.queries()[name](spark, SF), duck, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
