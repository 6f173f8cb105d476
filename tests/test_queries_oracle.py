"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

from tools.check_oracle import compare, duck
from trustgrid.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(spark, con, REGISTRY[name], SF)
    assert not problems, problems
