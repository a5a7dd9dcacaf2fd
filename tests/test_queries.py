"""Every registered query against its SQL counterpart."""

import compare
import pytest

from footfall.registry.oracles import ORACLES
from footfall.registry.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


def test_every_query_has_a_counterpart():
    assert REGISTRY.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare.differences(spark, con, REGISTRY[name], ORACLES[name], sf_dir) == []


def test_entry(spark):
    import __spark_entry__ as entry_points

    result = entry_points.entry(spark)
    assert result.columns[:4] == ["date", "dau", "wau", "mau"]
    assert result.count() == 30
