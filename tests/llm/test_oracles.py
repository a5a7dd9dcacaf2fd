"""The queries that SQL expresses, against DuckDB; and what the registry promises."""

import re

import compare
import pytest

from footfall.llm.oracles import ORACLES
from footfall.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare.differences(spark, compare.duck(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == []


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert ORACLES.keys() <= QUERIES.keys()
