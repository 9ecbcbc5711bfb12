"""Every registered query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import pytest

import oracle_check
from readloom import registry


@pytest.fixture(scope="module")
def con(folder):
    return oracle_check.connect(folder)


def test_every_query_has_sql():
    assert set(registry.QUERIES) <= set(oracle_check.SQL)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_sql(spark, con, folder, name):
    verdict, rows = oracle_check.compare(spark, con, folder, name)
    assert verdict == "ok"
    assert rows > 0
