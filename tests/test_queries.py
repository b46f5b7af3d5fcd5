"""Registered queries against their SQL twins on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from tidewheel.plans import registry
from tests.compare import differences, expected, oracle, type_differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    if name in registry.oracles():
        names, kinds, wanted = expected(con, registry.oracles()[name])
        assert differences(df.columns, rows, names, wanted) is None
        assert type_differences(df, names, kinds) == []
    else:
        assert rows


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_names_are_plain():
    assert all(re.fullmatch(r"[a-z0-9_]+", n) for n in entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["country", "avg_daily_mtco2"]
