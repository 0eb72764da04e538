"""Every registered query beside its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import compare_tables
from wayfare.catalogue.oracle import ORACLE_SQL as SQL
from wayfare.catalogue.queries import QUERIES


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got) > 0
    assert compare_tables(got, con.sql(SQL[name]).df()) == ""


def test_entry_is_the_hour_profile(spark):
    assert entry.entry(spark).columns[0] == "pickup_hour"
