"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entries
import check
from statloom.workload.queries import QUERIES

SF_DIR = entries.SMOKE_DIR


@pytest.fixture(scope="module")
def db():
    return check.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entries.oracle_sql())
    assert set(entries.oracle_sql()) <= set(entries.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert check.compare(spark, db, SF_DIR, name) is None


def test_entry_has_rows(spark):
    assert entries.entry(spark).count() > 0
