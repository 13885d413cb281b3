"""Every registered query against its SQL on DuckDB."""

import os

import pytest

import __spark_entry__ as entry
import check

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    outcome = check.compare(spark, db, name, FOLDER)
    assert outcome.startswith(("ok", "rows")), outcome


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
