"""Every registered query against its SQL counterpart, on the given tables."""

import os

import pytest

import __spark_entry__ as entries
import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are absent")


@pytest.fixture(scope="module")
def duck():
    with compare.connect(SF_DIR) as con:
        yield con


def test_every_query_has_a_counterpart():
    assert set(entries.core_queries()) == set(entries.core_oracle_sql())


@pytest.mark.parametrize("name", sorted(entries.core_queries()))
def test_query(spark, duck, name):
    got_names, got = compare.spark_rows(entries.queries()[name](spark, SF_DIR))
    want_names, want = compare.sql_rows(duck, entries.oracle_sql()[name])
    assert got_names == want_names
    assert len(got) == len(want) and got == want
    assert got


def test_entry_runs(spark):
    assert entries.entry(spark).limit(1).count() == 1
