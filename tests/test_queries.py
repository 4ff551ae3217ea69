"""Every registered query against its check, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from carelake.plans import all_queries
from tests.helpers import TABLES, table_rows

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_a_check():
    queries, checks = all_queries()
    assert set(queries) == set(checks)
    assert set(queries) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER).toArrow()
    expected = duck.sql(entry.oracle_sql()[name]).to_arrow_table()
    assert table_rows(got) == table_rows(expected)


def _optimised(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["rank_codes", "period_prefix_filter", "series_by_period"])
def test_period_is_filtered_below_the_join(spark, name):
    below = _optimised(spark, name).split("Join FullOuter")[1]
    filters = [line for line in below.splitlines() if "Filter" in line and "year(" in line]
    assert len(filters) == 2


@pytest.mark.parametrize("name", ["rank_hospitals", "hospital_profile"])
def test_hospital_readers_leave_the_registry_out(spark, name):
    assert "Join" not in _optimised(spark, name)
