"""Every registered query against its SQL on the smallest driver tables, and what its plan may hold."""

from __future__ import annotations

import pytest

from rostrum_testing import SF
import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_contract(spark):
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).columns == ["first_name", "last_name", "party", "state", "district", "date"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    assert difference(spark, con, SF, name) == ""


@pytest.mark.parametrize("name", ["votes_clean", "bills_clean", "house_clean", "house_votes_xml", "bill_details_html"])
def test_plan_stays_in_the_jvm(spark, name):
    plan = driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "Cartesian", "BroadcastNestedLoop", "SortMergeJoin"):
        assert node not in plan


def test_scan_reads_only_what_a_feed_needs(spark):
    plan = driver.queries()["fix_types"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan


def test_dimension_filter_reaches_the_scan(spark):
    plan = driver.queries()["house_rows_before"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan
