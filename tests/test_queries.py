"""Every registered query against its check SQL at the smallest scale, and plan rules."""

import os
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from reviewloom import catalog  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    from check import connect

    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    from check import compare

    _rows, ok, note = compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok is not False, note


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "coverage_pct" in df.columns


@pytest.mark.parametrize("name", ["flagship_tagged_category_coverage", "f04_category_rollup", "f13_market_stats", "f15_price_histogram", "h01_vendor_upsert",
                                  "h04_insert_ignore_known", "i01_first_by_key", "e12_package_scalars", "l02_coverage_gap", "k10_alerts"])
def test_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["a04_table_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
