"""Physical-plan properties every registered query must keep (scale guards)."""

import collections
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

QUERIES = E.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_properties(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = collections.Counter(re.findall(r"testdata/sf0\.001/(\w+)\.parquet", plan))
    multi = {t for t, n in scans.items() if n > 1}
    assert not multi, f"raw tables scanned more than once: {multi}"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan   # no cross joins
    assert "BatchEvalPython" not in plan                                              # no row-at-a-time UDFs


def _raw_scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return collections.Counter(re.findall(r"testdata/sf0\.001/(\w+)\.parquet", plan))


def test_consolidation_reads_each_raw_table_once(spark):
    """Behind the written intermediates too: lineitem once, orders once for its day moments and once for
    the distinct customers a month."""
    from wattle.plans import consolidate as C
    from wattle.plans import materialize as M
    from wattle.session import apply_runtime_conf
    from wattle.sources import standins
    apply_runtime_conf(spark)
    assert _raw_scans(C.consolidated(spark, SF_SMALL)) == {"events": 1, "orders": 1}
    assert _raw_scans(standins.order_days(spark, SF_SMALL)) == {"orders": 1}
    assert _raw_scans(standins.shipped_months(spark, SF_SMALL)) == {"lineitem": 1}
    assert not _raw_scans(standins.carbon_sheet(M.order_days_table(spark, SF_SMALL)))


@pytest.mark.parametrize("name", ["sampled_scan", "yearly_column_profile"])
def test_first_readings_are_pushed_to_the_scan(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*(GreaterThanOrEqual|LessThan)\(ts,", plan), plan
