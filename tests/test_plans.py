"""Plan audit of every registered query: no cartesian products, no nested-loop
joins, no row-at-a-time Python; Arrow-batched Python only where a model
needs it."""

import pytest

from conftest import SF_SMALL
from logsift.plans.catalog import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
# The forest scores with it; locations are searched with it.
ARROW_ALLOWED = {"isolation_forest", "clean_logs", "geo_enrich"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_registered_query_plan(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, (key, op)
    if key not in ARROW_ALLOWED:
        assert "ArrowEvalPython" not in plan and "FlatMapGroupsInPandas" not in plan, key


def scans(df):
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    return text.split("== Initial Plan ==")[0].count("FileScan") + text.split("== Initial Plan ==")[0].count("BatchScan")


@pytest.mark.parametrize("key", ["anomaly_report", "anomaly_totals", "common_patterns"])
def test_one_scan(spark, key):
    assert scans(QUERIES[key](spark, SF_SMALL)) == 1
