"""Plan-shape checks: what the README claims about the physical plans.

Every registered query (forest and stream keys aside, whose result is read
back from written tables) must stay JVM-side and pair rows only by keys:
no Python UDF evaluation, no cartesian product, no nested-loop join. A few
headline queries must also prune and push their scans.
"""

import re

import pytest

from cardsentry.plans.catalog import queries

SF = "/root/testdata/sf0.001"

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"]


def _plan(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _keys():
    return sorted(k for k in queries() if not k.startswith(("ml_", "stream_")))


@pytest.fixture(scope="module")
def plans(spark):
    qs = queries()
    return {k: _plan(spark, qs[k](spark, SF)) for k in _keys()}


def test_no_python_udf_or_pairing_without_keys(plans):
    bad = {k: [op for op in FORBIDDEN if op in p] for k, p in plans.items()}
    assert {k: v for k, v in bad.items() if v} == {}


def test_frauds_by_state_prunes_and_pushes(plans):
    p = plans["frauds_by_state"]
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    events = [s for s in schemas if "event_id" in s]
    # only the columns the report needs reach the reader: never the free-text props
    assert events and all("props" not in s for s in events)
    assert "TakeOrderedAndProject" in p


def test_previous_day_range_reaches_the_scan(plans):
    p = plans["daily_report_rows"]
    pushed = " ".join(re.findall(r"PushedFilters: \[([^\]]*)\]", p))
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed


def test_kpi_is_one_partial_and_final_aggregate(plans):
    p = plans["kpi_totals"]
    assert "SortMergeJoin" not in p and "Window" not in p
    assert len(re.findall(r"HashAggregate", p)) >= 2  # partial (map side) + final


def _exchanges(plan: str) -> int:
    """Shuffles of a plan, each counted once."""
    return len(set(re.findall(r"^\((\d+)\) Exchange", plan, re.M)))


def test_charts_of_labels_join_no_payments(plans):
    for key in ("probability_histogram", "fraud_vs_legit", "daily_counts_pivot"):
        assert "cc_num" not in plans[key] and _exchanges(plans[key]) <= _exchanges(plans["kpi_totals"]) + 2


def test_recent_lists_take_the_top_before_the_join(plans):
    for key in ("recent_predictions", "recent_alerts"):
        assert "TakeOrderedAndProject" in plans[key] and "LeftSemi" not in plans[key]


def test_quartiles_take_few_shuffles(plans):
    # value and range tables are written before; what is left ranks inside their partitions
    assert _exchanges(plans["amount_quartiles"]) <= 8
