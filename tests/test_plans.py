"""Physical-plan properties of every registered query (scale discipline).

- no Python evaluation nodes (UDFs), no cartesian products, and no Expand
  (several distinct aggregates in one pass);
- nested-loop joins only where a one-row aggregate is attached;
- sort-based aggregation only where a string sits in an aggregation buffer
  over already-reduced rows (documented per key below);
- scans read only the columns a query needs and receive its filters.
"""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE

SKIP = {"l2_ingest", "k4_model", "k5_model_metrics", "k6_scoring", "k8_importances"}  # run jobs while planning

# one-row aggregates attached with a broadcast nested-loop join
ONE_ROW_CROSS = {"e9_kpis", "e9_breakdown", "b15_rescale", "b16_enrol", "k5_metrics"}

# string in an aggregation buffer:
#   keep-first min(struct(...)) over the exposure log (B13 family),
#   min(variant) over arm rows (I5), max(device_type) over user-day rows
#   (H1 and K1 families), min(plan) over subscriptions
SORT_AGG = {"b13_keep_first", "b14_sample", "b14_sample_exact", "b15_rescale", "b16_enrol", "i5_report", "i5_variants", "k1_features",
            "k2_codes", "k3_split", "k7_rule_score", "k5_metrics", "b17_billing"}


def _plan(spark, name):
    df = E.queries()[name](spark, SMOKE)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SKIP))
def test_plan_properties(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "Expand"):
        assert bad not in plan, bad
    if "BroadcastNestedLoopJoin" in plan:
        assert name in ONE_ROW_CROSS
    if "SortAggregate" in plan:
        assert name in SORT_AGG


def test_active_users_prunes_columns(spark):
    plan = _plan(spark, "e2_active")
    schemas = re.findall(r"user_days\[([^\]]*)\] Batched", re.sub(r"#\d+L?", "", plan))
    assert schemas and all(set(s.replace(" ", "").split(",")) <= {"user_id", "session_rows", "last_start"} for s in schemas)


def test_mrr_pushes_date_filter(spark):
    plan = _plan(spark, "e3_mrr")
    assert re.search(r"PushedFilters: \[[^\]]*payment_date", plan)


def test_raw_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "b8_unique")
    assert re.search(r"FileScan parquet \[l_orderkey,l_linenumber\]", re.sub(r"#\d+L?", "", plan))


def _segments(plan: str):
    """(exchange line, lines of its subtree down to the next exchange)."""
    lines = plan.splitlines()

    def depth(s: str) -> int:
        return len(s) - len(s.lstrip(" :+-"))

    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(" not in line:
            continue
        d, seg = depth(line), []
        for nxt in lines[i + 1:]:
            if depth(nxt) <= d:
                break
            if "Exchange" in nxt:
                break
            seg.append(nxt)
        yield line, seg


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SKIP))
def test_facts_are_combined_before_user_shuffles(spark, name):
    """A fact's raw rows never cross a shuffle keyed by user_id alone: a
    partial aggregate combines them first, so a user holding a third of all
    rows sends one row per map task, not a third of the table to one task."""
    plan = re.sub(r"#\d+L?", "", _plan(spark, name))
    for head, seg in _segments(plan):
        if not re.search(r"hashpartitioning\(user_id, \d+\)", head):
            continue
        body = "\n".join(seg)
        if re.search(r"FileScan parquet \S*fact_(sessions|events|payments)", body):
            assert "Aggregate" in body, (name, head)
