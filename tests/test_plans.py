"""Plan checks: no Python worker, no all-rows single-partition exchange,
bounded exchanges in the calendar chain."""

import re

from gridtide.plans import catalog, fixtures
from gridtide.operators import calendar, quality

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_evaluation_in_any_query(spark):
    for name, fn in catalog.QUERIES.items():
        if name in ("csv_load", "batch_rules"):
            continue
        plan = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_batch_rules_share_one_python_stage(spark):
    plan = _plan(catalog.QUERIES["batch_rules"](spark, SF))
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan and "Exchange" not in plan


def test_calendar_chain_exchanges(spark):
    cfg = catalog.FLAGSHIP
    valid = quality.generic_validation(fixtures.telemetry(spark, SF), cfg)[0]
    full = calendar.complete_series(valid, cfg)
    plan = _plan(full)
    # after the explicit repartition by device, no further exchange of calendar rows
    lines = plan.splitlines()
    idx = next(i for i, line in enumerate(lines) if "REPARTITION_BY_NUM" in line)
    assert not any("Exchange" in line for line in lines[:idx])
    assert len(re.findall(r"Sort \[inverter_serial_no#\d+ ASC NULLS FIRST, date_time#\d+ DESC NULLS LAST\]", plan)) == 2


def test_global_previous_does_not_funnel_rows_into_one_partition(spark):
    plan = _plan(catalog.QUERIES["outlier_previous_global"](spark, SF))
    # rows are dealt by their chunk of the order; only the table with a row per chunk may be gathered
    assert "hashpartitioning(__chunk" in plan
    assert plan.count("Exchange SinglePartition") <= 2
