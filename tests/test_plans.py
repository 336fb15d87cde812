"""Plan properties the scale design relies on (read from ``explain``)."""

import contextlib
import io

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL

QUERIES = entry_mod.queries()


def plan_text(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_retention_filter_reaches_the_scan(spark):
    plan = plan_text(QUERIES["retention"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_recent_kpis_push_the_time_bound(spark):
    plan = plan_text(QUERIES["kpi_last_24h"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts," in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_text(QUERIES["text_pii_scan"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_pit_fact_broadcasts_small_dimensions(spark):
    plan = plan_text(QUERIES["pit_fact_sales"](spark, SF_SMALL), "simple")
    assert plan.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan
    # one shuffle for the ordered dedupe; the joins move no fact rows
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_nested_loop_or_python_udf(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL), "simple")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
