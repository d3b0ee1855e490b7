"""Physical-plan checks on materialised warehouse tables: no nested-loop or
Cartesian join in any registered query, also in the frames it stages, and the
flagship prunes columns and pushes its filter into the pick-detail scan."""

import sys
import tempfile

import pytest

from dockyard.functions import keys
from dockyard.plans import registry
from dockyard.sources.fixtures import materialise
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def tables(spark):
    d = tempfile.mkdtemp(prefix="dockyard-plans-")
    materialise(spark, SF_SMALL, d)
    return d


@pytest.fixture
def staged_plans(monkeypatch):
    """Plans of the frames given to ``stage`` while a query is built."""
    seen, stage = [], keys.stage

    def spy(df):
        seen.append(_plan(df))
        return stage(df)

    for name, module in list(sys.modules.items()):
        if name.startswith("dockyard.") and getattr(module, "stage", None) is stage:
            monkeypatch.setattr(module, "stage", spy)
    return seen


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_or_cartesian_join(spark, tables, staged_plans):
    bad = []
    for name, fn in registry.queries().items():
        staged_plans.clear()
        plans = [_plan(fn(spark, SF_SMALL, tables)), *staged_plans]
        bad += [(name, k) for k in ("NestedLoop", "Cartesian") if any(k in p for p in plans)]
    assert bad == []


def _built(spark, tables, staged_plans, name):
    staged_plans.clear()
    return [_plan(registry.queries()[name](spark, SF_SMALL, tables)), *staged_plans]


def test_a_reply_is_parsed_once(spark, tables, staged_plans):
    plans = "".join(_built(spark, tables, staged_plans, "message_status"))
    assert plans.count("Join") <= 1


def test_order_lines_read_order_detail_once(spark, tables, staged_plans):
    last = _built(spark, tables, staged_plans, "order_lines")[0]
    assert sum("f_order_detail.parquet" in line for line in last.splitlines() if "Scan" in line) == 1


def test_event_items_need_no_shuffle(spark, tables, staged_plans):
    assert "Exchange" not in _built(spark, tables, staged_plans, "event_items")[0]


def test_flagship_scan_is_pruned_and_filtered(spark, tables):
    p = _plan(registry.queries()["counted_product_shipments"](spark, SF_SMALL, tables))
    assert "GreaterThan(picked_quantity,0)" in p
    pick_scan = [line for line in p.splitlines() if "f_pick.parquet" in line][0]
    assert "container_id" not in pick_scan and "status" not in pick_scan
