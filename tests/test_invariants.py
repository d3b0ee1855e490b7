"""Invariants from SURVEY §5 and an end-to-end run of the three jobs."""

import tempfile

from pyspark.sql import functions as F

from dockyard.functions.columns import AS_OF
from dockyard.operators import confirm as C
from dockyard.operators import outbound as O
from dockyard.plans.confirm import ConfirmInputs, ConfirmRun
from dockyard.plans.inbound import InboundInputs
from dockyard.plans.jobs import run_confirm, run_import, run_outbound, run_send_results
from dockyard.plans.outbound import OutboundInputs, OutboundRun
from dockyard.sources.fixtures import Fixtures
from dockyard.sources.sinks import write_version
from tests.conftest import SF_SMALL


def test_archived_plus_remaining_units_is_all_units(spark):
    r = ConfirmRun(ConfirmInputs.from_fixtures(Fixtures(spark, SF_SMALL)))
    keys = ["hu_id", "wh_id"]
    archived = r.hus_archived.select(*keys)
    left = r.hus_left.select(*keys)
    assert archived.join(left, keys).count() == 0
    assert archived.unionByName(left).distinct().count() == r.hus_wc.select(*keys).distinct().count()


def test_a_line_is_in_at_most_one_arm(spark):
    r = OutboundRun(OutboundInputs.from_fixtures(Fixtures(spark, SF_SMALL)))
    base = O._line_base(r.lines, r.order_detail, r.t.items, r.t.upcs)
    k = ["wh_id", "load_id", "order_number", "line_number"]
    arms = base.groupBy(*k).agg(F.countDistinct("_gs1_arm").alias("n"))
    assert arms.filter("n > 1").count() == 0
    n_lines = r.gs1_lines.count() + r.standard_lines.count()
    assert n_lines > 0


def test_batch_of_loads_equals_union_of_single_load_runs(spark):
    fx = Fixtures(spark, SF_SMALL)
    loads = [r.load_id for r in fx.f_load.orderBy("load_id").limit(3).collect()]
    one_batch = C.counted_product_shipments(
        fx.f_pick, fx.f_item, fx.f_item_uom, fx.f_order, fx.f_customer,
        fx.f_load.filter(F.col("load_id").isin(loads)))
    singles = None
    for lid in loads:
        s = C.counted_product_shipments(fx.f_pick, fx.f_item, fx.f_item_uom, fx.f_order,
                                        fx.f_customer, fx.f_load.filter(F.col("load_id") == lid))
        singles = s if singles is None else singles.unionByName(s)
    assert sorted(one_batch.collect()) == sorted(singles.collect())


def _tables(spark, out):
    import os
    return {t: sorted(map(str, spark.read.parquet(f"{out}/{t}").collect())) for t in sorted(os.listdir(out))}


def test_jobs_write_all_outputs_and_can_be_run_again(spark):
    fx = Fixtures(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="dockyard-jobs-")

    def jobs():
        run_confirm(ConfirmInputs.from_fixtures(fx), f"{out}/confirm", AS_OF, "r1")
        run_outbound(OutboundInputs.from_fixtures(fx), f"{out}/outbound", AS_OF, "r1")
        run_import(InboundInputs.from_fixtures(fx), f"{out}/import", AS_OF, "r1")
        run_send_results(fx.d_outbound_queue, fx.d_replies, f"{out}/send", AS_OF, "r1")
        return {job: _tables(spark, f"{out}/{job}") for job in ("confirm", "outbound", "import", "send")}

    first = jobs()
    assert first["confirm"]["pod_shipments"] and first["import"]["pod_header"] and first["send"]["message_queue"]
    q = spark.read.parquet(f"{out}/outbound/message_queue")
    assert q.count() == q.select("unique_id").distinct().count()
    assert jobs() == first


def test_versions_rewrite_touched_partitions_and_remove_emptied_ones(spark):
    out = tempfile.mkdtemp(prefix="dockyard-version-") + "/t"
    kind = "wh_id string, day int, x int"
    write_version(spark.createDataFrame([("A", 1, 1), ("A", 2, 2), ("B", 1, 3)], kind), out, ["wh_id", "day"])
    import glob
    untouched = glob.glob(f"{out}/wh_id=B/day=1/*.parquet")
    touched = spark.createDataFrame([("A", 1), ("A", 2)], "wh_id string, day int")
    write_version(spark.createDataFrame([("A", 2, 9), ("B", 1, 3)], kind), out, ["wh_id", "day"], touched)
    assert sorted(tuple(r) for r in spark.read.parquet(out).select("wh_id", "day", "x").collect()) == [("A", 2, 9), ("B", 1, 3)]
    assert glob.glob(f"{out}/wh_id=B/day=1/*.parquet") == untouched and not glob.glob(f"{out}/wh_id=A/day=1")
