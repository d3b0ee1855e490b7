"""The jobs on live tables: read and write only what the input touches, publish whole runs.

The steps are those of :class:`~dockyard.plans.confirm.ConfirmRun` and
:class:`~dockyard.plans.outbound.OutboundRun`; here their inputs are cut to the
partitions that hold the loads, units, orders and purchase orders concerned,
and their results become the next versions of those partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.functions.keys import assign_ids, stage, staging
from dockyard.operators import outbound as O
from dockyard.operators.confirm import LOAD
from dockyard.plans.confirm import ConfirmInputs, ConfirmRun
from dockyard.plans.outbound import OutboundInputs, OutboundRun
from dockyard.sources.live import LOAD_LAYOUT, Live, Run, bucket_of, lay_out, tokens

#: Live table -> field of ConfirmInputs. All hang on a load.
CONFIRM_TABLES = {"load_master": "loads", "pick_detail": "picks", "pick_master": "pick_masters", "order": "orders",
                  "hu_master": "hus", "stored_item": "items", "load_queue": "queue"}
LAYOUTS = {t: LOAD_LAYOUT for t in CONFIRM_TABLES}


def _with(df: DataFrame, **kinds: str) -> DataFrame:
    """``df`` with the columns the job fills, null where they are new."""
    return df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in df.columns})


def create_confirm_tables(live: Live, t: ConfirmInputs, buckets: int) -> None:
    """Lay the warehouse tables of ``t`` out under ``live``: each by warehouse, ship day and bucket of its load.

    A stored item hangs on its unit's load. Columns that confirmation fills are
    part of the tables from the start.
    """
    units = t.hus.select("hu_id", "wh_id", "load_id")
    frames = {
        "load_master": _with(t.loads, seal_number="string", actual_ship_date="timestamp_ntz"),
        "pick_detail": _with(t.picks, shipped_quantity="int"), "pick_master": t.pick_masters,
        "order": _with(t.orders, actual_ship_date="timestamp_ntz"), "hu_master": _with(t.hus, location_id="string"),
        "stored_item": _with(t.items.join(units, ["hu_id", "wh_id"]), location_id="string"), "load_queue": t.queue}
    for table, df in frames.items():
        live.create(table, lay_out(df, t.loads, buckets))
    live.create_log("shipment_master", t.shipments)


class LiveConfirm:
    """What one confirm job reads: the partitions of the requested loads, of
    the units that hold their picks or their orders, and of the orders those
    units carry.

    Units and orders are found by narrow scans (keys only) of the warehouses
    concerned; everything else is read by partition.
    """

    def __init__(self, live: Live, requests: DataFrame, buckets: int):
        self.live = live
        whs = [r[0] for r in requests.select("wh_id").distinct().collect()]
        asked = requests.select(*LOAD).distinct()
        slots = {f"{r[0]}/{r[1]}" for r in asked.select("wh_id", bucket_of(buckets, *LOAD)).distinct().collect()}
        loads = live.read("load_master").filter(F.concat_ws("/", "wh_id", "bucket").isin(sorted(slots)))
        self.own = tokens(loads.join(asked, LOAD, "left_semi"), LOAD_LAYOUT)

        picks = live.read("pick_detail", self.own).join(asked, LOAD, "left_semi")
        units = live.read("hu_master").filter(F.col("wh_id").isin(whs)).select("hu_id", "wh_id", "control_number", *LOAD_LAYOUT[1:])
        carried = stage(live.read("hu_master", self.own).join(asked, LOAD, "left_semi")
                        .select(F.col("control_number").alias("order_number"), "wh_id").distinct())
        holds = picks.select(F.col("container_id").alias("hu_id"), "wh_id").distinct()
        of_picks = units.join(holds, ["hu_id", "wh_id"], "left_semi")
        of_orders = units.join(carried.withColumnRenamed("order_number", "control_number"), ["control_number", "wh_id"], "left_semi")
        self.units = self.own | tokens(of_picks.unionByName(of_orders), LOAD_LAYOUT)
        named = carried.unionByName(picks.select("order_number", "wh_id")).distinct()
        orders = live.read("order").filter(F.col("wh_id").isin(whs)).select("order_number", "wh_id", *LOAD_LAYOUT[1:])
        self.orders = self.own | tokens(orders.join(named, ["order_number", "wh_id"], "left_semi"), LOAD_LAYOUT)

    def inputs(self, requests: DataFrame, **reference: DataFrame) -> ConfirmInputs:
        r = self.live.read
        return ConfirmInputs(
            requests=requests, loads=r("load_master", self.own | self.units | self.orders), orders=r("order", self.orders),
            picks=r("pick_detail", self.own), pick_masters=r("pick_master", self.own), hus=r("hu_master", self.units),
            items=r("stored_item", self.own), queue=r("load_queue", self.own),
            shipments=self.live.read_log("shipment_master"), **reference)


def confirm_loads(live: Live, requests: DataFrame, buckets: int, as_of, run_id: str, **reference: DataFrame) -> bool:
    """Ship-confirm the requested loads on the live tables, as one run.

    ``reference`` holds wh_control, employees, item_master, uoms and customers.
    Shipments, archived units and items, the transaction log, rejections and
    counted products are appended; loads, picks, orders, units, items and the
    queue change in the partitions of the loads concerned. A job that failed at
    any point is run again with the same id. False when it was done before.
    """

    def job(run: Run) -> None:
        with staging(live.spark):
            scope = LiveConfirm(live, requests, buckets)
            t = scope.inputs(requests, **reference)
            r = ConfirmRun(t, as_of)
            run.append("confirm_rejections", r.rejected)
            run.append("shipment_master", r.shipments.filter("is_new = 1").select("load_master_id", "wh_id", "shipment_number"))
            run.append("hu_master_shipped", r.hus_archived)
            run.append("stored_item_shipped", r.items_archived)
            run.append("tran_log", r.audit)
            run.append("pod_shipments", r.counted)
            run.replace("load_master", t.loads, r.loads_cross)
            run.replace("pick_detail", t.picks, r.picks_closed)
            run.replace("pick_master", t.pick_masters, r.pick_masters_closed)
            run.replace("order", t.orders, r.orders_toted)
            run.replace("hu_master", t.hus, r.hus_left)
            run.replace("stored_item", t.items, r.items_left)
            run.replace("load_queue", t.queue, t.queue.unionByName(queued(live, r, t.loads, buckets).select(*t.queue.columns)))

    return live.run(run_id, job)


def queued(live: Live, r: ConfirmRun, loads: DataFrame, buckets: int) -> DataFrame:
    """The run's new queue rows; ids go on after the highest one of the whole queue."""
    rows = assign_ids(r.enqueue_wc.unionByName(r.enqueue_std), LOAD, "_seq")
    last = live.read("load_queue").agg(F.coalesce(F.max("unique_id").cast("bigint"), F.lit(0))).scalar()
    return lay_out(rows.withColumn("unique_id", last + F.col("_seq")).drop("_seq"), loads, buckets).withColumn(
        "preship_scan_gs1", F.lit(None).cast("int"))


#: Layouts of the tables that sending changes: the queue by load, purchase orders by ship day, backhauls by order number.
SEND_LAYOUTS = {"load_queue": LOAD_LAYOUT, "po_master": ["wh_id", "ship_day"], "po_backhaul": ["wh_id", "bucket"]}


def create_send_tables(live: Live, t: OutboundInputs, buckets: int) -> None:
    """Lay the load queue, purchase orders and backhauls of ``t`` out under ``live``."""
    live.create("load_queue", lay_out(_with(t.queue, dt_processed="timestamp_ntz"), t.loads, buckets))
    live.create("po_master", t.pos.withColumn("ship_day", F.to_date("shipment_date")))
    live.create("po_backhaul", t.backhauls.withColumn("bucket", bucket_of(buckets, "po_number")))


def send_loads(live: Live, tables: dict[str, Callable[[], DataFrame]], as_of, run_id: str, system_name: str = "legacySystem") -> bool:
    """Build and queue the messages of all pending loads of the live queue, as one run.

    ``tables`` are the other inputs of :class:`OutboundInputs`. The queue rows,
    purchase orders and backhauls of the run change in their partitions only;
    messages, containers and tote expectations are appended. Message ids go on
    after the highest of the published runs. False when the run was done before.
    """

    def job(run: Run) -> None:
        with staging(live.spark):
            queue, pos, backhauls = (live.read(t) for t in SEND_LAYOUTS)
            earlier, sent = tables["message_queue"]().select("unique_id"), live.read_log("message_queue")
            r = OutboundRun(OutboundInputs(**{
                **tables, "queue": lambda: queue, "pos": lambda: pos, "backhauls": lambda: backhauls,
                "message_queue": lambda: earlier if sent is None else earlier.unionByName(sent.select("unique_id"))}), as_of, system_name)
            run.append("customer_totes", r.tote_log)
            run.append("container_shipments", r.container_rows)
            run.append("message_queue", r.queue_rows)
            handled = r.po.select("po_number").distinct()
            due = live.read("load_queue", tokens(queue.join(r.pending.select("unique_id"), "unique_id", "left_semi"), SEND_LAYOUTS["load_queue"]))
            pos = live.read("po_master", tokens(pos.join(handled, "po_number", "left_semi"), SEND_LAYOUTS["po_master"]))
            backhauls = live.read("po_backhaul", tokens(backhauls.join(handled, "po_number", "left_semi"), SEND_LAYOUTS["po_backhaul"]))
            new_pos, new_backhauls = O.po_state_update(pos, backhauls, r.po)
            run.replace("load_queue", due, O.complete_loads(due, r.pending, as_of))
            run.replace("po_master", pos, new_pos)
            run.replace("po_backhaul", backhauls, new_backhauls)

    return live.run(run_id, job)
