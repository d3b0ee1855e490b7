"""Ship confirmation, for every requested load in one job.

The reference confirms one load per call and runs a chain of UPDATE / INSERT /
DELETE statements. Here each step is a DataFrame function: it takes the current
version of the tables it reads and returns the next version (or the rows to
append). Nothing is written until a plan decides to; a failed job leaves the
inputs untouched.

Grain and keys: loads are keyed by (wh_id, load_id), orders by
(wh_id, order_number), units by (wh_id, hu_id). Shuffles happen on those keys;
whether a small table is broadcast is left to the size-checked threshold of
the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.functions.columns import (
    as_of_lit, carrier_suffix, code, is_will_call, nz, uom_qty,
)
from dockyard.functions.keys import assign_ids

LOAD = ["wh_id", "load_id"]
ADDR = ["ship_to_addr1", "ship_to_city", "ship_to_state", "ship_to_zip"]
COUNTED_TYPES = ["LILCIG", "ECIG", "CIG", "CIGP", "SNF", "SNFP"]


def _loads_of(df: DataFrame, loads: DataFrame | None) -> DataFrame:
    """Restrict ``df`` to the (wh_id, load_id) keys of ``loads`` (semi-join)."""
    if loads is None:
        return df
    return df.join(loads.select(*LOAD).distinct(), LOAD, "left_semi")


def order_stop_rank(orders: DataFrame, loads: DataFrame | None = None) -> DataFrame:
    """One row per (load, stop, address): MAX(order_number), tote_count_flag 1,
    stop_rank = ROW_NUMBER per (load, address) by stop_id descending.

    stop_id is part of the group key, so the rank has no ties."""
    g = (_loads_of(orders, loads)
         .groupBy(*LOAD, "stop_id", *ADDR)
         .agg(F.max("order_number").alias("order_number")))
    w = Window.partitionBy(*LOAD, *ADDR).orderBy(F.col("stop_id").desc())
    return g.select(*LOAD, "stop_id", *ADDR, "order_number",
                    F.lit(1).alias("tote_count_flag"),
                    F.row_number().over(w).alias("stop_rank"))


def tote_flag_update(orders: DataFrame, ranked: DataFrame) -> DataFrame:
    """New orders version: tote_count_flag = 1 on the order of rank 1 per
    address; every other order keeps its flag."""
    top = (ranked.filter(F.col("stop_rank") == 1)
           .select("order_number", "wh_id", F.col("tote_count_flag").alias("_flag"))
           .distinct())
    return (orders.join(top, ["order_number", "wh_id"], "left")
            .withColumn("tote_count_flag", F.coalesce("_flag", "tote_count_flag"))
            .drop("_flag"))


def load_carrier_class(orders: DataFrame, loads: DataFrame | None = None) -> DataFrame:
    """Carrier of the load and its will-call class.

    The reference reads TOP 1 carrier without ORDER BY; here the carrier of
    the lowest order_number (K8). will_call = 1 when it ends in 'WC'."""
    c = (_loads_of(orders, loads).groupBy(*LOAD)
         .agg(F.min_by("carrier", "order_number").alias("carrier")))
    return c.withColumn("will_call", is_will_call("carrier").cast("int"))


def not_fully_loaded(picks: DataFrame, hus: DataFrame, carriers: DataFrame) -> DataFrame:
    """Non will-call loads that still hold a pick that is not LOADED, not a
    zero-picked SHORTED/UNPICKED, and not in an LO unit."""
    units = hus.select(F.col("hu_id").alias("container_id"), "wh_id",
                       F.col("type").alias("hu_type"))
    open_picks = (picks.join(units, ["container_id", "wh_id"], "left")
                  .filter(~((F.col("picked_quantity") == 0)
                            & code("status").isin("SHORTED", "UNPICKED"))
                          & (code("status") != "LOADED")
                          & (F.coalesce(code("hu_type"), F.lit("SO")) != "LO"))
                  .select(*LOAD).distinct())
    nwc = carriers.filter(F.col("will_call") == 0).select(*LOAD)
    return (open_picks.join(nwc, LOAD, "left_semi")
            .withColumn("reason", F.lit("NOT FULLY LOADED")))


def already_shipped(picks: DataFrame) -> DataFrame:
    """Loads holding any SHIPPED pick. (The reference's LEFT JOIN to units
    cannot change which loads qualify, so it is left out.)"""
    return (picks.filter(code("status") == "SHIPPED").select(*LOAD).distinct()
            .withColumn("reason", F.lit("LOAD ALREADY SHIPPED")))


def reject_loads(requests: DataFrame, not_loaded: DataFrame, shipped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split requests into (accepted, rejected). The first failing check is
    the reason, in the reference's order."""
    r = (requests.select(*LOAD).distinct()
         .join(not_loaded.withColumnRenamed("reason", "_r1"), LOAD, "left")
         .join(shipped.withColumnRenamed("reason", "_r2"), LOAD, "left")
         .withColumn("reason", F.coalesce("_r1", "_r2")).drop("_r1", "_r2"))
    rejected = r.filter(F.col("reason").isNotNull())
    accepted = requests.join(rejected.select(*LOAD), LOAD, "left_anti")
    return accepted, rejected


def assign_shipments(loads: DataFrame, shipments: DataFrame, requests: DataFrame,
                     as_of=None) -> DataFrame:
    """Shipment number per requested load: the existing one, else a new
    one (status S). New numbers continue after the highest existing number,
    in (wh_id, load_id) order."""
    lm = loads.join(requests.select(*LOAD).distinct(), LOAD, "left_semi") \
              .select(*LOAD, "load_master_id")
    sm = shipments.select("load_master_id", "shipment_number")
    j = lm.join(sm, "load_master_id", "left")
    have = j.filter(F.coalesce(F.col("shipment_number"), F.lit("")) != "")
    need = j.filter(F.coalesce(F.col("shipment_number"), F.lit("")) == "")
    # Highest existing number: a scalar subquery (one global aggregate).
    base = shipments.agg(F.coalesce(F.max(F.col("shipment_number").cast("bigint")),
                                    F.lit(0)).alias("_base")).scalar()
    new = (assign_ids(need.drop("shipment_number"), ["wh_id", "load_id"], "_seq")
           .withColumn("shipment_number", (base + F.col("_seq")).cast("string"))
           .drop("_seq"))
    ts = as_of_lit(as_of)
    return (have.select(*LOAD, "load_master_id", "shipment_number",
                        F.lit(0).alias("is_new"), F.lit(None).cast("string").alias("status"),
                        F.lit(None).cast("timestamp_ntz").alias("created_date"))
            .unionByName(new.select(*LOAD, "load_master_id", "shipment_number",
                                    F.lit(1).alias("is_new"), F.lit("S").alias("status"),
                                    ts.alias("created_date"))))


def uninvoiced_loads(loads: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Loads whose invoiced_flag is NULL or 0 (they go through invoicing)."""
    return _loads_of(loads, requests).filter(nz("invoiced_flag") == 0).select(*LOAD)


def will_call_door(loads: DataFrame, wh_control: DataFrame, carriers: DataFrame) -> DataFrame:
    """Door of each will-call load: COALESCE(load door, control c1, 'DOOR001').

    The WHERE on the control type makes the reference's LEFT JOIN inner (K5):
    no WC_DEFAULT_DOOR row, no door."""
    ctl = (wh_control.filter(code("control_type") == "WC_DEFAULT_DOOR")
                      .select("wh_id", F.col("c1").alias("_c1")))
    wc = carriers.filter(F.col("will_call") == 1).select(*LOAD)
    return (loads.join(wc, LOAD, "left_semi").join(ctl, "wh_id", "inner")
            .select(*LOAD, F.coalesce("door_loc", "_c1", F.lit("DOOR001")).alias("door_loc")))


def will_call_hu_update(hus: DataFrame, doors: DataFrame) -> DataFrame:
    """New units version: units of will-call loads that are not LO become LO
    at the load's door (location_id). Others are unchanged.

    Built as the stated intent (K4): the unit keys are chosen before the
    update, and :func:`will_call_item_update` moves their items."""
    d = doors.select(*LOAD, F.col("door_loc").alias("_door"))
    cols = hus.columns
    j = hus.join(d, LOAD, "left")
    hit = F.col("_door").isNotNull() & (F.coalesce(code("type"), F.lit("")) != "LO")
    loc = F.col("location_id") if "location_id" in cols else F.lit(None).cast("string")
    out = j.withColumn("location_id", F.when(hit, F.col("_door")).otherwise(loc)) \
           .withColumn("type", F.when(hit, F.lit("LO")).otherwise(F.col("type")))
    keep = cols + ([] if "location_id" in cols else ["location_id"])
    return out.select(*keep)


def will_call_item_update(items: DataFrame, hus: DataFrame, doors: DataFrame) -> DataFrame:
    """Stored items of the units moved by :func:`will_call_hu_update` get the
    door as location (keys taken from the units before the update)."""
    moved = (hus.filter(F.coalesce(code("type"), F.lit("")) != "LO")
             .join(doors.select(*LOAD, F.col("door_loc").alias("_door")), LOAD, "inner")
             .select("hu_id", "wh_id", "_door"))
    cols = items.columns
    loc = F.col("location_id") if "location_id" in cols else F.lit(None).cast("string")
    keep = cols + ([] if "location_id" in cols else ["location_id"])
    return (items.join(moved, ["hu_id", "wh_id"], "left")
            .withColumn("location_id", F.coalesce(F.col("_door"), loc))
            .select(*keep))


def archive_handling_units(hus: DataFrame, shipments: DataFrame) -> DataFrame:
    """Rows appended to the shipped-units archive: LO units of the confirmed
    loads (``shipments`` has one row per load) with their shipment number."""
    s = shipments.select(*LOAD, "shipment_number")
    return hus.filter(code("type") == "LO").join(s, LOAD, "inner")


def archive_stored_items(items: DataFrame, hus_shipped: DataFrame) -> DataFrame:
    """Rows appended to the shipped-items archive: items of archived units."""
    a = hus_shipped.select("hu_id", "wh_id", "shipment_number")
    return items.join(a, ["hu_id", "wh_id"], "inner")


def close_load_rows(loads: DataFrame, accepted: DataFrame, seal_col: str = "seal",
                    as_of=None) -> DataFrame:
    """New loads version: confirmed loads SHIPPED with seal and ship date."""
    a = accepted.select(*LOAD, F.col(seal_col).alias("_seal"), F.lit(1).alias("_hit"))
    j = loads.join(a, LOAD, "left")
    hit = F.col("_hit") == 1
    cols = loads.columns
    out = (j.withColumn("status", F.when(hit, F.lit("SHIPPED")).otherwise(F.col("status")))
           .withColumn("seal_number", F.when(hit, F.col("_seal"))
                       .otherwise(F.col("seal_number") if "seal_number" in cols else F.lit(None).cast("string")))
           .withColumn("actual_ship_date", F.when(hit, as_of_lit(as_of))
                       .otherwise(F.col("actual_ship_date") if "actual_ship_date" in cols
                                  else F.lit(None).cast("timestamp_ntz"))))
    extra = [c for c in ("seal_number", "actual_ship_date") if c not in cols]
    return out.select(*cols, *extra)


def close_pick_rows(picks: DataFrame, accepted: DataFrame) -> DataFrame:
    """New pick-detail (or pick-master) version: rows of confirmed loads are
    SHIPPED; for detail rows shipped_quantity = picked_quantity."""
    a = accepted.select(*LOAD).distinct().withColumn("_hit", F.lit(1))
    j = picks.join(a, LOAD, "left")
    hit = F.col("_hit") == 1
    cols = picks.columns
    out = j.withColumn("status", F.when(hit, F.lit("SHIPPED")).otherwise(F.col("status")))
    extra = []
    if "picked_quantity" in cols:
        prev = F.col("shipped_quantity") if "shipped_quantity" in cols else F.lit(None).cast("int")
        out = out.withColumn("shipped_quantity", F.when(hit, F.col("picked_quantity")).otherwise(prev))
        if "shipped_quantity" not in cols:
            extra = ["shipped_quantity"]
    return out.select(*cols, *extra)


def close_order_rows(orders: DataFrame, accepted: DataFrame, as_of=None) -> DataFrame:
    """New orders version: orders of confirmed loads get status S and date."""
    a = accepted.select(*LOAD).distinct().withColumn("_hit", F.lit(1))
    j = orders.join(a, LOAD, "left")
    hit = F.col("_hit") == 1
    cols = orders.columns
    prev = F.col("actual_ship_date") if "actual_ship_date" in cols else F.lit(None).cast("timestamp_ntz")
    out = (j.withColumn("status", F.when(hit, F.lit("S")).otherwise(F.col("status")))
           .withColumn("actual_ship_date", F.when(hit, as_of_lit(as_of)).otherwise(prev)))
    return out.select(*cols, *([] if "actual_ship_date" in cols else ["actual_ship_date"]))


def _lo_units_of(hus: DataFrame, accepted: DataFrame) -> DataFrame:
    return (hus.filter(code("type") == "LO")
            .join(accepted.select(*LOAD).distinct(), LOAD, "left_semi"))


def close_cross_load_orders(orders: DataFrame, hus: DataFrame, loads: DataFrame,
                            accepted: DataFrame) -> DataFrame:
    """New orders version: an order not yet S that is carried by an LO unit of
    a confirmed load closes when no unit carrying it sits on a load that is
    not SHIPPED (any load, not only confirmed ones)."""
    carried = (_lo_units_of(hus, accepted)
               .select(F.col("control_number").alias("order_number"), "wh_id").distinct())
    open_loads = loads.filter(code("status") != "SHIPPED").select(*LOAD)
    # of all units only those of the carried orders meet the loads
    blocked = (hus.select(F.col("control_number").alias("order_number"), *LOAD)
               .join(carried, ["order_number", "wh_id"], "left_semi")
               .join(open_loads, LOAD, "left_semi").select("order_number", "wh_id").distinct())
    close = (carried.join(blocked, ["order_number", "wh_id"], "left_anti")
             .withColumn("_hit", F.lit(1)))
    cols = orders.columns
    return (orders.join(close, ["order_number", "wh_id"], "left")
            .withColumn("status", F.when((F.col("_hit") == 1) & (code("status") != "S"), F.lit("S"))
                        .otherwise(F.col("status")))
            .select(*cols))


def close_cross_load_loads(loads: DataFrame, orders: DataFrame, hus: DataFrame,
                           accepted: DataFrame) -> DataFrame:
    """New loads version: a load not yet SHIPPED that holds an order carried by
    an LO unit of a confirmed load closes when none of its orders is open."""
    carried = (_lo_units_of(hus, accepted)
               .select(F.col("control_number").alias("order_number"), "wh_id").distinct())
    touched = orders.join(carried, ["order_number", "wh_id"], "left_semi").select(*LOAD).distinct()
    open_orders = orders.filter(code("status") != "S").select(*LOAD).join(touched, LOAD, "left_semi").distinct()
    close = touched.join(open_orders, LOAD, "left_anti").withColumn("_hit", F.lit(1))
    cols = loads.columns
    return (loads.join(close, LOAD, "left")
            .withColumn("status", F.when((F.col("_hit") == 1) & (code("status") != "SHIPPED"),
                                         F.lit("SHIPPED")).otherwise(F.col("status")))
            .select(*cols))


def purge_shipped(items: DataFrame, hus: DataFrame, hus_shipped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Live tables after the purge: (items, units) minus the archived ones.
    Units are removed only while they are LO."""
    keys = hus_shipped.select("hu_id", "wh_id").distinct()
    items_left = items.join(keys, ["hu_id", "wh_id"], "left_anti")
    gone = hus.filter(code("type") == "LO").join(keys, ["hu_id", "wh_id"], "left_semi") \
              .select("hu_id", "wh_id")
    hus_left = hus.join(gone, ["hu_id", "wh_id"], "left_anti")
    return items_left, hus_left


def ship_audit_log(accepted: DataFrame, shipments: DataFrame, employees: DataFrame,
                   as_of=None) -> DataFrame:
    """One transaction-log row per confirmed load. Employee falls back to the
    user name; the seal is cut to 500 characters."""
    ts = as_of_lit(as_of)
    e = employees.select(F.col("username"), "wh_id", F.col("employee_id").alias("_emp"))
    return (accepted.join(shipments.select(*LOAD, "shipment_number"), LOAD, "left")
            .join(e, ["username", "wh_id"], "left")
            .select(F.lit("370").alias("tran_type"),
                    F.lit("Load Management Ship Confirm").alias("description"),
                    ts.alias("start_tran_date"), ts.alias("end_tran_date"),
                    F.coalesce("_emp", "username").alias("employee_id"),
                    "wh_id", "load_id",
                    F.col("trailer").alias("generic_attribute_1"),
                    F.left(F.col("seal"), F.lit(500)).alias("generic_attribute_2"),
                    F.col("shipment_number").alias("shipment_id")))


def enqueue_will_call(orders: DataFrame, wh_control: DataFrame, queue: DataFrame,
                      accepted: DataFrame) -> DataFrame:
    """Queue rows for confirmed loads with an order whose carrier suffix equals
    the WILL_CALL_POD control c1 (default 'WC') where the control allows it
    (next_value = 1), unless the load is queued already."""
    ctl = (wh_control.filter((code("control_type") == "WILL_CALL_POD")
                                        & (F.col("next_value") == 1))
                      .select("wh_id", F.coalesce("c1", F.lit("WC")).alias("_c1")))
    o = orders.join(accepted.select(*LOAD).distinct(), LOAD, "left_semi")
    hit = (o.join(ctl, "wh_id", "inner")
           .filter(carrier_suffix("carrier", 2) == F.col("_c1"))
           .select(*LOAD).distinct())
    return (hit.join(queue.select(*LOAD), LOAD, "left_anti")
            .select("load_id", "wh_id", F.lit(0).alias("queue_status")))


def enqueue_standard(orders: DataFrame, queue: DataFrame, accepted: DataFrame,
                     will_call_rows: DataFrame) -> DataFrame:
    """Queue rows for the other confirmed loads: an order that is not will-call
    (or the load id contains ADD) and not a transfer carrier (TRF), unless the
    load is queued already or was queued as will-call."""
    o = orders.join(accepted.select(*LOAD).distinct(), LOAD, "left_semi")
    hit = (o.filter(((carrier_suffix("carrier", 2) != "WC") | F.col("load_id").like("%ADD%"))
                    & (carrier_suffix("carrier", 3) != "TRF"))
           .select(*LOAD).distinct())
    return (hit.join(queue.select(*LOAD), LOAD, "left_anti")
            .join(will_call_rows.select(*LOAD), LOAD, "left_anti")
            .select("load_id", "wh_id", F.lit(0).alias("queue_status")))


def counted_product_shipments(picks: DataFrame, items: DataFrame, uoms: DataFrame,
                              orders: DataFrame, customers: DataFrame,
                              loads: DataFrame | None = None, as_of=None) -> DataFrame:
    """Rows appended to the counted-product shipments table: SUM(planned /
    conversion factor) per order and counted product type, for picked lines of
    non-transfer orders. ``loads`` restricts to confirmed loads (None = all).

    Plan: the pick detail is the only large side; it is filtered (picked > 0)
    and pruned at the scan, the item master is filtered to the six counted
    types before the join, and the aggregate is partial (map-side)."""
    pk = _loads_of(picks.filter(F.col("picked_quantity") > 0), loads) \
        .select("wh_id", "load_id", "order_number", "item_number", "uom", "planned_quantity")
    it = items.filter(code("product_type").isin(*COUNTED_TYPES)) \
        .select("wh_id", "item_number", "product_type")
    um = uoms.select("wh_id", "item_number", "uom", "conversion_factor")
    od = orders.filter(F.coalesce(F.col("order_type"), F.lit("")) != "TRANSFER") \
        .select("wh_id", "order_number", "customer_id", "earliest_ship_date", "stop_id")
    cu = customers.select("customer_id", "customer_code")
    j = (pk.join(it, ["wh_id", "item_number"])
         .join(um, ["wh_id", "item_number", "uom"])
         .join(od, ["wh_id", "order_number"])
         .join(cu, "customer_id"))
    g = (j.groupBy("wh_id", "load_id", "order_number", "product_type", "stop_id",
                   "customer_code", "earliest_ship_date")
         .agg(uom_qty("planned_quantity", "conversion_factor").alias("uom_qty")))
    return g.select("wh_id", "customer_code", "load_id", "order_number",
                    F.col("earliest_ship_date").alias("shipment_date"), "stop_id",
                    "uom_qty", "product_type", as_of_lit(as_of).alias("create_date"))
