"""Spark plans of two views whose SQL text, run as it stands, shuffles far more than it needs.

The text in :mod:`dockyard.sources.fixtures` stays the definition (the oracle
runs it); these give the same rows, also where keys repeat or are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(a: str, b: str) -> Column:
    """Equality that isn't taken for a join key: rows stay dealt by the other keys alone."""
    return (F.col(a) <= F.col(b)) & (F.col(a) >= F.col(b))


def hu_shipped(f_pick: DataFrame) -> DataFrame:
    """``f_hu_shipped``: distinct over its four columns, the other two are made from them afterwards."""
    d = f_pick.filter("picked_quantity > 0").select("container_id", "wh_id", "load_id", "order_number").distinct()
    return d.select(F.col("container_id").alias("hu_id"), "wh_id", "load_id", F.lit("LO").alias("type"),
                    F.col("order_number").alias("control_number"), F.col("order_number").alias("parent_hu_id"))


def container_history(f_hu_shipped: DataFrame, f_stored_shipped: DataFrame, f_pick: DataFrame, f_item: DataFrame,
                      f_item_uom: DataFrame, f_order: DataFrame, f_customer: DataFrame, f_load: DataFrame,
                      f_container: DataFrame) -> DataFrame:
    """``f_container_history``.

    The joins are those of the text in another order: picks in shipping
    containers, of orders whose customer needs totes, come first, so the lines
    of others meet nothing. Lines take along what the work set is grouped by
    and no more. Orders come last, dealt by the order number alone, which
    every grouping has, so neither the grouping nor the count of units shuffles.

    Of an item only how often its most frequent row comes is needed: a unit
    counts when any line of it has a whole order unit, and of the lines that
    differ in the item's texts that one's sum is the furthest from 0.
    """
    con = f_container.filter(F.coalesce("shipping_container", F.lit(0)) == 1).select("wh_id", "container_type").distinct()
    cu = (f_customer.filter(F.coalesce("totes_required", F.lit(0)) == 1)
          .select("customer_id", "customer_code", "gln", F.col("gs1_required_flag").alias("_cgs"), F.col("totes_required").alias("_totes")))
    addr = ["ship_to_addr1", "ship_to_city", "ship_to_state", "ship_to_zip"]
    od = (f_order.select(F.col("order_number").alias("_order"), F.col("wh_id").alias("_owh"), "customer_id", "stop_id",
                         F.coalesce("tote_count_flag", F.lit(0)).alias("_flag"), *addr, "carrier").join(cu, "customer_id"))
    wanted = od.select(F.col("_order").alias("order_number"), F.col("_owh").alias("_kwh"))
    # a row for each container type
    pk = (f_pick.join(F.broadcast(con.select("container_type").distinct()), "container_type", "left_semi")
          .select("pick_id", "order_number", F.col("wh_id").alias("_kwh"), F.col("item_number").alias("_kitem"), "line_number",
                  "cartonization_batch_id", "pick_area", "uom", "container_type")
          .join(wanted, ["order_number", "_kwh"], "left_semi"))
    iu = f_item_uom.select(F.col("wh_id").alias("_kwh"), F.col("item_number").alias("_kitem"), "uom", "conversion_factor")
    pk = pk.join(iu, ["_kitem", "uom", "_kwh"]).drop("_kitem")
    sto = f_stored_shipped.select("hu_id", "wh_id", "item_number", F.col("type").alias("pick_id"), "actual_qty")
    itm = (f_item.select("wh_id", "item_number", "description", "class_id", "gs1_required_flag").repartition("item_number", "wh_id")
           .groupBy("item_number", "wh_id", "description", "class_id", "gs1_required_flag").agg(F.count(F.lit(1)).alias("_n"))
           .groupBy("item_number", "wh_id").agg(F.max("_n").alias("_n")))
    ln = (sto.join(pk, "pick_id").drop("pick_id").join(itm, ["item_number", "wh_id"])
          .withColumn("_q", F.col("actual_qty") * F.col("_n")).drop("actual_qty", "_n"))
    hum = f_hu_shipped.select("hu_id", "wh_id", "load_id", "parent_hu_id")
    lo = f_load.select("wh_id", "load_id", F.col("earliest_ship_date").alias("shipment_date"))
    j = ln.join(hum, ["hu_id", "wh_id"]).join(od, (F.col("order_number") == F.col("_order")) & _same("_kwh", "_owh"))
    line = ["hu_id", "wh_id", "order_number", "load_id", "parent_hu_id", "item_number", "line_number", "cartonization_batch_id",
            "pick_area", "uom", "conversion_factor", "gln", "_cgs", "customer_code", "customer_id", "stop_id", "_totes", "_flag",
            *addr, "container_type", "carrier"]
    whole = F.floor(F.round(F.sum("_q").cast("double") / F.col("conversion_factor"), 6)).cast("int")
    own = ["wh_id", "customer_code", "load_id", "order_number", "container_type", *addr, "stop_id", "carrier"]
    units = j.groupBy(*line).agg(whole.alias("quantity")).filter("quantity > 0").select(*own, "hu_id")
    out = units.groupBy(*own).agg(F.countDistinct("hu_id").cast("int").alias("shipped_qty"))
    return (out.join(lo, ["wh_id", "load_id"]).join(con, ["wh_id", "container_type"])
            .select("wh_id", "customer_code", "load_id", "order_number", "container_type", "shipped_qty", "shipment_date",
                    *addr, "stop_id", "carrier"))
