"""Outbound message data: every pending load at once.

The reference claims one load per loop turn and fills temp tables that are
never cleared between loads (K13); here every set carries its load key, so a
batch of n loads equals the union of n single-load runs.

Shuffle keys: (wh_id, load_id) for load-level sets, (wh_id, order_number) for
order-level sets, (wh_id, hu_id) for pallets. Whether a small table is broadcast is
left to the size-checked threshold of the session.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.functions.columns import (
    as_of_lit, carrier_suffix, case_gtin, code, int_sum, nz, purpose_code, tsql_concat,
)
from dockyard.functions.keys import stage

LOAD = ["wh_id", "load_id"]
ADDR = ["ship_to_addr1", "ship_to_city", "ship_to_state", "ship_to_zip"]


# --------------------------------------------------------------------------
# load level


def pending_loads(queue: DataFrame, loads: DataFrame) -> DataFrame:
    """Queue rows with status 0 and no pre-ship GS1 scan, with the load's route
    and ship date (NULL when the load master row is missing)."""
    q = queue.filter((F.col("queue_status") == 0) & (nz("preship_scan_gs1") == 0))
    lm = loads.select(*LOAD, "route_id", F.col("earliest_ship_date").alias("shipment_date"))
    return q.select("unique_id", *LOAD).join(lm, LOAD, "left")


def po_stop(pending: DataFrame, loads: DataFrame, orders: DataFrame) -> DataFrame:
    """Stop number for purchase orders: ISNULL(MAX(stop_id), 1) + 1 per load
    (the last stop of the route, plus one)."""
    o = (orders.join(loads.select(*LOAD), LOAD, "left_semi")
         .groupBy(*LOAD).agg(F.max("stop_id").alias("_mx")))
    return (pending.select(*LOAD).distinct().join(o, LOAD, "left")
            .select(*LOAD, (F.coalesce("_mx", F.lit(1)) + 1).alias("po_stop")))


def shipped_lines(pending: DataFrame, hus_shipped: DataFrame, stored_shipped: DataFrame,
                  picks: DataFrame, items: DataFrame, uoms: DataFrame, orders: DataFrame,
                  customers: DataFrame) -> DataFrame:
    """The work set: one row per (unit, order, item, line, ...) of the pending
    loads, quantity = SUM(actual_qty) / conversion factor of the order uom.

    Archived units are restricted to pending loads first (semi-join on the
    load key), so only those units reach the larger joins."""
    hum = (hus_shipped.join(pending.select(*LOAD).distinct(), LOAD, "left_semi")
           .select("hu_id", "wh_id", "load_id", "parent_hu_id"))
    sto = stored_shipped.select("hu_id", "wh_id", "item_number",
                                F.col("type").alias("pick_id"), "actual_qty")
    pk_cols = ["pick_id", F.col("wh_id").alias("pk_wh_id"), "order_number",
               F.col("item_number").alias("pk_item_number"), "line_number",
               "cartonization_batch_id", "pick_area", F.col("uom").alias("order_uom"),
               "container_type"]
    for c in ("truck_builder_pallet_id", "truck_builder_pallet_number"):
        pk_cols.append(F.col(c) if c in picks.columns else F.lit(None).cast("string").alias(c))
    pkd = picks.select(*pk_cols)
    itm = items.select("wh_id", "item_number", F.col("description").alias("item_description"),
                       "class_id", F.col("gs1_required_flag").alias("item_gs1"))
    iu = uoms.select(F.col("wh_id").alias("pk_wh_id"), F.col("item_number").alias("pk_item_number"),
                     F.col("uom").alias("order_uom"), "conversion_factor")
    o = orders.select(F.col("wh_id").alias("pk_wh_id"), "order_number", "customer_id", "stop_id",
                      "tote_count_flag", *ADDR, "carrier")
    c = customers.select("customer_id", "customer_code", "gln", "totes_required",
                         F.col("gs1_required_flag").alias("cust_gs1"))
    j = (hum.join(sto, ["hu_id", "wh_id"])
         .join(pkd, "pick_id")
         .join(itm, ["item_number", "wh_id"])
         .join(iu, ["pk_item_number", "order_uom", "pk_wh_id"])
         .join(o, ["order_number", "pk_wh_id"])
         .join(c, "customer_id"))
    keys = ["hu_id", "wh_id", "order_number", "load_id", "parent_hu_id", "item_number",
            "item_description", "line_number", "truck_builder_pallet_id",
            "truck_builder_pallet_number", "cartonization_batch_id", "pick_area", "order_uom",
            "conversion_factor", "class_id", "gln", "item_gs1", "cust_gs1", "customer_code",
            "customer_id", "stop_id", "totes_required", "tote_count_flag", *ADDR,
            "container_type", "carrier"]
    g = j.groupBy(*keys).agg(F.sum("actual_qty").alias("_q"))
    return g.select(
        "hu_id", "wh_id", "order_number", "load_id", "parent_hu_id",
        tsql_concat(F.col("truck_builder_pallet_id"), F.lit("-"),
                    F.col("truck_builder_pallet_number")).alias("pallet_desc"),
        F.when(F.col("cartonization_batch_id").isNull(), F.col("item_description"))
         .otherwise(tsql_concat(F.col("pick_area"), F.lit("-"), F.col("cartonization_batch_id")))
         .alias("hu_desc"),
        "item_number", "item_description", "line_number",
        F.floor(F.round(F.col("_q").cast("double") / F.col("conversion_factor"), 6)).cast("int")
         .alias("quantity"),
        "cartonization_batch_id", "class_id", "pick_area", "order_uom", "gln",
        F.when((nz("item_gs1") == 1) & (nz("cust_gs1") == 1), F.lit(1)).otherwise(F.lit(0))
         .alias("gs1_required_flag"),
        "customer_code", "stop_id", "totes_required", "customer_id",
        nz("tote_count_flag").alias("tote_count_flag"), *ADDR, "container_type", "carrier")


# --------------------------------------------------------------------------
# totes


def tote_candidates(lines: DataFrame) -> DataFrame:
    """Orders whose customer needs totes and whose tote flag is set."""
    return (lines.filter((nz("totes_required") == 1) & (nz("tote_count_flag") == 1))
            .select("customer_id", "customer_code", *LOAD, "order_number", *ADDR).distinct())


def _eligible_loads(orders: DataFrame, loads: DataFrame) -> DataFrame:
    """(wh, address, load, created) of non-transfer, non will-call orders."""
    o = orders.filter((F.coalesce(F.col("order_type"), F.lit("")) != "TRANSFER")
                      & (carrier_suffix("carrier", 2) != "WC"))
    return (o.select("wh_id", "load_id", *ADDR)
            .join(loads.select(*LOAD, "created_date"), LOAD)
            .select("wh_id", *ADDR, F.struct("created_date", "load_id").alias("_k")))


def prior_load(cands: DataFrame, orders: DataFrame, loads: DataFrame) -> DataFrame:
    """Latest *other* load (created_date desc, then load_id desc) serving the
    same address, ignoring transfers and will-call; '' when there is none.

    Only one load is excluded per candidate, so the two latest loads per
    address suffice: a top-2 rank, which Spark applies in each task before
    the rows of an address meet."""
    key = ["wh_id", *ADDR]
    # only the addresses of this run's candidates matter
    el = (_eligible_loads(orders, loads).join(cands.select(*key).distinct(), key, "left_semi")
          .select(*key, "_k").distinct())
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("_k").desc()))
    tops = (el.withColumn("_r", rank).filter(F.col("_r") <= 2).groupBy(*key)
            .agg(F.max(F.when(F.col("_r") == 1, F.col("_k.load_id"))).alias("_t1"),
                 F.max(F.when(F.col("_r") == 2, F.col("_k.load_id"))).alias("_t2")))
    j = cands.join(tops, key, "left")
    pick = F.when(F.col("_t1") != F.col("load_id"), F.col("_t1")).otherwise(F.col("_t2"))
    return j.withColumn("prior_load_id", F.coalesce(pick, F.lit(""))).drop("_t1", "_t2")


def shipped_units(picks: DataFrame, pick_masters: DataFrame, orders: DataFrame,
                  containers: DataFrame, loads: DataFrame | None = None) -> DataFrame:
    """Units with a shipped quantity in shipping containers, per order of a
    non-transfer, non will-call order: (wh, load, order, customer, address, hu).

    ``loads`` (wh_id, load_id) restricts the scan to those loads' orders and
    picks (the prior loads of a run), instead of the whole pick history."""
    pkm = pick_masters.select("pick_master_id", F.col("wh_id").alias("_pwh"), "container_type")
    con = containers.filter(nz("shipping_container") == 1).select(F.col("wh_id").alias("_pwh"), "container_type")
    pkd = (picks.filter(F.col("shipped_quantity") > 0)
           .select("pick_master_id", "wh_id", "order_number", F.col("container_id").alias("hu_id")))
    o = (orders.filter((F.coalesce(F.col("order_type"), F.lit("")) != "TRANSFER")
                       & (carrier_suffix("carrier", 2) != "WC"))
         .select("wh_id", "order_number", "load_id", "customer_id", *ADDR))
    if loads is not None:
        o = o.join(loads.select(*LOAD).distinct(), LOAD, "left_semi")
        pkd = pkd.join(o.select("wh_id", "order_number"), ["wh_id", "order_number"], "left_semi")
    return (pkd.join(pkm, "pick_master_id").join(con, ["_pwh", "container_type"])
            .join(o, ["wh_id", "order_number"])
            .select("wh_id", "load_id", "customer_id", *ADDR, "hu_id"))


def prior_tote_count(cands: DataFrame, units: DataFrame) -> DataFrame:
    """COUNT(DISTINCT unit) on the prior load, matched on customer OR address.

    The units of an address are counted once per (load, address), not per
    candidate; to them come the candidate's own customer's units that went to
    another address. A candidate without units counts 0."""
    ck = ["wh_id", "load_id", "order_number", "customer_id", *ADDR]
    at = ["wh_id", "prior_load_id", *ADDR]
    u = units.withColumnRenamed("load_id", "prior_load_id")
    there = u.select(*at, "hu_id").distinct()
    by_addr = there.groupBy(*at).agg(F.count("*").cast("int").alias("_at"))
    own = (cands.select(*ck, "prior_load_id")
           .join(u.select("wh_id", "prior_load_id", "customer_id", "hu_id"), ["wh_id", "prior_load_id", "customer_id"])
           .select(*ck, "prior_load_id", "hu_id").distinct())
    t = there.select(*[F.col(k).alias("_" + k) for k in [*at, "hu_id"]])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col("_" + k) for k in at], F.col("hu_id").eqNullSafe(F.col("_hu_id")))
    elsewhere = (own.join(t, same, "left_anti").groupBy(*ck).agg(F.count("*").cast("int").alias("_own")))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ck])
    return (cands.join(by_addr, at, "left").join(elsewhere, ck, "left")
            .withColumn("tote_count", F.when(known, nz("_at") + nz("_own")).otherwise(F.lit(0)))
            .select(*cands.columns, "tote_count"))


def _not_all_marks(c) -> F.Column:
    # K7: three ORed NOT LIKEs are true unless the id holds all three marks
    col = F.col(c)
    return (~col.like("%WC%")) | (~col.like("%CC%")) | (~col.like("%UP%"))


def shipped_days(history: DataFrame) -> DataFrame:
    """Totes shipped per customer code, ship day and address, of the history
    rows that count (not will-call, load id without all three marks)."""
    return (history.filter(_not_all_marks("load_id") & (carrier_suffix("carrier", 2) != "WC"))
            .groupBy("customer_code", F.to_date("shipment_date").alias("ship_date"), *[F.col(a).alias("cs_" + a) for a in ADDR])
            .agg(F.sum("shipped_qty").alias("shipped_qty")))


def latest_days(days: DataFrame, n: int = 2) -> DataFrame:
    """The newest ``n`` ship days of each customer code. Two are enough for
    runs whose day never goes back: the newest day before the run's own is one
    of them. The rank is cut in each task before the rows of a code meet."""
    newest = F.dense_rank().over(Window.partitionBy("customer_code").orderBy(F.col("ship_date").desc()))
    return days.withColumn("_r", newest).filter(F.col("_r") <= n).drop("_r")


def merge_latest_days(kept: DataFrame, shipped: DataFrame) -> DataFrame:
    """The kept table after a run that shipped ``shipped`` (container shipments)."""
    new = shipped_days(shipped)
    both = (kept.select(*new.columns).unionByName(new)
            .groupBy("customer_code", "ship_date", *["cs_" + a for a in ADDR]).agg(F.sum("shipped_qty").alias("shipped_qty")))
    return latest_days(both)


def fallback_tote_count(cands: DataFrame, history: DataFrame | None, customers: DataFrame,
                        as_of=None, kept: DataFrame | None = None) -> DataFrame:
    """Where the prior-load count is 0: the shipped totes of the latest earlier
    ship day, summed per (day, shipped-to address), matching the candidate on
    customer code OR address. Ties on the day: smallest address first (K8).
    Candidates without history keep 0.

    ``kept`` is the table of :func:`merge_latest_days`; with it the history
    isn't read."""
    today = F.to_date(as_of_lit(as_of))
    ck = ["wh_id", "load_id", "order_number", "customer_id", *ADDR]
    hk = ["ship_date", *["cs_" + a for a in ADDR]]
    zero = cands.filter(F.col("tote_count") == 0).select(*ck, "customer_code")
    # the customer codes a candidate is matched with: its own, and those of
    # customers at its address (a customer without a record has no history)
    cu = customers.select("customer_code", *[F.col("customer_" + s).alias(a) for s, a in
                                             zip(("addr1", "city", "state", "zip"), ADDR)])
    at_addr = cu.join(zero.select(*ADDR).distinct(), ADDR, "left_semi").distinct()
    own = (zero.join(cu.select("customer_code").distinct(), "customer_code", "left_semi").distinct()
           .join(at_addr, [*ADDR, "customer_code"], "left_anti"))
    # of their history only the latest day per code can be a candidate's latest
    codes = own.select("customer_code").unionByName(at_addr.select("customer_code")).distinct()
    if kept is None:
        cs = shipped_days(history.filter(F.to_date("shipment_date") < today).join(codes, "customer_code", "left_semi"))
    else:
        cs = kept.filter(F.col("ship_date") < today).join(codes, "customer_code", "left_semi")
    day = stage(latest_days(cs, 1))
    # latest day first, then the smallest address: one min_by, no sort
    okey = F.struct((-F.datediff(F.col("ship_date"), F.lit("1970-01-01"))).alias("_nd"),
                    *[F.col("cs_" + a) for a in ADDR])
    best = F.min_by(F.struct(*hk, "_sum"), okey).alias("_b")
    # the customers of an address are summed once, whatever the number of its
    # candidates; only its best day and address can win for a candidate
    addr_best = (at_addr.join(day, "customer_code").groupBy(*ADDR, *hk).agg(F.sum("shipped_qty").alias("_sum"))
                 .groupBy(*ADDR).agg(best).select(*ADDR, "_b.*"))
    rows = (zero.select(*ck).distinct().join(addr_best, ADDR).select(*ck, *hk, "_sum")
            .unionByName(own.join(day, "customer_code").select(*ck, *hk, F.col("shipped_qty").alias("_sum"))))
    per_day = rows.groupBy(*ck, *hk).agg(F.sum("_sum").alias("_sum"))
    pick = per_day.groupBy(*ck).agg(F.min_by(F.col("_sum"), okey).alias("_fb"))
    return (cands.join(pick, ck, "left")
            .withColumn("tote_count", F.when((F.col("tote_count") == 0) & F.col("_fb").isNotNull(),
                                             F.col("_fb").cast("int"))
                        .otherwise(F.col("tote_count")))
            .drop("_fb"))


def tote_expectations(cands: DataFrame, customers: DataFrame, as_of=None) -> DataFrame:
    """Log rows of the tote counts sent: load_id is the prior load the count
    came from ('' when none), as in the reference; source_load_id is the load
    being sent."""
    cu = customers.select("customer_id", F.col("customer_code").alias("_cc"), "customer_name")
    return (cands.join(cu, "customer_id")
            .select("wh_id", F.col("_cc").alias("customer_code"), "customer_name",
                    F.col("prior_load_id").alias("load_id"),
                    F.col("load_id").alias("source_load_id"), "order_number",
                    F.col("tote_count").alias("tote_expected"),
                    as_of_lit(as_of).alias("create_date")))


def container_shipments(lines: DataFrame, containers: DataFrame, as_of=None,
                        ship_date_col: str | None = None) -> DataFrame:
    """Rows appended to the container-shipment history: COUNT(DISTINCT unit)
    per order and container type in shipping containers, for customers that
    need totes and lines with quantity > 0."""
    con = containers.filter(nz("shipping_container") == 1).select("wh_id", "container_type")
    l = lines.filter((nz("totes_required") == 1) & (F.col("quantity") > 0)).join(
        con, ["wh_id", "container_type"])
    keys = ["wh_id", "customer_code", "load_id", "order_number", "container_type", *ADDR,
            "stop_id", "carrier"]
    date = F.col(ship_date_col) if ship_date_col else as_of_lit(as_of)
    if ship_date_col:
        keys.append(ship_date_col)
    g = l.groupBy(*keys).agg(F.countDistinct("hu_id").cast("int").alias("shipped_qty"))
    return g.select("wh_id", "customer_code", "load_id", "order_number", "container_type",
                    "shipped_qty", date.alias("shipment_date"), *ADDR, "stop_id", "carrier")


# --------------------------------------------------------------------------
# backhaul purchase orders


def backhaul_pos(pending: DataFrame, stops: DataFrame, pos: DataFrame, po_lines: DataFrame,
                 receipts: DataFrame, backhauls: DataFrame) -> DataFrame:
    """Open POs to pick up on each pending load: same route, carrier (= the
    load's warehouse) and ship date; not COMPLETE in the backhaul table (a PO
    qualifies once if it has no backhaul row or any row not COMPLETE, K11);
    and no PO of that route/warehouse/date has a receipt (K12: the check is
    per route, not per PO). One row per PO line, keyed by load."""
    p = pending.join(stops, LOAD).select(
        *LOAD, "route_id", "shipment_date", "po_stop")
    pom = pos.filter(code("status") == "O").select(
        "po_number", F.col("wh_id").alias("po_wh_id"), F.col("carrier_scac").alias("wh_id"),
        "route_id", "shipment_date", "vendor_code", "sent_flag")
    bh = backhauls.select("po_number", F.col("wh_id").alias("po_wh_id"), "status")
    complete_only = (bh.groupBy("po_number", "po_wh_id")
                     .agg(F.min(F.when(F.coalesce(code("status"), F.lit("")) != "COMPLETE", 1)
                                .otherwise(0)).alias("_open")))
    blocked_po = complete_only.filter(F.col("_open") == 0).select("po_number", "po_wh_id")
    rec_routes = (receipts.select("po_number", "wh_id")
                  .join(pos.select("po_number", F.col("carrier_scac").alias("wh_id"),
                                   "route_id", "shipment_date"), ["po_number", "wh_id"])
                  .select("wh_id", "route_id", "shipment_date").distinct())
    j = (p.join(pom, ["wh_id", "route_id", "shipment_date"])
         .join(blocked_po, ["po_number", "po_wh_id"], "left_anti")
         .join(rec_routes, ["wh_id", "route_id", "shipment_date"], "left_anti"))
    pl = po_lines.select("po_number", F.col("wh_id").alias("po_wh_id"), "line_number",
                         "item_number")
    return (j.join(pl, ["po_number", "po_wh_id"])
            .select(*LOAD, "po_number", "po_wh_id", "vendor_code",
                    F.col("po_stop").alias("stop_id"), "route_id", "line_number",
                    "item_number", F.col("sent_flag").alias("sent_to_service")))


# --------------------------------------------------------------------------
# order lines and counts


def case_upcs(upcs: DataFrame) -> DataFrame:
    """Case UPCs of 12-14 characters (the GS1 candidates)."""
    return upcs.filter((code("uom") == "CS") & F.length(F.rtrim("upc")).between(12, 14))


def latest_case_gtin(upcs: DataFrame) -> DataFrame:
    """Newest case UPC per item (modified desc, then upc desc), padded to 14."""
    return (case_upcs(upcs).groupBy("wh_id", "item_number")
            .agg(F.max_by("upc", F.struct("modified_datetime", "upc")).alias("_u"))
            .select("wh_id", "item_number", case_gtin("_u").alias("gtin")))


def order_gtins(lines: DataFrame, order_detail: DataFrame, orders: DataFrame, customers: DataFrame,
                upcs: DataFrame, items: DataFrame) -> DataFrame:
    """UPCs (12-14 chars) of case lines of GS1 customers and GS1 items, ranked
    by upc desc per order line (the reference ranks per line of one order)."""
    ords = lines.select("wh_id", "load_id", "order_number").distinct()
    c = customers.filter((F.coalesce(F.col("gln"), F.lit("")) != "")
                         & (nz("gs1_required_flag") != 0)).select("customer_id")
    o = orders.select("wh_id", "order_number", "customer_id").join(c, "customer_id", "left_semi")
    od = (order_detail.filter(code("order_uom") == "CS")
          .select("wh_id", "order_number", "line_number", "item_number"))
    it = items.filter(F.col("gs1_required_flag") == 1).select("wh_id", "item_number")
    u = upcs.filter(F.length(F.rtrim("upc")).between(12, 14)).select("wh_id", "item_number", "upc")
    j = (ords.join(o, ["wh_id", "order_number"]).join(od, ["wh_id", "order_number"])
         .join(it, ["wh_id", "item_number"]).join(u, ["wh_id", "item_number"]))
    w = Window.partitionBy("wh_id", "load_id", "order_number", "line_number").orderBy(F.col("upc").desc())
    return j.select(*LOAD, "order_number", "line_number", "upc",
                    F.row_number().over(w).alias("rownum"))


def counted_product_totals(shipments: DataFrame) -> DataFrame:
    """Four counts per order in one pass: CIG+CIGP, LILCIG, SNF+SNFP, ECIG."""
    t = code("product_type")

    def s(*types):
        return F.coalesce(F.sum(F.when(t.isin(*types), F.col("uom_qty"))), F.lit(0)).cast("int")

    return (shipments.groupBy("wh_id", "load_id", "order_number")
            .agg(s("CIG", "CIGP").alias("cig_count"), s("LILCIG").alias("lil_cig_count"),
                 s("SNF", "SNFP").alias("snuff_count"), s("ECIG").alias("ecig_count")))


def _line_base(lines: DataFrame, order_detail: DataFrame, items: DataFrame, upcs: DataFrame) -> DataFrame:
    """The work set's lines with their order line, item and arm, read once for
    both arms. The work set comes first, so no join sees the lines of other
    loads' orders. Picks of one order line were summed into the work set per
    unit; order detail has one row per order line."""
    hs = lines.select(*LOAD, "order_number", "line_number", "hu_id", "gs1_required_flag", "quantity", "gln")
    od = order_detail.select("wh_id", "order_number", "line_number", "item_number", "order_uom", "qty")
    im = items.select("wh_id", "item_number", "class_id", "description", "net_weight_barcode")
    has_case = case_upcs(upcs).select("wh_id", "item_number").distinct().withColumn("_case", F.lit(True))
    j = (hs.join(od, ["wh_id", "order_number", "line_number"]).join(im, ["wh_id", "item_number"])
         .join(has_case, ["wh_id", "item_number"], "left"))
    # GS1 arm test; NULL order_uom makes it unknown, so the line is in neither arm (K9)
    gs1 = ((code("order_uom") == "CS") & (F.coalesce(F.col("gln"), F.lit("")) != "")
           & F.coalesce(F.col("_case"), F.lit(False)))
    return j.withColumn("_gs1_arm", gs1)


def _line_cols(df: DataFrame, line_id, gs1_type, gs1_number) -> DataFrame:
    nw = nz("net_weight_barcode") != 0
    return df.select(
        *LOAD, "order_number", line_id.alias("line_id"),
        F.lit("item").alias("type_name"), F.col("class_id").alias("type_description"),
        purpose_code("class_id").cast("string").alias("purpose_number"),
        "description", F.col("_q").cast("bigint").alias("ordered_quantity"),
        F.lit(0).alias("fulfilled_quantity"), F.col("_q").cast("bigint").alias("service_quantity"),
        gs1_type.alias("gs1_type"), gs1_number.alias("gs1_number"),
        F.when(nw, F.lit("netWeightBarcode")).alias("property_name"),
        F.when(nw, F.lit("GS1NetWeightFlag")).alias("property_description"),
        F.when(nw, F.lit("string")).alias("property_data_type"),
        F.when(nw, F.col("net_weight_barcode").cast("string")).alias("property_value"),
        "item_number", "order_uom")


def order_lines(lines, order_detail, items, upcs, gs1: bool | None = None) -> DataFrame:
    """Message lines of both arms from one pass (``gs1`` restricts to one).

    Case lines of GLN customers with a case UPC give one row per handling
    unit: line id = unit id, plus '-GS1' when GS1 is required; GTIN when
    required. Every other line (NOT the GS1 test, in three-valued logic) gives
    one row per order line."""
    arm = F.col("_gs1_arm")
    base = _line_base(lines, order_detail, items, upcs)
    base = base.filter(arm.isNotNull() if gs1 is None else arm if gs1 else ~arm)
    g = (base.groupBy(*LOAD, "order_number", "class_id", "item_number", "line_number", "description",
                      "qty", "order_uom", "net_weight_barcode", "_gs1_arm",
                      F.when(arm, F.col("hu_id")).alias("hu_id"),
                      F.when(arm, F.col("gs1_required_flag")).alias("gs1_required_flag"))
         .agg(F.sum("quantity").alias("_q")))
    g = g.join(latest_case_gtin(upcs), ["wh_id", "item_number"], "left")
    req = arm & (F.col("gs1_required_flag") == 1)
    unit = F.concat(F.col("hu_id"), F.when(req, F.lit("-GS1")).otherwise(F.lit("")))
    return _line_cols(g, F.when(arm, unit).otherwise(F.col("line_number")),
                      F.when(req, F.lit("GTIN")), F.when(req, F.col("gtin")))


def gs1_order_lines(lines, order_detail, items, upcs) -> DataFrame:
    """The GS1 arm of :func:`order_lines`."""
    return order_lines(lines, order_detail, items, upcs, gs1=True)


def standard_order_lines(lines, order_detail, items, upcs) -> DataFrame:
    """The other arm of :func:`order_lines`."""
    return order_lines(lines, order_detail, items, upcs, gs1=False)


_PROPS = [
    # Fixed values: (name, description) of the optional order properties, in
    # message order.
    ("destGLN", "Customer Destination GLN"),
    ("ExpectedPickups", "Expected Pickups"),
    ("chainName", "GS1 Chain Name"),
    ("ExpectedCigCount", "Expected Cig Count"),
    ("ExpectedLilCigCount", "Expected Lil Cig Count"),
    ("ExpectedECigCount", "Expected E-Cig Count"),
    ("ExpectedSnuffCount", "Expected Snuff Count"),
]


def order_headers(lines: DataFrame, orders: DataFrame, customers: DataFrame, totes: DataFrame,
                  totals: DataFrame) -> DataFrame:
    """One row per (load, order) in the work set with the customer, tote count
    and the four counted-product totals (0 when absent)."""
    ords = lines.select(*LOAD, "order_number").distinct()
    o = orders.drop("load_id")
    c = customers.select("customer_id", "customer_code", "customer_name", "gln",
                         F.col("gs1_required_flag").alias("cust_gs1"), "chain_name")
    t = totes.select(*LOAD, "order_number", "customer_id", F.col("tote_count").alias("_tc"))
    tt = totals.select(*LOAD, "order_number", "cig_count", "lil_cig_count", "snuff_count",
                       "ecig_count")
    h = (ords.join(o, ["wh_id", "order_number"]).join(c, "customer_id")
         .join(t, [*LOAD, "order_number", "customer_id"], "left")
         .join(tt, [*LOAD, "order_number"], "left"))
    for k in ("cig_count", "lil_cig_count", "snuff_count", "ecig_count"):
        h = h.withColumn(k, nz(k))
    return h.withColumn("tote_count", F.col("_tc")).drop("_tc")


def order_properties(headers: DataFrame) -> DataFrame:
    """Optional name/description/type/value entries per order, absent when
    empty or 0, as an ordered array column ``properties``."""
    gs1 = nz("cust_gs1") != 0
    tests = [
        ((F.coalesce(F.col("gln"), F.lit("")) != "") & gs1, F.col("gln")),
        (nz("tote_count") != 0, F.col("tote_count").cast("string")),
        ((F.coalesce(F.col("chain_name"), F.lit("")) != "") & gs1, F.col("chain_name")),
        (nz("cig_count") != 0, F.col("cig_count").cast("string")),
        (nz("lil_cig_count") != 0, F.col("lil_cig_count").cast("string")),
        (nz("ecig_count") != 0, F.col("ecig_count").cast("string")),
        (nz("snuff_count") != 0, F.col("snuff_count").cast("string")),
    ]
    entries = [F.when(t, F.struct(F.lit(n).alias("_name"), F.lit(d).alias("_description"),
                                   F.lit("string").alias("_dataType"), v.alias("_VALUE")))
               for (n, d), (t, v) in zip(_PROPS, tests)]
    return headers.withColumn("properties", F.array_compact(F.array(*entries)))


# --------------------------------------------------------------------------
# purchase order lines, state


def po_lines_message(po: DataFrame, po_lines: DataFrame, items: DataFrame, upcs: DataFrame) -> DataFrame:
    """Pickup lines of each selected PO: SUM(qty) as int per PO line. The two
    arms of the reference project the same columns, so one aggregate with the
    arm test (which only drops NULL-uom lines that have a case UPC, K10)."""
    sel = po.select(*LOAD, "po_number", "po_wh_id", "line_number").distinct()
    pl = po_lines.select("po_number", F.col("wh_id").alias("po_wh_id"), "line_number",
                         "item_number", "order_uom", "qty")
    im = items.select(F.col("wh_id").alias("po_wh_id"), "item_number", "class_id", "description")
    has_case = (case_upcs(upcs).select(F.col("wh_id").alias("po_wh_id"), "item_number").distinct()
                .withColumn("_case", F.lit(True)))
    j = (sel.join(pl, ["po_number", "po_wh_id", "line_number"]).join(im, ["po_wh_id", "item_number"])
         .join(has_case, ["po_wh_id", "item_number"], "left"))
    a = (code("order_uom") == "CS") & F.coalesce(F.col("_case"), F.lit(False))
    j = j.filter(a | ~a)
    g = (j.groupBy(*LOAD, "po_number", "po_wh_id", "class_id", "item_number", "line_number",
                   "description", "qty", "order_uom")
         .agg(F.sum("qty").cast("int").alias("_q")))
    return g.select(*LOAD, "po_number", "line_number", F.lit("item").alias("type_name"),
                    F.col("class_id").alias("type_description"),
                    F.lit("pickup").alias("purpose_number"), "description",
                    F.col("_q").alias("ordered_quantity"), F.lit(0).alias("fulfilled_quantity"),
                    F.col("_q").alias("service_quantity"), "item_number", "order_uom")


def po_state_update(pos: DataFrame, backhauls: DataFrame, po: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pos, backhauls) after sending: sent flag 1 on every PO handled; backhaul
    rows of POs that were sent before (resent now) become SENT."""
    handled = po.select("po_number").distinct().withColumn("_h", F.lit(1))
    resent = (po.filter(F.col("sent_to_service") == 1).select("po_number").distinct()
              .withColumn("_r", F.lit(1)))
    pcols, bcols = pos.columns, backhauls.columns
    new_pos = (pos.join(handled, "po_number", "left")
               .withColumn("sent_flag", F.when(F.col("_h") == 1, F.lit(1)).otherwise(F.col("sent_flag")))
               .select(*pcols))
    new_bh = (backhauls.join(resent, "po_number", "left")
              .withColumn("status", F.when(F.col("_r") == 1, F.lit("SENT")).otherwise(F.col("status")))
              .select(*bcols))
    return new_pos, new_bh


# --------------------------------------------------------------------------
# pallets


def pallet_heads(lines: DataFrame, upcs: DataFrame) -> DataFrame:
    """One row per unit: its first work-set row (order_number, line_number,
    item_number order; the reference takes an arbitrary TOP 1, K8) and
    whether that row is a GS1 case pick (case uom, GLN, case UPC)."""
    first = (lines.groupBy(*LOAD, "hu_id")
             .agg(F.min_by(F.struct("order_number", "order_uom", "gln", "item_number",
                                    "hu_desc", "cartonization_batch_id", "class_id",
                                    "pick_area"),
                           F.struct("order_number", "line_number", "item_number")).alias("_f"))
             .select(*LOAD, "hu_id", "_f.*"))
    has_case = case_upcs(upcs).select("wh_id", "item_number").distinct().withColumn("_case", F.lit(True))
    f = first.join(has_case, ["wh_id", "item_number"], "left")
    gs1 = ((code("order_uom") == "CS") & (F.coalesce(F.col("gln"), F.lit("")) != "")
           & F.coalesce(F.col("_case"), F.lit(False)))
    return f.withColumn("gs1_case_pick", F.coalesce(gs1, F.lit(False))).drop("_case")


def non_gs1_pallets(heads: DataFrame) -> DataFrame:
    """Units sent as pallets: all but GS1 case picks."""
    return heads.filter(~F.col("gs1_case_pick"))


def pallet_purpose(heads: DataFrame) -> DataFrame:
    """TOTE batch -> 27; else the class's code when a class is set; else the
    pick area's code; else 13."""
    cls_set = F.coalesce(F.col("class_id"), F.lit("")) != ""
    p = (F.when(F.col("cartonization_batch_id").like("TOTE%"), F.lit(27))
         .when(cls_set, purpose_code("class_id"))
         .otherwise(purpose_code("pick_area")))
    return heads.withColumn("purpose_number", p.cast("string"))


def pallet_items(lines: DataFrame) -> DataFrame:
    """SUM(quantity) per unit, order and line."""
    return (lines.groupBy(*LOAD, "hu_id", "order_number", "line_number")
            .agg(int_sum("quantity").alias("quantity")))


def complete_loads(queue: DataFrame, processed: DataFrame, as_of=None) -> DataFrame:
    """Load queue after the run: processed rows get status 2 and a time."""
    p = processed.select("unique_id").distinct().withColumn("_p", F.lit(1))
    cols = queue.columns
    prev = F.col("dt_processed") if "dt_processed" in cols else F.lit(None).cast("timestamp_ntz")
    out = (queue.join(p, "unique_id", "left")
           .withColumn("queue_status", F.when(F.col("_p") == 1, F.lit(2)).otherwise(F.col("queue_status")))
           .withColumn("dt_processed", F.when(F.col("_p") == 1, as_of_lit(as_of)).otherwise(prev)))
    return out.select(*cols, *([] if "dt_processed" in cols else ["dt_processed"]))
