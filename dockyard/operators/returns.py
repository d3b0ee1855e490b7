"""Customer returns: outbound return messages and the intake
of ad hoc returns reported by drivers.

In the reference both paths exist but receive no input (the return selector
and the intake are commented out); here they run over caller-supplied return
tables, keyed by RMA (and by load / import message where the reference keeps
per-loop state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.functions.columns import as_of_lit, code, nz, tsql_concat, tsql_plus
from dockyard.functions.keys import assign_ids
from dockyard.operators.inbound import first_below
from dockyard.operators.messages import (
    COUNTRY, DEFAULT_SERVICE_INSTRUCTIONS, ORDER_TYPE_DESCRIPTION, ORDER_TYPE_NAME, PHASE_RETURN,
    _fix_item_names, dt_text, ts_text, xml_text)

UPC_SLOTS = 10  # fixed value: the message has ten UPC elements per line
RETURN_PURPOSES = ["Product Pickup", "18"]
DEFAULT_RMA_PREFIX = "RTN"


def _qty(q, f):
    # int / int in the reference: truncating division, via the shared rounding
    return F.floor(F.round(F.col(q).cast("double") / F.col(f), 6)).cast("int")


def open_returns(rmas: DataFrame, lines: DataFrame, routes: DataFrame, shipped: DataFrame,
                 pending: DataFrame) -> DataFrame:
    """Returns to send with each pending load: OPEN RMAs of customers served
    by the load, with a line still to collect (received < qty, not received
    by the driver), when the warehouse lists the load's route or ALL. Stop =
    the customer's lowest stop on the load (the reference takes any, K8)."""
    open_lines = (lines.filter((nz("qty_received") < F.col("qty")) & (nz("received_flag") == 0))
                  .select("rma_number", "wh_id").distinct())
    r = (rmas.filter(code("status") == "OPEN")
         .join(open_lines, ["rma_number", "wh_id"], "left_semi"))
    cust = (shipped.groupBy("wh_id", "load_id", "customer_code")
            .agg(F.min("stop_id").alias("stop_id")))
    p = pending.select("wh_id", "load_id", "route_id")
    rt = routes.select("wh_id", F.col("route").alias("_route")).distinct()
    # the OR as two equi-joins: the load's own route, or a warehouse that lists ALL
    own = (p.withColumnRenamed("route_id", "_route").join(rt, ["wh_id", "_route"], "left_semi")
           .select("wh_id", "load_id"))
    every = p.join(rt.filter(F.col("_route") == "ALL").select("wh_id"), "wh_id", "left_semi").select("wh_id", "load_id")
    ok = (cust.join(own.union(every).distinct(), ["wh_id", "load_id"], "left_semi")
          .select("wh_id", "load_id", "customer_code", "stop_id").distinct())
    return (r.join(ok, ["wh_id", "customer_code"])
            .select("wh_id", "load_id", "rma_number", "customer_code", "stop_id",
                    nz("sent_flag").alias("sent_to_service")))


def return_upcs(lines: DataFrame, upcs: DataFrame, slots: int = UPC_SLOTS) -> DataFrame:
    """Distinct UPCs per (warehouse, item) on return lines, ranked by upc
    descending, as many as the message has ``slots`` for; ``n_left_out`` says
    how many more the item has. UPCs per item are few, so the ranking window
    is small."""
    items = lines.select("wh_id", "item_number").distinct()
    u = upcs.select("wh_id", "item_number", "upc").distinct().join(items, ["wh_id", "item_number"],
                                                                   "left_semi")
    w = Window.partitionBy("wh_id", "item_number").orderBy(F.col("upc").desc())
    n = F.count(F.lit(1)).over(Window.partitionBy("wh_id", "item_number"))
    return (u.withColumn("rownum", F.row_number().over(w))
            .withColumn("n_left_out", F.greatest(n - slots, F.lit(0)).cast("int"))
            .filter(F.col("rownum") <= slots))


def return_gtins(rmas: DataFrame, customers: DataFrame, lines: DataFrame,
                 upcs: DataFrame) -> DataFrame:
    """Top GTIN per case line of a GLN customer's RMA (upc descending)."""
    c = customers.filter(F.coalesce(F.col("gln"), F.lit("")) != "").select("customer_code")
    r = rmas.join(c, "customer_code", "left_semi").select("rma_number", "wh_id")
    ln = (lines.filter(code("uom") == "CS").join(r, ["rma_number", "wh_id"], "left_semi")
          .select("rma_number", "wh_id", "line_number", "item_number", "uom"))
    u = upcs.filter(F.length(F.rtrim("upc")).between(12, 14)).select("wh_id", "item_number",
                                                                     "uom", "upc")
    j = ln.join(u, ["wh_id", "item_number", "uom"])
    return (j.groupBy("rma_number", "wh_id", "line_number")
            .agg(F.max("upc").alias("gtin")))


def return_lines(lines: DataFrame, items: DataFrame, uoms: DataFrame, upc_list: DataFrame,
                 gtins: DataFrame) -> DataFrame:
    """Open lines of each RMA with quantities in the line's unit (truncated to
    int), description 'uom-description', the UPC list and the GTIN."""
    ol = lines.filter((nz("qty_received") < F.col("qty")) & (nz("received_flag") == 0))
    im = items.select("wh_id", "item_number", "class_id", "description")
    iu = uoms.select("wh_id", "item_number", "uom", "conversion_factor")
    ul = (upc_list.groupBy("wh_id", "item_number")
          .agg(F.array_sort(F.collect_list(F.struct(F.col("rownum"), F.col("upc"))))
               .alias("_u"))
          .select("wh_id", "item_number", F.transform("_u", lambda e: e["upc"]).alias("upcs")))
    j = (ol.join(im, ["wh_id", "item_number"]).join(iu, ["wh_id", "item_number", "uom"])
         .join(ul, ["wh_id", "item_number"], "left")
         .join(gtins, ["rma_number", "wh_id", "line_number"], "left"))
    return j.select(
        "rma_number", "wh_id", "line_number", "item_number", "uom", "class_id",
        tsql_plus(F.col("uom"), F.lit("-"), F.col("description")).alias("description"),
        _qty("qty", "conversion_factor").alias("ordered_quantity"),
        F.floor(F.round(nz("qty_received").cast("double") / F.col("conversion_factor"), 6))
         .cast("int").alias("fulfilled_quantity"),
        _qty("qty", "conversion_factor").alias("service_quantity"),
        F.coalesce(F.col("upcs"), F.array().cast("array<string>")).alias("upcs"), "gtin")


def return_message_keys(selected: DataFrame) -> DataFrame:
    """Queue keys of return messages: reopen (sub 0) + update (sub 1) when the
    RMA was sent before, else one add (sub 1)."""
    main = selected.select(
        "wh_id", "load_id", F.col("rma_number").alias("msg_key"), F.lit(1).alias("sub"),
        F.col("rma_number").alias("order_number"),
        F.when(F.col("sent_to_service") == 1, F.lit("updateOrderAndCustomerRequest"))
         .otherwise(F.lit("addOrderAndCustomerRequest")).alias("message_type"))
    reopen = selected.filter(F.col("sent_to_service") == 1).select(
        "wh_id", "load_id", F.col("rma_number").alias("msg_key"), F.lit(0).alias("sub"),
        F.col("rma_number").alias("order_number"), F.lit("reopenOrderRequest").alias("message_type"))
    return main.unionByName(reopen).withColumn("phase", F.lit(PHASE_RETURN))


def return_messages(selected: DataFrame, rmas: DataFrame, customers: DataFrame,
                    rlines: DataFrame, ids: DataFrame, pending: DataFrame, whse: DataFrame,
                    system_name: str = "legacySystem", as_of=None) -> DataFrame:
    """Messages of each selected (load, RMA): add, or reopen + update when the
    RMA was sent before (keys from :func:`return_message_keys`), with its open
    lines, up to ten UPC barcodes and the GTIN per line."""
    keys = ["wh_id", "load_id", "rma_number"]
    item = F.struct(
        F.lit("item").alias("_typeName"), F.col("class_id").alias("_typeDescription"),
        F.lit("Product Pickup").alias("_purposeNumber"),
        F.col("line_number").alias("lineNumber"), F.col("description").alias("description"),
        F.col("ordered_quantity").cast("string").alias("orderedQuantity"),
        F.col("fulfilled_quantity").cast("string").alias("fulfilledQuantity"),
        F.col("service_quantity").cast("string").alias("serviceQuantity"),
        F.transform("upcs", lambda u: F.struct(F.lit("upc").alias("_typeName"),
                                               F.lit("upc").alias("_typeDescription"),
                                               u.alias("_VALUE"))).alias("barcode"),
        F.when(F.col("gtin").isNotNull(), F.struct(F.lit("GTIN").alias("_type"),
                                                   F.col("gtin").alias("_VALUE"))).alias("gs1Number"),
        F.struct(F.lit("SKU").alias("_typeName"), F.lit("SKU Description").alias("_typeDescription"),
                 F.col("item_number").alias("_VALUE")).alias("identificationNumber"),
        F.col("item_number").alias("name"),
        F.col("item_desc").alias("description2"),
        F.struct(F.col("uom").alias("abbreviation"), F.col("uom").alias("description"))
         .alias("unitOfMeasure"),
        F.struct(F.col("ordered_quantity").cast("string").alias("quantity"),
                 F.col("uom").alias("description")).alias("packagingInfo"))
    rl = selected.select(*keys).join(rlines.withColumn(
        "item_desc", F.regexp_replace(F.col("description"), r"^[^-]*-", "")),
        ["wh_id", "rma_number"])
    items = (rl.groupBy(*keys)
             .agg(F.array_sort(F.collect_list(F.struct(F.col("line_number").alias("_k"),
                                                       item.alias("_v")))).alias("_i"))
             .select(*keys, F.transform("_i", lambda e: e["_v"]).alias("orderItem")))
    mid = ids.filter(F.col("phase") == PHASE_RETURN).select(
        "wh_id", "load_id", F.col("msg_key").alias("rma_number"), "sub", "message_id",
        "message_type")
    cu = customers.select("customer_code", "customer_name", "customer_addr1", "customer_city",
                          "customer_state", "customer_zip")
    rm = rmas.select("rma_number", "wh_id", "order_date")
    h = (selected.join(mid, keys).join(rm, ["rma_number", "wh_id"], "left")
         .join(cu, "customer_code", "left")
         .join(pending.select("wh_id", "load_id", "route_id"), ["wh_id", "load_id"], "left")
         .join((whse.select("wh_id", "pod_whse")), "wh_id", "left")
         .join(items, keys, "left"))
    now = as_of_lit(as_of)
    reopen = F.struct(
        F.col("message_id").cast("string").alias("_transactionId"), ts_text(now).alias("_timestamp"),
        F.lit(system_name).alias("systemName"), F.col("rma_number").alias("orderNumber"),
        F.col("stop_id").cast("string").alias("expectedSequence"),
        ts_text(now).alias("expectedStart"),
        ts_text(now + F.expr("INTERVAL 1 DAY")).alias("expectedEnd"),
        F.col("pod_whse").alias("centerNumber"), F.col("route_id").alias("routeNumber"))
    order = F.struct(
        F.lit(ORDER_TYPE_NAME).alias("_typeName"), F.lit(ORDER_TYPE_DESCRIPTION).alias("_typeDescription"),
        F.lit("false").alias("_canceled"), F.col("rma_number").alias("orderNumber"),
        dt_text("order_date").alias("orderDate"), ts_text("order_date").alias("serviceWindowStart"),
        F.col("stop_id").cast("string").alias("expectedServiceSequence"),
        F.lit("0").alias("expectedPayment"), F.lit("false").alias("backOrder"),
        F.lit("false").alias("acceptAll"),
        F.lit(DEFAULT_SERVICE_INSTRUCTIONS).alias("serviceInstructions"),
        F.lit("false").alias("sendWireless"), F.lit("false").alias("scheduledEmpty"),
        F.lit("0").alias("expectedItemQuantity"),
        F.struct(F.lit("PRINTPRICESIND").alias("_name"), F.lit("Pr Ind").alias("_description"),
                 F.lit("boolean").alias("_dataType"), F.lit("N").alias("_VALUE")).alias("property"),
        F.lit("true").alias("authorizedSignerRequired"), F.col("orderItem"))
    doc = F.struct(
        F.col("message_id").cast("string").alias("_transactionId"), ts_text(now).alias("_timestamp"),
        F.lit(system_name).alias("systemName"), F.col("pod_whse").alias("centerNumber"),
        F.col("route_id").alias("routeNumber"),
        F.struct(F.lit("false").alias("_mailConfirmationRequired"),
                 F.col("customer_code").alias("customerNumber"),
                 F.col("customer_name").alias("customerName"),
                 F.lit("true").alias("printReceipt")).alias("customer"),
        F.struct(F.col("customer_addr1").alias("addressLine1"), F.col("customer_city").alias("city"),
                 F.col("customer_state").alias("state"), F.col("customer_zip").alias("zipCode"),
                 F.lit(COUNTRY).alias("country")).alias("customerAddress"),
        F.struct(F.col("customer_name").alias("firstName"), F.col("customer_name").alias("lastName"),
                 F.left(F.col("customer_addr1"), F.lit(30)).alias("location"),
                 F.lit("true").alias("active")).alias("contact"),
        F.struct(tsql_concat(F.col("stop_id").cast("string"), F.col("route_id")).alias("groupNumber"),
                 order.alias("order")).alias("orders"))
    mt = F.col("message_type")
    xml = (F.when(mt == "reopenOrderRequest", xml_text(reopen, "reopenOrderRequest"))
           .when(mt == "updateOrderAndCustomerRequest",
                 _fix_item_names(xml_text(doc, "updateOrderAndCustomerRequest")))
           .otherwise(_fix_item_names(xml_text(doc, "addOrderAndCustomerRequest"))))
    return h.select("message_id", "wh_id", "load_id", F.col("rma_number").alias("order_number"),
                    "message_type", xml.alias("message_xml"))


# --------------------------------------------------------------------------
# intake of returns reported with delivery events


def return_intake(items: DataFrame, header: DataFrame, reasons: DataFrame, upcs: DataFrame,
                  item_master: DataFrame, rmas: DataFrame, picks: DataFrame,
                  wh_control: DataFrame | None = None) -> DataFrame:
    """Return lines reported by drivers -> rows for the RMA detail table.

    Per item of a deliverable event: an adjustment (< 0) on a line whose
    purpose is not Product Pickup becomes a return (purpose 18, quantity =
    -adjustment, adjustment reason); only purposes Product Pickup / 18 (or an
    unknown purpose, T-SQL's NOT IN on NULL) go on; the reason must be a
    RETURNS reason or the order an existing RMA. The item is found by UPC,
    then by item number, then (adjustments) by the picked unit or line of
    the order; the GS1 barcode parse is not built. Lines without an RMA get a
    new RMA per (message, order, warehouse): prefix (control RMA_NUMBER, else
    RTN) + a number from the id assigner after the highest existing one, and line numbers n||'000' per item.
    """
    one = lambda path: first_below(F.col("it"), path)
    it = items.select(
        "unique_id", one("lineNumber").alias("line_number"),
        one("acceptedQuantity").try_cast("int").alias("qty_accepted"),
        one("expectedQuantity").try_cast("int").alias("qty_expected"),
        one("createdOnClient/reason/reasonCode").alias("reason_code"),
        one("createdOnClient/reason/reasonDescription").alias("reason_description"),
        one("purposeNumber").alias("purpose_number"),
        one("adjustment/adjustQuantity").try_cast("int").alias("adjust_qty"),
        one("adjustment/reason/reasonCode").alias("adjust_reason_code"),
        one("adjustment/reason/reasonDescription").alias("adjust_reason_description"))
    conv = (F.col("adjust_qty") < 0) & (F.col("purpose_number") != "Product Pickup")
    conv = F.coalesce(conv, F.lit(False))
    os_ = (it.withColumn("_c", conv)
           .withColumn("purpose_number", F.when(F.col("_c"), F.lit("18")).otherwise(F.col("purpose_number")))
           .withColumn("qty_expected", F.when(F.col("_c"), -F.col("adjust_qty")).otherwise(F.col("qty_expected")))
           .withColumn("qty_accepted", F.when(F.col("_c"), -F.col("adjust_qty")).otherwise(F.col("qty_accepted")))
           .withColumn("reason_code", F.when(F.col("_c"), F.col("adjust_reason_code")).otherwise(F.col("reason_code")))
           .withColumn("reason_description", F.when(F.col("_c"), F.col("adjust_reason_description"))
                       .otherwise(F.col("reason_description")))
           .drop("_c"))
    # NOT IN keeps rows whose purpose is NULL (three-valued logic)
    os_ = os_.filter(~F.coalesce(~F.col("purpose_number").isin(*RETURN_PURPOSES), F.lit(False)))
    h = header.select("unique_id", "wh_id", "order_number", "customer_code", "customer_name")
    os_ = os_.join(h, "unique_id")
    rs = (reasons.filter(code("type") == "RETURNS").select(F.col("reason_id").alias("reason_code"))
          .distinct().withColumn("host_reason_code", F.col("reason_code")))
    os_ = os_.join(rs, "reason_code", "left")
    known = rmas.select(F.col("rma_number").alias("order_number"), "wh_id").distinct() \
                .withColumn("_rma", F.col("order_number"))
    os_ = (os_.join(known, ["order_number", "wh_id"], "left")
           .filter(F.col("host_reason_code").isNotNull() | F.col("_rma").isNotNull()))
    # item lookups for ad hoc lines: by UPC, then by item number
    by_upc = (upcs.groupBy("wh_id", F.col("upc").alias("line_number"))
              .agg(F.min_by(F.struct("item_number", "uom"), F.struct("item_number", "uom")).alias("_u")))
    by_item = item_master.select("wh_id", F.col("item_number").alias("line_number"),
                                 F.col("item_number").alias("_i2"))
    os_ = os_.join(by_upc, ["wh_id", "line_number"], "left").join(by_item, ["wh_id", "line_number"], "left")
    adhoc = F.col("_rma").isNull()
    item = F.when(adhoc, F.coalesce(F.col("_u.item_number"), F.col("_i2")))
    uom = F.when(adhoc, F.when(F.col("_u.item_number").isNotNull(), F.col("_u.uom"))
                 .when(F.col("_i2").isNotNull(), F.lit(None).cast("string")))
    os_ = os_.withColumn("item_number", item).withColumn("uom", uom) \
             .withColumn("upc", F.when(adhoc & F.col("_u.item_number").isNotNull(), F.col("line_number")))
    # adjustments: the picked unit or line of the order, unless the unit is ambiguous
    # only the reported orders' picks: their keys are few beside the pick history
    reported = os_.select("wh_id", "order_number").distinct()
    pk = (picks.select("wh_id", "order_number", "container_id", "line_number", "item_number", "uom")
          .join(reported, ["wh_id", "order_number"], "left_semi"))
    by_cont = (pk.groupBy("wh_id", "order_number", F.col("container_id").alias("_ln"))
               .agg(F.count("*").alias("_n"), F.max_by(F.struct("item_number", "uom"), "line_number")
                    .alias("_p1")))
    by_line = (pk.groupBy("wh_id", "order_number", F.col("line_number").alias("_ln"))
               .agg(F.max_by(F.struct("item_number", "uom"), "container_id").alias("_p2")))
    # every adjustment row is looked up (the reference overwrites the item,
    # with NULL when nothing matches), unless the picked unit is ambiguous
    need = F.col("adjust_qty") < 1
    os_ = (os_.withColumn("_ln", F.regexp_replace("line_number", "-GS1", ""))
           .join(by_cont, ["wh_id", "order_number", "_ln"], "left")
           .join(by_line, ["wh_id", "order_number", "_ln"], "left"))
    unique_unit = F.coalesce(F.col("_n"), F.lit(0)) <= 1
    found = F.coalesce(F.col("_p1"), F.col("_p2"))
    os_ = (os_.withColumn("item_number", F.when(F.coalesce(need, F.lit(False)) & unique_unit,
                                                found["item_number"]).otherwise(F.col("item_number")))
              .withColumn("uom", F.when(F.coalesce(need, F.lit(False)) & unique_unit, found["uom"])
                          .otherwise(F.col("uom"))))
    new = os_.filter(F.col("_rma").isNull() & F.col("host_reason_code").isNotNull()
                     & F.col("item_number").isNotNull())
    prefix = F.lit(DEFAULT_RMA_PREFIX)
    if wh_control is not None:
        pf = (wh_control.filter(code("control_type") == "RMA_NUMBER")
              .select("wh_id", F.col("c1").alias("_pf")))
        new = new.join(pf, "wh_id", "left")
        prefix = F.coalesce(F.col("_pf"), prefix)
    new = new.withColumn("_prefix", prefix)
    heads = new.select("unique_id", "wh_id", "order_number", "_prefix").distinct()
    heads = assign_ids(heads, ["wh_id", "order_number", "unique_id"], "_seq")
    # numbers go on after the highest one of the prefix, and are padded but never cut
    parts = F.regexp_extract(F.rtrim("rma_number"), r"^(.*?)([0-9]+)$", 1), F.regexp_extract(F.rtrim("rma_number"), r"^(.*?)([0-9]+)$", 2)
    last = (rmas.select(parts[0].alias("_prefix"), parts[1].try_cast("bigint").alias("_n"))
            .groupBy("_prefix").agg(F.max("_n").alias("_last")))
    heads = heads.join(last, "_prefix", "left")
    number = (F.coalesce(F.col("_last"), F.lit(0)) + F.col("_seq")).cast("string")
    heads = heads.withColumn("rma_number", F.concat(
        F.col("_prefix"), F.when(F.length(number) >= 7, number).otherwise(F.right(F.concat(F.lit("000"), number), F.lit(7)))))
    new = new.join(heads.select("unique_id", "wh_id", "order_number", "rma_number"),
                   ["unique_id", "wh_id", "order_number"])
    itm = new.select("rma_number", "wh_id", "item_number").distinct()
    w = Window.partitionBy("rma_number", "wh_id").orderBy("item_number")
    itm = itm.withColumn("new_line", F.concat(F.row_number().over(w).cast("string"), F.lit("000")))
    return new.join(itm, ["rma_number", "wh_id", "item_number"]).select(
        "unique_id", "rma_number", "wh_id", "order_number", "customer_code", "customer_name",
        F.col("new_line").alias("line_number"), F.col("line_number").alias("reported_line"),
        "item_number", "uom", "upc", "qty_expected", "qty_accepted", "host_reason_code",
        "reason_description", "purpose_number")


def return_intake_detail(intake: DataFrame, uoms: DataFrame) -> DataFrame:
    """Rows appended to the RMA detail table: SUM(expected) x conversion
    factor per new line."""
    iu = uoms.select("wh_id", "item_number", "uom", "conversion_factor")
    return (intake.join(iu, ["wh_id", "item_number", "uom"])
            .groupBy("rma_number", "wh_id", "line_number", "item_number", "uom", "host_reason_code",
                     "conversion_factor")
            .agg((F.sum("qty_expected") * F.col("conversion_factor")).cast("bigint").alias("qty"))
            .select("rma_number", "wh_id", "line_number", "item_number", "uom", "qty",
                    F.col("host_reason_code").alias("reason_code"),
                    F.lit(0).alias("miss_picked_item"), F.lit(1).alias("received_by_service")))
