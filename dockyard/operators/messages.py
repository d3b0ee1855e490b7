"""Nested delivery messages: struct columns serialised with ``to_xml``.

Each message is one row: the nested document is assembled with ``struct`` /
``collect_list`` (grouped on the message key, bounded by lines per order or
items per unit), then serialised by ``to_xml``. Element order follows the
reference's FOR XML column order; NULL fields are omitted like FOR XML does.
Repeated children are sorted before serialisation, so the text is
deterministic.

Message ids (the queue identity in the reference, also the transactionId
attribute) are assigned once for all messages of the run, in send order:
per load (queue unique_id), orders, then purchase orders (reopen before
update), then pallets, then returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.functions.columns import as_of_lit, tsql_concat
from dockyard.functions.keys import assign_ids

LOAD = ["wh_id", "load_id"]
ORDER = ["wh_id", "load_id", "order_number"]

# Constant texts of the message documents.
ORDER_TYPE_NAME = "goods"
ORDER_TYPE_DESCRIPTION = "an order that consists of goods"
RETURN_ALERT = "You have a planned return on this stop. Printer Needed."
COUNTRY = "USA"
BARCODE_TYPE = "Code 128"
DEFAULT_SERVICE_INSTRUCTIONS = "WMS POD Interface"
DEFAULT_VENDOR_STATE = "WA"
DEFAULT_VENDOR_CONTACT = "BACKHAUL"

PHASE_ORDER, PHASE_PO, PHASE_PALLET, PHASE_RETURN = 1, 2, 3, 4


def xml_text(doc: Column, root: str) -> Column:
    """Serialise a struct as one XML element named ``root``, without
    indentation or blank lines between tags."""
    xml = F.rtrim(F.to_xml(doc, {"rowTag": root, "indent": ""}), F.lit("\n"))
    return F.regexp_replace(xml, r">\n\s*<", "><")


def ts_text(c) -> Column:
    """FORMAT(x, 'yyyy-MM-ddTHH:mm:ss.fffzzz') in the session time zone."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")


def dt_text(c) -> Column:
    """A datetime value as FOR XML writes it."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")


def _opt(df: DataFrame, name: str, typ: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


# --------------------------------------------------------------------------
# ids


def message_keys(pending: DataFrame, orders: DataFrame, pos: DataFrame, pallets: DataFrame,
                 returns: DataFrame | None = None) -> DataFrame:
    """One row per message to send: (load_uid, wh_id, load_id, phase, msg_key,
    sub, order_number, message_type)."""
    p = pending.select(F.col("unique_id").alias("load_uid"), *LOAD)
    o = orders.select(*ORDER).distinct().select(
        *LOAD, F.lit(PHASE_ORDER).alias("phase"), F.col("order_number").alias("msg_key"),
        F.lit(0).alias("sub"), "order_number",
        F.lit("addOrderAndCustomerRequest").alias("message_type"))
    ph = pos.groupBy(*LOAD, "po_number").agg(F.max("sent_to_service").alias("_sent"))
    po_main = ph.select(*LOAD, F.lit(PHASE_PO).alias("phase"), F.col("po_number").alias("msg_key"),
                        F.lit(1).alias("sub"), F.col("po_number").alias("order_number"),
                        F.when(F.col("_sent") == 1, F.lit("updateOrderAndCustomerRequest"))
                         .otherwise(F.lit("addOrderAndCustomerRequest")).alias("message_type"))
    po_reopen = ph.filter(F.col("_sent") == 1).select(
        *LOAD, F.lit(PHASE_PO).alias("phase"), F.col("po_number").alias("msg_key"),
        F.lit(0).alias("sub"), F.col("po_number").alias("order_number"),
        F.lit("reopenOrderRequest").alias("message_type"))
    pl = pallets.select(*LOAD, F.lit(PHASE_PALLET).alias("phase"), F.col("hu_id").alias("msg_key"),
                        F.lit(0).alias("sub"), "order_number",
                        F.lit("addPalletRequest").alias("message_type"))
    parts = [o, po_reopen, po_main, pl]
    if returns is not None:
        parts.append(returns.select(*LOAD, F.lit(PHASE_RETURN).alias("phase"), "msg_key", "sub",
                                    "order_number", "message_type"))
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    return u.join(p, LOAD)


def assign_message_ids(keys: DataFrame, existing_queue: DataFrame | None = None) -> DataFrame:
    """message_id = highest existing queue id + position in send order."""
    order = ["load_uid", "phase", "msg_key", "sub"]
    ids = assign_ids(keys, order, "_seq")
    if existing_queue is None:
        return ids.withColumnRenamed("_seq", "message_id")
    base = existing_queue.agg(F.coalesce(F.max("unique_id").cast("bigint"), F.lit(0))).scalar()
    return ids.withColumn("message_id", (base + F.col("_seq")).cast("bigint")).drop("_seq")


# --------------------------------------------------------------------------
# documents


def _item_struct(lines: DataFrame) -> Column:
    """orderItem element of a line row (order or PO line)."""
    return F.struct(
        F.col("type_name").alias("_typeName"),
        F.col("type_description").alias("_typeDescription"),
        F.col("purpose_number").alias("_purposeNumber"),
        F.col("line_id").alias("lineNumber"),
        F.col("description").alias("description"),
        F.col("ordered_quantity").cast("string").alias("orderedQuantity"),
        F.col("fulfilled_quantity").cast("string").alias("fulfilledQuantity"),
        F.col("service_quantity").cast("string").alias("serviceQuantity"),
        F.when(_opt(lines, "gs1_number").isNotNull() | _opt(lines, "gs1_type").isNotNull(),
               F.struct(_opt(lines, "gs1_type").alias("_type"),
                        _opt(lines, "gs1_number").alias("_VALUE"))).alias("gs1Number"),
        F.when(_opt(lines, "property_name").isNotNull(),
               F.struct(_opt(lines, "property_name").alias("_name"),
                        _opt(lines, "property_description").alias("_description"),
                        _opt(lines, "property_data_type").alias("_dataType"),
                        _opt(lines, "property_value").alias("_VALUE"))).alias("property"),
        F.struct(F.lit("SKU").alias("_typeName"), F.lit("SKU Description").alias("_typeDescription"),
                 F.col("item_number").alias("_VALUE")).alias("identificationNumber"),
        F.col("description").alias("name"),
        F.col("description").alias("description2"),  # renamed below
        F.struct(F.col("order_uom").alias("abbreviation"),
                 F.col("order_uom").alias("description")).alias("unitOfMeasure"),
    )


def _items_by(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted array of orderItem structs per message key."""
    it = lines.withColumn("_item", _item_struct(lines))
    return (it.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(F.col("line_id").alias("_k"),
                                                      F.col("_item").alias("_v"))))
                 .alias("_items"))
            .withColumn("orderItem", F.transform("_items", lambda e: e["_v"]))
            .drop("_items"))


def _fix_item_names(xml: Column) -> Column:
    # a struct cannot hold two fields named "description"; the second one is
    # written as description2 and renamed in the text
    return F.replace(F.replace(xml, F.lit("<description2>"), F.lit("<description>")),
                     F.lit("</description2>"), F.lit("</description>"))


def order_messages(headers: DataFrame, lines: DataFrame, ids: DataFrame, pending: DataFrame,
                   whse: DataFrame, system_name: str = "legacySystem",
                   service_instructions: str = DEFAULT_SERVICE_INSTRUCTIONS,
                   returns: DataFrame | None = None, as_of=None) -> DataFrame:
    """addOrderAndCustomerRequest per (load, order). ``headers`` carries the
    order, customer, tote count, totals and ``properties`` array. Orders of a
    customer that one of the load's ``returns`` belongs to carry an alert."""
    items = _items_by(lines, ORDER)
    mid = ids.filter(F.col("phase") == PHASE_ORDER).select(*LOAD, F.col("msg_key").alias("order_number"),
                                                           "message_id", "load_uid")
    route = pending.select(*LOAD, "route_id")
    wh = (whse.select("wh_id", "pod_whse"))
    h = (headers.drop("route_id").join(mid, ORDER).join(route, LOAD, "left").join(wh, "wh_id", "left")
         .join(items, ORDER, "left"))
    if returns is not None:
        rc = returns.select(*LOAD, "customer_code").distinct().withColumn("_ret", F.lit(True))
        h = h.join(rc, [*LOAD, "customer_code"], "left")
        alert = F.when(F.col("_ret"), F.lit(RETURN_ALERT))
    else:
        alert = F.lit(None).cast("string")
    ts = ts_text(as_of_lit(as_of))
    order = F.struct(
        F.lit(ORDER_TYPE_NAME).alias("_typeName"),
        F.lit(ORDER_TYPE_DESCRIPTION).alias("_typeDescription"),
        F.lit("false").alias("_canceled"),
        F.col("order_number").alias("orderNumber"),
        dt_text("order_date").alias("orderDate"),
        F.when(F.coalesce(_opt(h, "cust_po_number"), F.lit("")) != "",
               _opt(h, "cust_po_number")).alias("poNumber"),
        # K14: the reference selects the window start twice; both values kept
        F.array_compact(F.array(ts_text("earliest_ship_date"),
                                ts_text(_opt(h, "actual_ship_date", "timestamp_ntz"))))
         .alias("serviceWindowStart"),
        F.col("stop_id").cast("string").alias("expectedServiceSequence"),
        F.lit("0").alias("expectedPayment"),
        F.lit("false").alias("backOrder"),
        alert.alias("alert"),
        F.lit("false").alias("acceptAll"),
        F.lit(service_instructions).alias("serviceInstructions"),
        F.lit("false").alias("sendWireless"),
        F.lit("false").alias("scheduledEmpty"),
        F.lit("0").alias("expectedItemQuantity"),
        F.lit("true").alias("authorizedSignerRequired"),
        F.col("properties").alias("property"),
        F.col("orderItem").alias("orderItem"))
    doc = F.struct(
        F.col("message_id").cast("string").alias("_transactionId"),
        ts.alias("_timestamp"),
        F.lit(system_name).alias("systemName"),
        F.col("pod_whse").alias("centerNumber"),
        F.col("route_id").alias("routeNumber"),
        F.struct(F.lit("false").alias("_mailConfirmationRequired"),
                 F.col("customer_code").alias("customerNumber"),
                 F.col("customer_name").alias("customerName"),
                 F.lit("true").alias("printReceipt")).alias("customer"),
        F.struct(F.col("ship_to_addr1").alias("addressLine1"),
                 _opt(h, "ship_to_addr2").alias("addressLine2"),
                 F.col("ship_to_city").alias("city"), F.col("ship_to_state").alias("state"),
                 F.col("ship_to_zip").alias("zipCode"), F.lit(COUNTRY).alias("country"))
         .alias("customerAddress"),
        F.struct(_opt(h, "ship_to_name").alias("firstName"),
                 _opt(h, "ship_to_name").alias("lastName"),
                 F.left(F.col("ship_to_addr1"), F.lit(30)).alias("location"),
                 F.lit("true").alias("active")).alias("contact"),
        F.struct(tsql_concat(F.col("stop_id").cast("string"), F.col("route_id")).alias("groupNumber"),
                 order.alias("order")).alias("orders"))
    return h.select("message_id", *ORDER, F.lit("addOrderAndCustomerRequest").alias("message_type"),
                    _fix_item_names(xml_text(doc, "addOrderAndCustomerRequest")).alias("message_xml"))


def po_messages(po: DataFrame, po_lines: DataFrame, pos: DataFrame, vendors: DataFrame,
                ids: DataFrame, pending: DataFrame, whse: DataFrame,
                system_name: str = "legacySystem",
                service_instructions: str = DEFAULT_SERVICE_INSTRUCTIONS,
                default_state: str = DEFAULT_VENDOR_STATE,
                default_contact: str = DEFAULT_VENDOR_CONTACT, as_of=None) -> DataFrame:
    """add (never sent) or update (sent before) message per (load, PO) with
    its pickup lines; vendor state defaults to ``default_state`` and the
    contact name to ``default_contact``."""
    keys = [*LOAD, "po_number"]
    pl = po_lines.withColumn("line_id", F.col("line_number"))
    items = _items_by(pl, keys)
    mid = ids.filter((F.col("phase") == PHASE_PO) & (F.col("sub") == 1)).select(
        *LOAD, F.col("msg_key").alias("po_number"), "message_id", "message_type")
    head = po.groupBy(*keys).agg(F.first("stop_id").alias("stop_id"),
                                 F.first("po_wh_id").alias("po_wh_id"),
                                 F.first("vendor_code").alias("vendor_code"))
    pm = pos.select("po_number", F.col("wh_id").alias("po_wh_id"),
                    *[F.col(c) for c in pos.columns if c not in ("po_number", "wh_id", "vendor_code",
                                                                 "route_id", "status")])
    # the queue row exists even when the vendor is unknown: its XML is NULL
    v = vendors.select("vendor_code", "vendor_name", F.lit(True).alias("_vendor"))
    route = pending.select(*LOAD, "route_id")
    wh = (whse.select("wh_id", "pod_whse"))
    h = (head.join(mid, keys).join(pm, ["po_number", "po_wh_id"], "left").join(v, "vendor_code", "left")
         .join(route, LOAD, "left").join(wh, "wh_id", "left").join(items, keys, "left"))
    ts = ts_text(as_of_lit(as_of))
    exp = ts_text(_opt(h, "expected_receipt_date", "timestamp_ntz"))
    order = F.struct(
        F.lit(ORDER_TYPE_NAME).alias("_typeName"),
        F.lit(ORDER_TYPE_DESCRIPTION).alias("_typeDescription"),
        F.lit("false").alias("_canceled"),
        F.col("po_number").alias("orderNumber"),
        dt_text(_opt(h, "create_date", "timestamp_ntz")).alias("orderDate"),
        F.when(F.coalesce(F.col("po_number"), F.lit("")) != "", F.col("po_number")).alias("poNumber"),
        F.array_compact(F.array(exp, exp)).alias("serviceWindowStart"),
        F.col("stop_id").cast("string").alias("expectedServiceSequence"),
        F.lit("0").alias("expectedPayment"), F.lit("false").alias("backOrder"),
        F.lit("false").alias("acceptAll"),
        F.lit(service_instructions).alias("serviceInstructions"),
        F.lit("false").alias("sendWireless"), F.lit("false").alias("scheduledEmpty"),
        F.lit("0").alias("expectedItemQuantity"), F.lit("true").alias("authorizedSignerRequired"),
        F.col("orderItem").alias("orderItem"))
    name = F.coalesce(F.col("vendor_name"), F.lit(default_contact))
    doc = F.struct(
        F.col("message_id").cast("string").alias("_transactionId"), ts.alias("_timestamp"),
        F.lit(system_name).alias("systemName"), F.col("pod_whse").alias("centerNumber"),
        F.col("route_id").alias("routeNumber"),
        F.struct(F.lit("false").alias("_mailConfirmationRequired"),
                 F.col("vendor_code").alias("customerNumber"),
                 F.col("vendor_name").alias("customerName"),
                 F.lit("true").alias("printReceipt")).alias("customer"),
        F.struct(_opt(h, "ship_from_addr1").alias("addressLine1"),
                 _opt(h, "ship_from_addr2").alias("addressLine2"),
                 _opt(h, "ship_from_city").alias("city"),
                 F.coalesce(_opt(h, "ship_from_state"), F.lit(default_state)).alias("state"),
                 _opt(h, "ship_from_postal_code").alias("zipCode"),
                 F.lit(COUNTRY).alias("country")).alias("customerAddress"),
        F.struct(name.alias("firstName"), name.alias("lastName"),
                 F.left(_opt(h, "ship_from_addr1"), F.lit(30)).alias("location"),
                 F.lit("true").alias("active")).alias("contact"),
        F.struct(tsql_concat(F.col("stop_id").cast("string"), F.col("route_id")).alias("groupNumber"),
                 order.alias("order")).alias("orders"))
    xml = F.when(F.col("message_type") == "updateOrderAndCustomerRequest",
                 xml_text(doc, "updateOrderAndCustomerRequest")) \
           .otherwise(xml_text(doc, "addOrderAndCustomerRequest"))
    xml = F.when(F.col("_vendor"), xml)
    return h.select("message_id", *LOAD, F.col("po_number").alias("order_number"), "message_type",
                    _fix_item_names(xml).alias("message_xml"))


def po_reopen_messages(po: DataFrame, ids: DataFrame, pending: DataFrame, whse: DataFrame,
                       system_name: str = "legacySystem", as_of=None) -> DataFrame:
    """reopenOrderRequest for POs sent before: a one-day window from now,
    queued just before the PO's update message."""
    keys = [*LOAD, "po_number"]
    mid = ids.filter((F.col("phase") == PHASE_PO) & (F.col("sub") == 0)).select(
        *LOAD, F.col("msg_key").alias("po_number"), "message_id")
    head = po.groupBy(*keys).agg(F.first("stop_id").alias("stop_id"))
    route = pending.select(*LOAD, "route_id")
    wh = (whse.select("wh_id", "pod_whse"))
    h = head.join(mid, keys).join(route, LOAD, "left").join(wh, "wh_id", "left")
    now = as_of_lit(as_of)
    doc = F.struct(
        F.col("message_id").cast("string").alias("_transactionId"),
        ts_text(now).alias("_timestamp"),
        F.lit(system_name).alias("systemName"),
        F.col("po_number").alias("orderNumber"),
        F.col("stop_id").cast("string").alias("expectedSequence"),
        ts_text(now).alias("expectedStart"),
        ts_text(now + F.expr("INTERVAL 1 DAY")).alias("expectedEnd"),
        F.col("pod_whse").alias("centerNumber"),
        F.col("route_id").alias("routeNumber"))
    return h.select("message_id", *LOAD, F.col("po_number").alias("order_number"),
                    F.lit("reopenOrderRequest").alias("message_type"),
                    xml_text(doc, "reopenOrderRequest").alias("message_xml"))


def pallet_messages(pallets: DataFrame, items: DataFrame, ids: DataFrame,
                    system_name: str = "legacySystem", as_of=None) -> DataFrame:
    """addPalletRequest per unit: barcode, purpose, and its items."""
    keys = [*LOAD, "hu_id"]
    it = (items.groupBy(*keys)
          .agg(F.array_sort(F.collect_list(F.struct(
              F.col("order_number").alias("orderNumber"),
              F.col("line_number").alias("lineNumber"),
              F.col("quantity").cast("string").alias("quantity")))).alias("palletItem")))
    mid = ids.filter(F.col("phase") == PHASE_PALLET).select(
        *LOAD, F.col("msg_key").alias("hu_id"), "message_id")
    h = pallets.join(mid, keys).join(it, keys, "left")
    doc = F.struct(
        F.col("message_id").cast("string").alias("_transactionId"),
        ts_text(as_of_lit(as_of)).alias("_timestamp"),
        F.lit(system_name).alias("systemName"),
        F.struct(F.col("hu_id").alias("palletNumber"), F.col("hu_desc").alias("description"),
                 F.col("purpose_number").alias("purposeNumber"),
                 F.struct(F.lit(BARCODE_TYPE).alias("_typeName"),
                          F.lit(BARCODE_TYPE).alias("_typeDescription"),
                          F.col("hu_id").alias("_VALUE")).alias("barcode"),
                 F.col("palletItem")).alias("pallet"))
    return h.select("message_id", *LOAD, "order_number",
                    F.lit("addPalletRequest").alias("message_type"),
                    xml_text(doc, "addPalletRequest").alias("message_xml"))


def message_queue_rows(*messages: DataFrame) -> DataFrame:
    """Rows appended to the outbound message queue (status 0), in id order."""
    u = messages[0]
    for m in messages[1:]:
        u = u.unionByName(m)
    return u.select(F.col("message_id").alias("unique_id"), "load_id", "order_number", "wh_id",
                    "message_type", "message_xml", F.lit(0).alias("queue_status"))
