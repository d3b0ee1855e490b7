"""Inbound delivery events: import queue -> report tables.

One ``from_xml`` with an explicit schema shreds every document of the batch;
the parsed frame is staged before filtering, so the parse is not repeated by
pushed-down filters. All "insert if not there yet" guards are first-wins
inside the batch (by import unique_id, K3) followed by an anti-join against
the target table, so replaying a batch adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.functions.columns import as_of_lit, nz
from dockyard.functions.keys import first_wins, first_wins_new, stage
from dockyard.operators.replies import XML_OPTS, result_node, root_name

TIMEOUT_CODE = "41001"
DELIVERABLE_TRIGGERS = ["OTA", "Finalize", "Web"]
MALFORMED = "malformed XML"

# Stop-workflow node names of the counts, in node order.
WORKFLOW_NODES = ["Actual Qty", "Actual Cig Count", "Actual Snuff Count", "Actual ECig Count",
                  "Actual LilCig Count"]
COUNT_COLS = ["tote_count", "cig_count", "snuff_count", "ecig_count", "lil_cig_count"]

# Every element that a path walks through is an array: a path means all nodes
# of that name, in document order, and a scalar is the first of them.
_T = "array<string>"
_REASON = f"array<struct<reasonCode: {_T}, reasonDescription: {_T}>>"
EVENT_SCHEMA = (
    f"trigger array<struct<_type: string, centerNumber: {_T}, "
    f"employee: array<struct<firstName: {_T}, lastName: {_T}, username: {_T}>>>>, "
    f"orderStatusSummary array<struct<routeNumber: {_T}, status: {_T}, timestamp: {_T}, "
    f"orderNumber: {_T}, customerInfo: array<struct<customerNumber: {_T}, customerName: {_T}, "
    f"customerAddress: array<struct<addressLine1: {_T}, city: {_T}, state: {_T}, zipCode: {_T}, "
    f"country: {_T}>>>>, serviceSummary: array<struct<serviceSummaryEntry: array<struct<purposeNumber: {_T}>>>>, "
    f"orderItemStatusGroup: array<struct<recipient: array<struct<signature: {_T}>>, "
    f"orderItemStatusSummary: array<struct<lineNumber: {_T}, description: {_T}, status: {_T}, "
    f"expectedQuantity: {_T}, acceptedQuantity: {_T}, scanned: {_T}, serviceLevel: {_T}, "
    f"purposeNumber: {_T}, createdOnClient: array<struct<reason: {_REASON}>>, "
    f"adjustment: array<struct<adjustQuantity: {_T}, reason: {_REASON}>>>>>>>>, "
    f"orderStatusDetail array<struct<visit: array<struct<service: array<struct<actualStart: {_T}, "
    "actualEnd: array<string>, stopWorkflowData: array<struct<_name: string, _VALUE: string>>, "
    f"receipt: array<struct<_lineNumber: string, palletNumber: {_T}>>>>>>>>, "
    "result struct<resultType: string, errorCode: string, message: string>, "
    "message string, _corrupt_record string")
ROOT = "orderStatusSummaryEvent"


def nodes(c: Column, path: str) -> Column:
    """All nodes of a slash path below the nodes ``c``, in document order."""
    for name in path.split("/"):
        c = F.flatten(F.filter(F.transform(c, _child(name)), lambda x: x.isNotNull()))
    return c


def _child(name: str):
    return lambda x: x[name]


def first_node(c: Column, path: str) -> Column:
    """The first node of a path (NULL when there is none)."""
    return F.try_element_at(nodes(c, path), F.lit(1))


def first_below(node: Column, path: str) -> Column:
    """:func:`first_node` below a single node, whose children are the list of the first step: nothing is flattened for it."""
    name, _, rest = path.partition("/")
    return first_node(node[name], rest) if rest else F.try_element_at(node[name], F.lit(1))


def _cut(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))


def pending_imports(queue: DataFrame) -> DataFrame:
    """Import rows waiting to be processed (status N)."""
    return queue.filter(F.col("status") == "N")


def parse_events(queue: DataFrame, col: str = "xml_response", stage_result: bool = True) -> DataFrame:
    """unique_id + ``ev`` (parsed struct) + ``root`` + ``malformed``; staged so
    later filters on parsed fields do not re-parse."""
    p = (queue.select("unique_id", F.col(col).alias("_xml"),
                      F.from_xml(F.col(col), EVENT_SCHEMA, XML_OPTS).alias("ev"), root_name(col).alias("root"))
         .withColumn("malformed", F.coalesce(F.col("ev._corrupt_record").isNotNull(), F.lit(False)))
         .withColumn("result", result_node("_xml", F.col("ev.result"), F.col("malformed"))).drop("_xml"))
    return stage(p) if stage_result else p


def event_result(events: DataFrame) -> DataFrame:
    """failure result -> code:message (NULL if a part is NULL); else a root
    error -> its message; else NULL. The raw error code is kept. Text that is
    not XML (the reference cannot store it) is reported as an error."""
    return events.select("unique_id", F.col("result.errorCode").alias("error_code"),
                         _error().alias("error_msg"), trigger_type().alias("trigger_type"))


def _error() -> Column:
    r = F.col("result")
    return (F.when(F.col("malformed"), F.lit(MALFORMED))
            .when(F.lower(r["resultType"]) == "failure", F.concat(r["errorCode"], F.lit(":"), r["message"]))
            .when(F.col("root") == "error", F.col("ev.message")))


def trigger_type() -> Column:
    """Type of the event's first trigger; NULL under a foreign root."""
    types = F.filter(F.transform(F.col("ev.trigger"), lambda t: t["_type"]), lambda t: t.isNotNull())
    return F.when(F.col("root") == ROOT, F.try_element_at(types, F.lit(1)))


def deliverable_events(events: DataFrame) -> DataFrame:
    """Events (root element orderStatusSummaryEvent) without error whose
    trigger is OTA, Finalize or Web."""
    return events.filter((F.coalesce(_error(), F.lit("")) == "") & trigger_type().isin(*DELIVERABLE_TRIGGERS))


def count_columns() -> list[Column]:
    """The five counts of an event and ``parse_error`` (see :func:`workflow_counts`)."""
    wf = nodes(F.col("ev.orderStatusDetail"), "visit/service/stopWorkflowData")
    cols, errs = [], []
    for i, (name, out) in enumerate(zip(WORKFLOW_NODES, COUNT_COLS)):
        a, b = F.try_element_at(wf, F.lit(i + 1)), F.try_element_at(wf, F.lit(i + 2))
        raw = F.when(a["_name"] == name, a["_VALUE"]).when(b["_name"] == name, b["_VALUE"])
        val = raw.try_cast("int")
        cols.append(val.alias(out))
        errs.append(raw.isNotNull() & val.isNull())
    bad = errs[0]
    for e in errs[1:]:
        bad = bad | e
    return [*cols, F.coalesce(bad, F.lit(False)).alias("parse_error")]


def workflow_counts(events: DataFrame) -> DataFrame:
    """The five counts, each read at one of two adjacent node positions and
    only when the node's name matches; positions count over all visits and
    services of the document (tote: 1|2, cig: 2|3, snuff: 3|4,
    ecig: 4|5, lil cig: 5|6). Non-numeric text gives NULL and sets
    ``parse_error`` (the reference fails the whole job, K18)."""
    return events.select("unique_id", *count_columns())


#: Header fields: name, the node list it is under, the element, the reference's declared length.
_HEADER = [
    ("pod_whse", "trigger", "centerNumber", 100), ("route", "summary", "routeNumber", 30), ("status", "summary", "status", 30),
    ("order_timestamp", "summary", "timestamp", 30), ("driver_first_name", "employee", "firstName", 200),
    ("driver_last_name", "employee", "lastName", 200), ("driver_username", "employee", "username", 200),
    ("order_number", "summary", "orderNumber", 30), ("customer_code", "customer", "customerNumber", 20),
    ("customer_name", "customer", "customerName", 50), ("customer_addr", "address", "addressLine1", 50), ("city", "address", "city", 30),
    ("state", "address", "state", 3), ("zip", "address", "zipCode", 12), ("country", "address", "country", 5),
    ("purpose_number", "summary", "serviceSummary/serviceSummaryEntry/purposeNumber", 50),
    ("actual_start_time", "service", "actualStart", 30), ("actual_end_time", "service", "actualEnd", 30)]


def header_lists() -> Column:
    """The node lists that several header fields are under, each flattened once."""
    t, o, d = F.col("ev.trigger"), F.col("ev.orderStatusSummary"), F.col("ev.orderStatusDetail")
    return F.struct(t.alias("trigger"), nodes(t, "employee").alias("employee"), o.alias("summary"),
                    nodes(o, "customerInfo").alias("customer"), nodes(o, "customerInfo/customerAddress").alias("address"),
                    nodes(d, "visit/service").alias("service"))


def header_columns(lists: Column | None = None) -> list[Column]:
    """Header fields of an event, cut to the reference's declared lengths. ``lists`` is a column of :func:`header_lists`."""
    at = header_lists() if lists is None else lists
    signature = F.unbase64(first_node(at["summary"], "orderItemStatusGroup/recipient/signature")).alias("signature")
    return [*[_cut(first_node(at[c], path), n).alias(out) for out, c, path, n in _HEADER], signature]


def event_header(events: DataFrame) -> DataFrame:
    """Header fields of each event (:func:`header_columns`)."""
    return events.select("unique_id", header_lists().alias("_lists")).select("unique_id", *header_columns(F.col("_lists")))


def resolve_warehouse(header: DataFrame, whse: DataFrame) -> DataFrame:
    """Delivery warehouse code -> wh_id."""
    w = whse.select(F.col("pod_whse"), "wh_id")
    return header.join(w, "pod_whse", "left")


def expected_counts(header: DataFrame, shipments: DataFrame) -> DataFrame:
    """Expected CIG / SNF / ECIG / LILCIG quantity of the event's order: the
    quantity of the exact type (CIGP / SNFP are not added, nothing is summed;
    with several rows the newest, by unique_id, wins)."""
    order = F.col("unique_id")
    types = {"CIG": "expected_cig_count", "SNF": "expected_snuff_count",
             "ECIG": "expected_ecig_count", "LILCIG": "expected_lil_cig_count"}
    keys = header.select("wh_id", "order_number").distinct()
    s = shipments.filter(F.col("product_type").isin(*types)).join(keys, ["wh_id", "order_number"], "left_semi")
    agg = s.groupBy("wh_id", "order_number").agg(*[
        F.max_by(F.when(F.col("product_type") == t, F.col("uom_qty")),
                 F.when(F.col("product_type") == t, order)).alias(c) for t, c in types.items()])
    return header.select("unique_id", "wh_id", "order_number").join(
        agg, ["wh_id", "order_number"], "left")


def tote_tracking(header: DataFrame, counts: DataFrame, customers: DataFrame,
                  customer_totes: DataFrame, orders: DataFrame, existing: DataFrame,
                  as_of=None) -> DataFrame:
    """Tote rows to append: the event has a tote count, the customer needs
    totes, the purpose is neither Product Pickup nor Backhaul, no order of that
    number in the warehouse has its tote flag unset, and no row exists yet for
    (order, warehouse); first event wins inside the batch. tote_expected is
    the latest logged expectation for (warehouse, customer), else 0."""
    h = header.join(counts.select("unique_id", "tote_count"), "unique_id") \
              .filter(F.col("tote_count").isNotNull())
    cu = customers.filter(nz("totes_required") == 1).select("customer_code").distinct()
    p = F.coalesce(F.col("purpose_number"), F.lit(""))
    h = (h.join(cu, "customer_code", "left_semi")
         .filter((p != "Product Pickup") & (p != "Backhaul")))
    latest = (customer_totes.join(h.select("wh_id", "customer_code").distinct(), ["wh_id", "customer_code"], "left_semi")
              .groupBy("wh_id", "customer_code")
              .agg(F.max_by("tote_expected", "unique_id").alias("_exp")))
    unflagged = orders.filter(nz("tote_count_flag") == 0).select("order_number", "wh_id")
    h = (h.join(latest, ["wh_id", "customer_code"], "left")
         .join(unflagged, ["order_number", "wh_id"], "left_anti"))
    rows = h.select("wh_id", "driver_first_name", "driver_last_name", "driver_username",
                    "order_number", "customer_code", "customer_name", "route", "tote_count",
                    nz("_exp").alias("tote_expected"), "order_timestamp",
                    as_of_lit(as_of).alias("create_date"), F.col("unique_id").alias("import_id"))
    return first_wins_new(rows, ["order_number", "wh_id"], "import_id",
                          existing.select("order_number", "wh_id"))


def receipt_status() -> Column:
    """fulfilled -> COMPLETE, anything else (NULL as well) -> INCOMPLETE."""
    return F.when(F.col("status") == "fulfilled", F.lit("COMPLETE")).otherwise(F.lit("INCOMPLETE"))


def with_signatures(rows: DataFrame, control: DataFrame) -> DataFrame:
    """``rows`` when the control row POD_SIGN_FLAG says 1, else none (also when
    the row is missing). The flag is one value, a scalar subquery."""
    flag = control.filter(F.col("control_type") == "POD_SIGN_FLAG").agg(
        F.coalesce(F.max(F.col("c1").try_cast("int")), F.lit(0)).alias("_flag"))
    return rows.filter(flag.scalar() == 1)


def backhaul_receipts(header: DataFrame, pos: DataFrame, existing: DataFrame,
                      as_of=None) -> DataFrame:
    """Backhaul rows to append for Backhaul events: fulfilled -> COMPLETE,
    else INCOMPLETE; once per (warehouse, PO, day) including rows already
    written today; first event wins inside the batch."""
    h = header.filter(F.col("purpose_number") == "Backhaul")
    po = pos.select(F.col("po_number").alias("order_number"), F.col("wh_id").alias("original_wh_id"))
    po = po.groupBy("order_number").agg(F.max("original_wh_id").alias("original_wh_id"))
    today = F.to_date(as_of_lit(as_of))
    rows = (h.join(po, "order_number", "left")
            .select("wh_id", "original_wh_id", "driver_first_name", "driver_last_name",
                    "driver_username", F.col("order_number").alias("po_number"),
                    F.col("customer_code").alias("vendor_code"),
                    F.col("customer_name").alias("vendor_name"),
                    receipt_status().alias("status"),
                    "route", "order_timestamp", as_of_lit(as_of).alias("create_date"),
                    F.col("unique_id").alias("import_id")))
    done_today = (existing.filter(F.to_date("create_date") == today)
                  .select("wh_id", "po_number"))
    return first_wins_new(rows, ["wh_id", "po_number"], "import_id", done_today)


def backhaul_pos_received(header: DataFrame) -> DataFrame:
    """POs named by a Backhaul event (whether or not a receipt row was added)."""
    return (header.filter((F.col("purpose_number") == "Backhaul") & F.col("order_number").isNotNull())
            .select(F.col("order_number").alias("po_number")).distinct())


def backhaul_po_update(pos: DataFrame, header: DataFrame) -> DataFrame:
    """New PO version: received_by_service = 1 for POs named by a Backhaul event."""
    got = backhaul_pos_received(header).withColumn("_g", F.lit(1))
    cols = pos.columns
    prev = F.col("received_by_service") if "received_by_service" in cols else F.lit(None).cast("int")
    out = pos.join(got, "po_number", "left").withColumn(
        "received_by_service", F.when(F.col("_g") == 1, F.lit(1)).otherwise(prev))
    return out.select(*cols, *([] if "received_by_service" in cols else ["received_by_service"]))


def delivery_header(header: DataFrame, counts: DataFrame, expected: DataFrame,
                    existing: DataFrame, control: DataFrame, as_of=None) -> DataFrame:
    """Report header rows to append (only when the signature control is 1):
    one per (order, warehouse), first event wins, none already in the table.
    Counts and expected counts default to 0. A Backhaul event carries the
    status of its receipt, COMPLETE or INCOMPLETE (K19)."""
    header = with_signatures(header, control)
    j = header.join(counts, "unique_id", "left").join(
        expected.drop("wh_id", "order_number"), "unique_id", "left")
    rows = j.select(
        "wh_id", as_of_lit(as_of).alias("create_date"), "route", "order_timestamp",
        F.when(F.col("purpose_number") == "Backhaul", receipt_status()).otherwise(F.col("status"))
         .alias("order_status"), "driver_first_name", "driver_last_name",
        "order_number", "customer_code", "customer_name", "customer_addr", "city", "state",
        "zip", "country", F.col("signature").alias("customer_signature"),
        F.lit(0).alias("processed"), F.lit("").alias("processed_timestamp"),
        F.col("unique_id").alias("import_id"), "actual_start_time", "actual_end_time",
        *[nz(c).alias(c) for c in ("cig_count", "snuff_count", "ecig_count", "lil_cig_count",
                                   "expected_cig_count", "expected_snuff_count",
                                   "expected_ecig_count", "expected_lil_cig_count")])
    return first_wins_new(rows, ["order_number", "wh_id"], "import_id",
                          existing.select("order_number", "wh_id"))


def event_items(events: DataFrame) -> DataFrame:
    """Items of each event, over all its item groups, matched to its receipts,
    over all visits and services, by line number (an inner match). Both lists
    are in the event's row, so nothing is shuffled."""
    items = nodes(F.col("ev.orderStatusSummary"), "orderItemStatusGroup/orderItemStatusSummary")
    receipts = nodes(F.col("ev.orderStatusDetail"), "visit/service/receipt")
    j = (events.select("unique_id", F.explode(items).alias("it"), receipts.alias("_rs"))
         .withColumn("_ln", F.try_element_at("it.lineNumber", F.lit(1)))
         .select("unique_id", "it", F.explode(F.filter("_rs", lambda r: r["_lineNumber"] == F.col("_ln"))).alias("rc")))

    return j.select("unique_id", *item_columns(F.col("it"), F.col("rc")))


def item_columns(it: Column, rc: Column) -> list[Column]:
    """Report fields of an item and its receipt."""
    def one(path: str) -> Column:
        return first_below(it, path)

    scanned = F.lower(F.trim(one("scanned")))
    return [
        _cut(first_below(rc, "palletNumber"), 50).alias("container_id"),
        _cut(one("lineNumber"), 20).alias("line_number"),
        _cut(rc["_lineNumber"], 20).alias("pod_line_number"),
        _cut(one("description"), 200).alias("item_description"),
        _cut(one("status"), 50).alias("item_status"),
        one("expectedQuantity").try_cast("int").alias("expected_qty"),
        one("acceptedQuantity").try_cast("int").alias("accepted_qty"),
        F.when(scanned.isin("true", "1"), F.lit(1)).when(scanned.isin("false", "0"), F.lit(0))
         .alias("scan_status"),
        _cut(one("serviceLevel"), 50).alias("service_level"),
        one("adjustment/adjustQuantity").try_cast("int").alias("adjusted_qty"),
        _cut(one("adjustment/reason/reasonCode"), 50).alias("reason_code"),
        _cut(one("adjustment/reason/reasonDescription"), 250).alias("reason_description")]


def items_column() -> Column:
    """An event's rows of :func:`event_items` as one list, for plans that keep one row per event."""
    items = nodes(F.col("ev.orderStatusSummary"), "orderItemStatusGroup/orderItemStatusSummary")
    receipts = nodes(F.col("ev.orderStatusDetail"), "visit/service/receipt")

    def of_item(it: Column) -> Column:
        own = F.filter(receipts, lambda r: r["_lineNumber"] == F.try_element_at(it["lineNumber"], F.lit(1)))
        return F.transform(own, lambda r: F.struct(*item_columns(it, r)))

    return F.flatten(F.transform(items, of_item))


def normalise_items(items: DataFrame) -> DataFrame:
    """Pallet -> Container; a trailing -GS1 is stripped from the container."""
    return (items.withColumn("service_level", F.when(F.col("service_level") == "Pallet",
                                                     F.lit("Container"))
                             .otherwise(F.col("service_level")))
            .withColumn("container_id", F.regexp_replace("container_id", "-GS1$", "")))


def delivery_detail(items: DataFrame, header: DataFrame, existing: DataFrame) -> DataFrame:
    """Detail rows to append: all rows of the first event (by unique_id) per
    (order, warehouse) that yields rows, unless the table already has rows for
    that (order, warehouse). Events with a NULL order or warehouse are all
    kept (a NULL key never matches)."""
    h = header.select("unique_id", "wh_id", "order_number", "customer_code")
    rows = items.join(h, "unique_id")
    msgs = rows.select("unique_id", "wh_id", "order_number").distinct()
    first = first_wins(msgs, ["order_number", "wh_id"], "unique_id").select("unique_id")
    keep = rows.join(first, "unique_id", "left_semi")
    ex = existing.select("order_number", "wh_id").distinct()
    keep = keep.join(ex, ["order_number", "wh_id"], "left_anti")
    return keep.select("wh_id", "order_number", "customer_code", "container_id", "line_number",
                       "item_description", F.col("item_status").alias("delivery_status"),
                       "expected_qty", "accepted_qty", "scan_status", "service_level",
                       "adjusted_qty", "reason_code", "reason_description",
                       F.lit(0).alias("processed"), F.col("unique_id").alias("import_id"))


def import_status(queue: DataFrame, results: DataFrame, as_of=None) -> DataFrame:
    """New import-queue version: rows whose error code is 41001 (no events,
    a timeout) are removed; processed rows become C, or E with the message."""
    r = results.select("unique_id", "error_code", F.col("error_msg").alias("_err"),
                       F.lit(True).alias("_hit"))
    j = queue.join(r, "unique_id", "left")
    j = j.filter(~F.coalesce(F.col("error_code") == TIMEOUT_CODE, F.lit(False)))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    cols = queue.columns
    prev_msg = F.col("error_msg") if "error_msg" in cols else F.lit(None).cast("string")
    prev_dt = F.col("dt_processed") if "dt_processed" in cols else F.lit(None).cast("timestamp_ntz")
    out = (j.withColumn("status", F.when(hit, F.when(F.coalesce(F.col("_err"), F.lit("")) == "",
                                                     F.lit("C")).otherwise(F.lit("E")))
                        .otherwise(F.col("status")))
           .withColumn("error_msg", F.when(hit, F.col("_err")).otherwise(prev_msg))
           .withColumn("dt_processed", F.when(hit, as_of_lit(as_of)).otherwise(prev_dt)))
    extra = [c for c in ("error_msg", "dt_processed") if c not in cols]
    return out.select(*cols, *extra)
