"""XML documents of the fixture: inbound event documents, service replies and
outbound pallet messages, assembled with ``to_xml`` from fixture columns.

The oracle computes the expected answers from the same columns, so an
assembly or parsing error shows up as a value mismatch. Namespaced documents
get their ``i:`` prefixes after serialisation (``to_xml`` writes plain
names only); the readers parse with ``ignoreNamespace``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NAMESPACE = "urn:example:delivery-integration"


def _prefixed(xml: Column, root: str) -> Column:
    """Prefix every element with ``i:`` and declare the namespace on the root.
    Every "<" of the text starts a tag: in values it is a character reference."""
    x = F.replace(F.replace(xml, F.lit("<"), F.lit("<i:")), F.lit("<i:/"), F.lit("</i:"))
    head = f"<i:{root}"
    return F.concat(F.lit(f'{head} xmlns:i="{NAMESPACE}"'), F.substr(x, F.lit(len(head) + 1)))


def _flat(xml: Column) -> Column:
    """Without white space that starts with a line break between tags. Without indentation that is one line break,
    which needs no regular expression; only a value that is such white space does. The text is bound once."""
    plain = F.replace(xml, F.lit(">\n<"), F.lit("><"))
    rest = lambda x: F.when(F.contains(x, F.lit(">\n")), F.regexp_replace(x, r">\n\s*<", "><")).otherwise(x)
    return F.transform(F.array(plain), rest)[0]


def _xml(doc: Column, root: str) -> Column:
    return _flat(F.rtrim(F.to_xml(doc, {"rowTag": root, "indent": ""}), F.lit("\n")))


def _result_doc(result_type: Column, code: Column, message: Column, root: str) -> Column:
    doc = F.struct(F.struct(result_type.alias("resultType"), code.alias("errorCode"),
                            message.alias("message")).alias("result"))
    return _prefixed(_xml(doc, root), root)


def _error_doc(message: Column) -> Column:
    return _xml(F.struct(message.alias("message")), "error")


def ts_plain(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")


def event_documents(f_import: DataFrame, f_order: DataFrame, f_customer: DataFrame,
                    f_whse: DataFrame, f_pick: DataFrame, f_import_queue: DataFrame | None = None) -> DataFrame:
    """(unique_id, xml_response) per fixture import row; the shape depends on
    ``kind`` (FIXTURES.md §2): event / failure result / timeout (41001) /
    root error / text that is not XML / a failure result deep in the document /
    an event under another root. With ``f_import_queue`` the rows of the queue
    and their documents: the queue is joined before any document is made.

    Picks are collected once per order and meet the event's row as a list; an
    event's items are made from the list in its row. Import, order and pick
    rows meet on the order number."""
    uid = F.col("unique_id")
    o = f_order.select("order_number", "wh_id", "route_id", "customer_id", "ship_to_addr1",
                       "ship_to_city", "ship_to_state", "ship_to_zip")
    c = f_customer.select("customer_id", "customer_name")
    w = f_whse.select("wh_id", "pod_whse")
    per_order = (f_pick.groupBy("order_number")
                 .agg(F.collect_list(F.struct("line_number", "item_number", "container_id", "container_type",
                                              "planned_quantity", "picked_quantity")).alias("_picks")))
    # import and order rows may repeat: an event has the items of all its rows
    ev = f_import.withColumn("_rows", F.count("*").over(Window.partitionBy("unique_id")))
    extra = []
    if f_import_queue is not None:
        extra = [x for x in f_import_queue.columns if x != "unique_id"]
        ev = ev.join(f_import_queue, "unique_id")
    o = (o.join(c, "customer_id", "left").join(w, "wh_id", "left")
         .withColumn("_orders", F.count("*").over(Window.partitionBy("order_number"))))
    # making and parsing documents is work of the processor: partitions aren't merged by their few bytes
    n = int(f_import.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ev = ev.repartition(n, "order_number").join(o, "order_number", "left").join(per_order, "order_number", "left")
    copies = F.col("_rows") * F.coalesce(F.col("_orders"), F.lit(1))
    picks = F.when(copies == 1, F.col("_picks")).otherwise(
        F.flatten(F.array_repeat(F.col("_picks"), copies.cast("int"))))

    def item(p: Column) -> Column:
        short = p["picked_quantity"] != p["planned_quantity"]
        return F.struct(
            p["line_number"].alias("lineNumber"),
            F.concat(F.lit("item "), p["item_number"]).alias("description"),
            F.when(p["picked_quantity"] == p["planned_quantity"], F.lit("delivered"))
             .otherwise(F.lit("short")).alias("status"),
            p["planned_quantity"].cast("string").alias("expectedQuantity"),
            p["picked_quantity"].cast("string").alias("acceptedQuantity"),
            F.when(uid % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("scanned"),
            F.when(p["container_type"] == "PALLET", F.lit("Pallet"))
             .when(p["container_type"] == "TOTE", F.lit("Tote")).otherwise(F.lit("Case"))
             .alias("serviceLevel"),
            F.when(short, F.lit("Delivery")).alias("purposeNumber"),
            F.when(short, F.struct((p["picked_quantity"] - p["planned_quantity"]).cast("string")
                                   .alias("adjustQuantity"),
                                   F.struct(F.lit("SHORT").alias("reasonCode"),
                                            F.lit("short shipped").alias("reasonDescription")).alias("reason")))
             .alias("adjustment"))

    def receipt(p: Column) -> Column:
        return F.struct(
            p["line_number"].alias("_lineNumber"),
            F.concat(p["container_id"],
                     F.when(uid % 4 == 0, F.lit("-GS1")).otherwise(F.lit(""))).alias("palletNumber"))

    def by_line(made) -> Column:
        keyed = F.transform(F.col("_picks"), lambda p: F.struct(p["line_number"].alias("_k"), made(p).alias("_v")))
        return F.transform(F.array_sort(keyed), lambda e: e["_v"])

    ev = ev.withColumn("_picks", F.when(uid.isNotNull(), picks))
    ev = ev.withColumns({"items": by_line(item), "receipts": by_line(receipt)}).drop("_picks")

    def wf(name, value):
        return F.struct(F.lit(name).alias("_name"), value.alias("_VALUE"))

    tote = F.when(F.col("tote_count").isNotNull(),
                  wf("Actual Qty", F.col("tote_count").cast("string"))) \
            .otherwise(wf("Qty Skipped", F.lit("")))
    snuff = F.when(uid % 31 == 0, F.lit("n/a")).otherwise((uid % 4).cast("string"))
    base = [tote, wf("Actual Cig Count", F.col("cig_count").cast("string")),
            wf("Actual Snuff Count", snuff), wf("Actual ECig Count", (uid % 3).cast("string")),
            wf("Actual LilCig Count", (uid % 2).cast("string"))]
    # odd events carry one extra node first: every count sits one position later
    flow = F.when(uid % 2 == 1, F.array(wf("Stop Notes", F.lit("ok")), *base)) \
            .otherwise(F.array(*base))
    ts = F.col("event_ts")

    # of four events one has a single group, visit and service, one two groups
    # and two visits, one two groups and two services in a visit, one all single
    many = uid % 4 >= 2

    def several(a: Column, b: Column) -> Column:
        return F.when(many, F.array(a, b)).otherwise(F.array(a))

    def part(name: str, first: bool) -> Column:
        c = F.col(name)
        half = F.when(many, F.ceil(F.size(c) / 2)).otherwise(F.size(c)).cast("int")
        return F.slice(c, F.lit(1), half) if first else F.slice(c, half + 1, F.size(c))

    def group(prefix: str, items: Column) -> Column:
        signature = F.base64(F.encode(F.concat(F.lit(prefix), uid.cast("string")), "UTF-8"))
        return F.struct(F.struct(signature.alias("signature")).alias("recipient"), items.alias("orderItemStatusSummary"))

    def service(first: bool) -> Column:
        late = F.expr("INTERVAL 15 MINUTES") if first else F.expr("INTERVAL 5 MINUTES")
        split = F.when(many, F.lit(2)).otherwise(F.size(flow)).cast("int")
        steps = F.slice(flow, F.lit(1), split) if first else F.slice(flow, split + 1, F.size(flow))
        end = ts if first else ts + F.expr("INTERVAL 1 HOUR")
        return F.struct(ts_plain(ts - late).alias("actualStart"), ts_plain(end).alias("actualEnd"),
                        steps.alias("stopWorkflowData"), part("receipts", first).alias("receipt"))

    is_bh = F.col("purpose") == "Backhaul"
    event = F.struct(
        F.struct(F.col("trigger_type").alias("_type"), F.col("pod_whse").alias("centerNumber"),
                 F.struct(F.concat(F.lit("F"), (uid % 13).cast("string")).alias("firstName"),
                          F.concat(F.lit("L"), (uid % 17).cast("string")).alias("lastName"),
                          F.concat(F.lit("drv"), (uid % 11).cast("string")).alias("username"))
                 .alias("employee")).alias("trigger"),
        F.struct(
            F.col("route_id").alias("routeNumber"),
            F.when(uid % 3 == 0, F.lit("fulfilled")).otherwise(F.lit("partial")).alias("status"),
            ts_plain(ts).alias("timestamp"),
            F.when(F.coalesce(is_bh, F.lit(False)), F.concat(F.lit("PO"), F.col("order_number")))
             .otherwise(F.col("order_number")).alias("orderNumber"),
            F.struct(F.concat(F.lit("C"), F.col("customer_id").cast("string")).alias("customerNumber"),
                     F.col("customer_name").alias("customerName"),
                     F.struct(F.col("ship_to_addr1").alias("addressLine1"),
                              F.col("ship_to_city").alias("city"),
                              F.col("ship_to_state").alias("state"),
                              F.col("ship_to_zip").alias("zipCode"),
                              F.lit("USA").alias("country")).alias("customerAddress"))
             .alias("customerInfo"),
            F.struct(several(F.struct(F.col("purpose").alias("purposeNumber")),
                             F.struct(F.when(F.col("purpose").isNotNull(), F.lit("Second")).alias("purposeNumber")))
                     .alias("serviceSummaryEntry")).alias("serviceSummary"),
            several(group("sig-", part("items", True)), group("second-", part("items", False)))
             .alias("orderItemStatusGroup"))
         .alias("orderStatusSummary"),
        F.struct(F.when(uid % 4 == 2, F.array(F.struct(F.array(service(first=True), service(first=False)).alias("service"))))
                  .otherwise(several(F.struct(F.array(service(first=True)).alias("service")),
                                     F.struct(F.array(service(first=False)).alias("service"))))
                  .alias("visit")).alias("orderStatusDetail"))
    root = "orderStatusSummaryEvent"
    event_xml = _prefixed(_xml(event, root), root)
    foreign_xml = _prefixed(_xml(event, "otherEvent"), "otherEvent")
    nested = F.struct(F.struct(F.struct(F.struct(
        F.lit("FAILURE").alias("resultType"), F.concat(F.lit("N"), (uid % 97).cast("string")).alias("errorCode"),
        F.concat(F.lit("deep "), uid.cast("string")).alias("message")).alias("result")).alias("detail")).alias("body"))
    nested_xml = _prefixed(_xml(nested, "eventResponse"), "eventResponse")
    kind = F.col("kind")
    doc = (F.when(kind == "ok", event_xml)
           .when(kind == "failure", _result_doc(F.lit("Failure"),
                                                F.concat(F.lit("E"), (uid % 97).cast("string")),
                                                F.concat(F.lit("rejected "), uid.cast("string")),
                                                "eventResponse"))
           .when(kind == "timeout", _result_doc(F.lit("failure"), F.lit("41001"), F.lit("no events"),
                                                "eventResponse"))
           .when(kind == "error", _error_doc(F.concat(F.lit("protocol error "), uid.cast("string"))))
           .when(kind == "nested", nested_xml).when(kind == "foreign", foreign_xml)
           .otherwise(F.concat(F.lit('<orderStatusSummaryEvent><trigger type="OTA">'),
                               uid.cast("string"))))
    return ev.select("unique_id", *extra, doc.alias("xml_response"))


def reply_documents(f_message: DataFrame) -> DataFrame:
    """(unique_id, response_xml, ms_elapsed, attempts) for messages that were
    sent (queue status 1): a failure result, a protocol error, or success."""
    uid = F.col("unique_id")
    sent = f_message.filter(F.col("queue_status") == 1)
    k = F.col("reply_kind")
    doc = (F.when(k == "Failure", _result_doc(F.lit("Failure"),
                                              F.concat(F.lit("E"), (uid % 50).cast("string")),
                                              F.concat(F.lit("bad request "), uid.cast("string")),
                                              "response"))
           .when(k == "error", _error_doc(F.concat(F.lit("unreachable "), uid.cast("string"))))
           .when(k == "nested", _prefixed(_xml(F.struct(F.struct(F.struct(
               F.lit("failure").alias("resultType"), F.lit("D1").alias("errorCode"),
               F.concat(F.lit("deep "), uid.cast("string")).alias("message")).alias("result")).alias("body")),
               "response"), "response"))
           .otherwise(_result_doc(F.lit("Success"), F.lit(None).cast("string"),
                                  F.lit(None).cast("string"), "response")))
    return sent.select("unique_id", doc.alias("response_xml"),
                       ((uid * 37) % 900 + 40).cast("int").alias("ms_elapsed"),
                       (F.coalesce(F.col("retries"), F.lit(0)) + 1).cast("int").alias("attempts"))


def outbound_queue(f_message: DataFrame) -> DataFrame:
    """The outbound message queue with a message document per row (pallet
    requests get an addPalletRequest document)."""
    uid = F.col("unique_id")
    pallet = F.struct(uid.cast("string").alias("_transactionId"),
                      F.struct(F.concat(F.lit("H"), uid.cast("string")).alias("palletNumber"))
                      .alias("pallet"))
    other = F.struct(uid.cast("string").alias("_transactionId"),
                     F.col("order_number").alias("orderNumber"))
    xml = F.when(F.col("message_type") == "addPalletRequest",
                 _xml(pallet, "addPalletRequest")) \
           .otherwise(_xml(other, "message"))
    return f_message.select("unique_id", "order_number", "message_type", "queue_status",
                            "retries", "error_msg", xml.alias("message_xml"),
                            F.lit(None).cast("string").alias("response_xml"),
                            F.lit(None).cast("timestamp_ntz").alias("dt_processed"))
