"""Registered queries for inbound events + their oracles.

Spark builds each event document with ``to_xml`` and shreds it with
``from_xml``; the oracle computes the same answer from the fixture columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dockyard.functions.columns import AS_OF
from dockyard.operators.inbound import trigger_type
from dockyard.plans.inbound import InboundInputs, InboundRun
from dockyard.plans.registry import query

TS = f"CAST(TIMESTAMP '{AS_OF}' AS TIMESTAMP)"
FMT = "'%Y-%m-%dT%H:%M:%S'"

BASE = f"""
WITH iq AS (
  SELECT i.* FROM f_import i JOIN f_import_queue q ON q.unique_id = i.unique_id
  WHERE q.status = 'N'),
ie AS (
  SELECT iq.unique_id, iq.kind, iq.trigger_type, iq.purpose, iq.tote_count, iq.cig_count,
    iq.event_ts, iq.order_number AS src_order, o.wh_id AS o_wh, o.route_id, o.customer_id,
    o.ship_to_addr1, o.ship_to_city, o.ship_to_state, o.ship_to_zip, c.customer_name, w.pod_whse
  FROM iq LEFT JOIN f_order o ON o.order_number = iq.order_number
  LEFT JOIN f_customer c ON c.customer_id = o.customer_id
  LEFT JOIN f_whse w ON w.wh_id = o.wh_id),
res AS (
  SELECT unique_id,
    CASE kind WHEN 'failure' THEN 'E' || CAST(unique_id % 97 AS VARCHAR)
              WHEN 'nested' THEN 'N' || CAST(unique_id % 97 AS VARCHAR)
              WHEN 'timeout' THEN '41001' END AS error_code,
    CASE kind WHEN 'failure' THEN 'E' || CAST(unique_id % 97 AS VARCHAR) || ':rejected '
                                  || CAST(unique_id AS VARCHAR)
              WHEN 'nested' THEN 'N' || CAST(unique_id % 97 AS VARCHAR) || ':deep '
                                  || CAST(unique_id AS VARCHAR)
              WHEN 'timeout' THEN '41001:no events'
              WHEN 'error' THEN 'protocol error ' || CAST(unique_id AS VARCHAR)
              WHEN 'malformed' THEN 'malformed XML' END AS error_msg,
    CASE WHEN kind = 'ok' THEN trigger_type END AS trigger_type
  FROM ie),
dlv AS (
  SELECT ie.* FROM ie JOIN res r ON r.unique_id = ie.unique_id
  WHERE coalesce(r.error_msg, '') = '' AND r.trigger_type IN ('OTA', 'Finalize', 'Web')),
cnt AS (
  SELECT unique_id, tote_count, cig_count,
    CASE WHEN unique_id % 31 = 0 THEN NULL ELSE CAST(unique_id % 4 AS INT) END AS snuff_count,
    CAST(unique_id % 3 AS INT) AS ecig_count, CAST(unique_id % 2 AS INT) AS lil_cig_count,
    unique_id % 31 = 0 AS parse_error
  FROM dlv),
hdr0 AS (
  SELECT unique_id, pod_whse, route_id AS route,
    CASE WHEN unique_id % 3 = 0 THEN 'fulfilled' ELSE 'partial' END AS status,
    strftime(event_ts, {FMT}) AS order_timestamp,
    'F' || CAST(unique_id % 13 AS VARCHAR) AS driver_first_name,
    'L' || CAST(unique_id % 17 AS VARCHAR) AS driver_last_name,
    'drv' || CAST(unique_id % 11 AS VARCHAR) AS driver_username,
    CASE WHEN purpose = 'Backhaul' THEN 'PO' || src_order ELSE src_order END AS order_number,
    'C' || CAST(customer_id AS VARCHAR) AS customer_code, left(customer_name, 50) AS customer_name,
    left(ship_to_addr1, 50) AS customer_addr, left(ship_to_city, 30) AS city,
    left(ship_to_state, 3) AS state, left(ship_to_zip, 12) AS zip, 'USA' AS country,
    encode('sig-' || CAST(unique_id AS VARCHAR)) AS signature, purpose AS purpose_number,
    strftime(event_ts - INTERVAL 15 MINUTE, {FMT}) AS actual_start_time,
    strftime(event_ts, {FMT}) AS actual_end_time
  FROM dlv),
hdr AS (SELECT h.*, w.wh_id FROM hdr0 h LEFT JOIN f_whse w ON w.pod_whse = h.pod_whse),
cps AS (SELECT * FROM f_pod_shipments),
expc AS (
  SELECT h.unique_id, h.wh_id, h.order_number,
    (SELECT max_by(uom_qty, unique_id) FROM cps WHERE cps.wh_id = h.wh_id AND cps.order_number = h.order_number
       AND product_type = 'CIG') AS expected_cig_count,
    (SELECT max_by(uom_qty, unique_id) FROM cps WHERE cps.wh_id = h.wh_id AND cps.order_number = h.order_number
       AND product_type = 'SNF') AS expected_snuff_count,
    (SELECT max_by(uom_qty, unique_id) FROM cps WHERE cps.wh_id = h.wh_id AND cps.order_number = h.order_number
       AND product_type = 'ECIG') AS expected_ecig_count,
    (SELECT max_by(uom_qty, unique_id) FROM cps WHERE cps.wh_id = h.wh_id AND cps.order_number = h.order_number
       AND product_type = 'LILCIG') AS expected_lil_cig_count
  FROM hdr h),
items AS (
  SELECT d.unique_id,
    left(k.container_id || CASE WHEN d.unique_id % 4 = 0 THEN '-GS1' ELSE '' END, 50) AS container_id,
    left(k.line_number, 20) AS line_number, left(k.line_number, 20) AS pod_line_number,
    'item ' || k.item_number AS item_description,
    CASE WHEN k.picked_quantity = k.planned_quantity THEN 'delivered' ELSE 'short' END AS item_status,
    k.planned_quantity AS expected_qty, k.picked_quantity AS accepted_qty,
    CASE WHEN d.unique_id % 2 = 0 THEN 1 ELSE 0 END AS scan_status,
    CASE k.container_type WHEN 'PALLET' THEN 'Pallet' WHEN 'TOTE' THEN 'Tote' ELSE 'Case' END
      AS service_level,
    CASE WHEN k.picked_quantity <> k.planned_quantity THEN k.picked_quantity - k.planned_quantity END
      AS adjusted_qty,
    CASE WHEN k.picked_quantity <> k.planned_quantity THEN 'SHORT' END AS reason_code,
    CASE WHEN k.picked_quantity <> k.planned_quantity THEN 'short shipped' END AS reason_description
  FROM dlv d JOIN f_pick k ON k.order_number = d.src_order)
"""


def _run(fx) -> InboundRun:
    return InboundRun(InboundInputs.from_fixtures(fx))


@query("pending_imports", """
SELECT q.unique_id, q.status FROM f_import_queue q WHERE q.status = 'N'
""")
def q_pending_imports(fx):
    return _run(fx).pending.select("unique_id", "status")


@query("event_result", BASE + "SELECT * FROM res")
def q_event_result(fx):
    return _run(fx).results


@query("deliverable_events", BASE + "SELECT unique_id, trigger_type FROM dlv")
def q_deliverable_events(fx):
    return _run(fx).deliverable.select("unique_id", trigger_type().alias("trigger_type"))


@query("workflow_counts", BASE + "SELECT * FROM cnt")
def q_workflow_counts(fx):
    return _run(fx).counts


_HDR_COLS = ("unique_id, pod_whse, route, status, order_timestamp, driver_first_name, "
             "driver_last_name, driver_username, order_number, customer_code, customer_name, "
             "customer_addr, city, state, zip, country, hex(signature) AS signature_hex, "
             "purpose_number, actual_start_time, actual_end_time")


@query("event_header", BASE + f"SELECT {_HDR_COLS} FROM hdr0")
def q_event_header(fx):
    h = _run(fx).header
    return h.select(*[c for c in h.columns if c not in ("wh_id", "signature")],
                    F.hex("signature").alias("signature_hex"))


@query("resolve_warehouse", BASE + "SELECT unique_id, pod_whse, wh_id FROM hdr")
def q_resolve_warehouse(fx):
    return _run(fx).header.select("unique_id", "pod_whse", "wh_id")


@query("expected_counts", BASE + "SELECT * FROM expc")
def q_expected_counts(fx):
    return _run(fx).expected


_FIRST = """
SELECT {cols} FROM (
  SELECT r.*, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn FROM r) x
WHERE (_rn = 1 OR {nullkey})
  AND NOT EXISTS (SELECT 1 FROM {target} t WHERE {match})
"""


@query("tote_tracking", BASE + f""",
te AS (
  SELECT wh_id, customer_code, tote_expected FROM (
    SELECT t.*, row_number() OVER (PARTITION BY wh_id, customer_code ORDER BY unique_id DESC) AS rn
    FROM f_customer_totes t) x WHERE rn = 1),
r AS (
  SELECT h.wh_id, h.driver_first_name, h.driver_last_name, h.driver_username, h.order_number,
    h.customer_code, h.customer_name, h.route, c.tote_count,
    coalesce(te.tote_expected, 0) AS tote_expected, h.order_timestamp, {TS} AS create_date,
    h.unique_id AS import_id
  FROM hdr h JOIN cnt c ON c.unique_id = h.unique_id
  LEFT JOIN te ON te.wh_id = h.wh_id AND te.customer_code = h.customer_code
  WHERE c.tote_count IS NOT NULL
    AND EXISTS (SELECT 1 FROM f_customer cu WHERE cu.customer_code = h.customer_code
                AND coalesce(cu.totes_required, 0) = 1)
    AND coalesce(h.purpose_number, '') <> 'Product Pickup'
    AND coalesce(h.purpose_number, '') <> 'Backhaul'
    AND NOT EXISTS (SELECT 1 FROM f_order o1 WHERE o1.order_number = h.order_number
                    AND o1.wh_id = h.wh_id AND coalesce(o1.tote_count_flag, 0) = 0))
""" + _FIRST.format(cols="* EXCLUDE (_rn)", keys="order_number, wh_id", order="import_id",
                    nullkey="order_number IS NULL OR wh_id IS NULL", target="f_tote_tracking",
                    match="t.order_number = x.order_number AND t.wh_id = x.wh_id"))
def q_tote_tracking(fx):
    return _run(fx).totes


@query("backhaul_receipts", BASE + f""",
r AS (
  SELECT h.wh_id, (SELECT max(p.wh_id) FROM f_po p WHERE p.po_number = h.order_number) AS original_wh_id,
    h.driver_first_name, h.driver_last_name, h.driver_username, h.order_number AS po_number,
    h.customer_code AS vendor_code, h.customer_name AS vendor_name,
    CASE WHEN h.status = 'fulfilled' THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status,
    h.route, h.order_timestamp, {TS} AS create_date, h.unique_id AS import_id
  FROM hdr h WHERE h.purpose_number = 'Backhaul')
""" + _FIRST.format(cols="* EXCLUDE (_rn)", keys="wh_id, po_number", order="import_id",
                    nullkey="wh_id IS NULL OR po_number IS NULL", target="f_backhaul_log",
                    match=f"t.wh_id = x.wh_id AND t.po_number = x.po_number "
                          f"AND CAST(t.create_date AS DATE) = CAST({TS} AS DATE)"))
def q_backhaul_receipts(fx):
    return _run(fx).backhauls


@query("backhaul_po_update", BASE + """
SELECT p.po_number, p.order_key, p.wh_id, p.carrier_scac, p.route_id, p.shipment_date,
  p.vendor_code, p.status, p.sent_flag,
  CASE WHEN EXISTS (SELECT 1 FROM hdr WHERE hdr.purpose_number = 'Backhaul'
                    AND hdr.order_number = p.po_number) THEN 1 END AS received_by_service
FROM f_po p
""")
def q_backhaul_po_update(fx):
    return _run(fx).po_update


_CNT = ("cig_count", "snuff_count", "ecig_count", "lil_cig_count")
_EXP = ("expected_cig_count", "expected_snuff_count", "expected_ecig_count",
        "expected_lil_cig_count")


@query("delivery_header", BASE + f""",
r AS (
  SELECT h.wh_id, {TS} AS create_date, h.route, h.order_timestamp,
    CASE WHEN h.purpose_number = 'Backhaul' THEN CASE WHEN h.status = 'fulfilled' THEN 'COMPLETE' ELSE 'INCOMPLETE' END
         ELSE h.status END AS order_status,
    h.driver_first_name, h.driver_last_name, h.order_number, h.customer_code, h.customer_name,
    h.customer_addr, h.city, h.state, h.zip, h.country, h.signature AS customer_signature,
    0 AS processed, '' AS processed_timestamp, h.unique_id AS import_id, h.actual_start_time,
    h.actual_end_time,
    {", ".join(f"coalesce(c.{x}, 0) AS {x}" for x in _CNT)},
    {", ".join(f"coalesce(e.{x}, 0) AS {x}" for x in _EXP)}
  FROM hdr h LEFT JOIN cnt c ON c.unique_id = h.unique_id
  LEFT JOIN expc e ON e.unique_id = h.unique_id)
""" + _FIRST.format(cols="* EXCLUDE (_rn, customer_signature), hex(customer_signature) AS signature_hex",
                    keys="order_number, wh_id", order="import_id",
                    nullkey="order_number IS NULL OR wh_id IS NULL", target="f_pod_header",
                    match="t.order_number = x.order_number AND t.wh_id = x.wh_id"))
def q_delivery_header(fx):
    h = _run(fx).pod_header
    return h.select(*[c for c in h.columns if c != "customer_signature"],
                    F.hex("customer_signature").alias("signature_hex"))


@query("event_items", BASE + "SELECT * FROM items")
def q_event_items(fx):
    return _run(fx).raw_items


_NORM = """
SELECT unique_id, regexp_replace(container_id, '-GS1$', '') AS container_id, line_number,
  pod_line_number, item_description, item_status, expected_qty, accepted_qty, scan_status,
  CASE WHEN service_level = 'Pallet' THEN 'Container' ELSE service_level END AS service_level,
  adjusted_qty, reason_code, reason_description
FROM items
"""


@query("normalise_items", BASE + _NORM)
def q_normalise_items(fx):
    return _run(fx).items


@query("delivery_detail", BASE + f""",
nitems AS ({_NORM}),
rows AS (
  SELECT h.wh_id, h.order_number, h.customer_code, n.* EXCLUDE (unique_id), n.unique_id
  FROM nitems n JOIN hdr h ON h.unique_id = n.unique_id),
firstmsg AS (
  SELECT unique_id FROM (
    SELECT unique_id, order_number, wh_id,
      row_number() OVER (PARTITION BY order_number, wh_id ORDER BY unique_id) AS rn
    FROM (SELECT DISTINCT unique_id, order_number, wh_id FROM rows) m) x
  WHERE rn = 1 OR order_number IS NULL OR wh_id IS NULL)
SELECT wh_id, order_number, customer_code, container_id, line_number, item_description,
  item_status AS delivery_status, expected_qty, accepted_qty, scan_status, service_level,
  adjusted_qty, reason_code, reason_description, 0 AS processed, unique_id AS import_id
FROM rows r
WHERE r.unique_id IN (SELECT unique_id FROM firstmsg)
  AND NOT EXISTS (SELECT 1 FROM f_pod_detail t WHERE t.order_number = r.order_number
                  AND t.wh_id = r.wh_id)
""")
def q_delivery_detail(fx):
    return _run(fx).detail


@query("import_status", BASE + f"""
SELECT q.unique_id,
  CASE WHEN r.unique_id IS NULL THEN q.status
       WHEN coalesce(r.error_msg, '') = '' THEN 'C' ELSE 'E' END AS status,
  r.error_msg,
  CASE WHEN r.unique_id IS NOT NULL THEN {TS} END AS dt_processed
FROM f_import_queue q LEFT JOIN res r ON r.unique_id = q.unique_id
WHERE coalesce(r.error_code, '') <> '41001'
""")
def q_import_status(fx):
    return _run(fx).queue_after
