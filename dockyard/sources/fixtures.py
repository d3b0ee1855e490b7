"""Fixture views: the driver's star schema given the shape of warehouse tables.

Each view is one SQL text that runs unchanged in Spark SQL and DuckDB. Table
references are written as ``{name}`` placeholders:

* Spark: ``spark.sql(text, **frames)`` binds each placeholder to a DataFrame,
  so nothing is registered in the caller's session catalog.
* Oracle: the placeholder becomes the plain view name and the views are
  inlined as CTEs (see :func:`oracle_with`).

These are *inputs*. In production they are real warehouse tables; the item
master per warehouse (``f_item``) is one row per (item, warehouse), which the
fixture derives by pairing parts with the (two) warehouse ids.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from dockyard.session import checkpoint_dir, shuffles_dropped
from dockyard.sources import lean

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# The fixture definitions (column formulas must equal the
# oracle's, so they are stated once, here, and shared by both engines).
VIEWS: dict[str, str] = {
    "f_order": """
SELECT CAST(o_orderkey AS STRING) AS order_number, o_orderkey AS order_key,
  'W' || CAST(o_orderkey % 2 AS STRING) AS wh_id,
  'L' || CAST(o_orderkey % 2 AS STRING) || '-' ||
    CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING) ||
    CASE WHEN day(o_orderdate) = 28 THEN 'ADD' ELSE '' END AS load_id,
  'R' || CAST(day(o_orderdate) % 5 AS STRING) AS route_id,
  o_custkey AS customer_id, CAST(o_custkey % 9 AS INT) + 1 AS stop_id,
  CASE WHEN day(o_orderdate) % 7 = 0 THEN 'HWC' WHEN day(o_orderdate) % 11 = 0 THEN 'HTRF'
       WHEN day(o_orderdate) = 1 THEN NULL ELSE 'HRT' END AS carrier,
  CASE WHEN o_orderkey % 25 = 0 THEN 'TRANSFER' WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'STD' END AS order_type,
  o_orderstatus AS status, o_orderdate AS order_date, o_orderdate AS earliest_ship_date,
  'A' || CAST(o_custkey % 400 AS STRING) AS ship_to_addr1, 'T' || CAST(o_custkey % 7 AS STRING) AS ship_to_city,
  'S' || CAST(o_custkey % 5 AS STRING) AS ship_to_state, CAST(10000 + o_custkey % 400 AS STRING) AS ship_to_zip,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 1 END AS tote_count_flag
FROM {orders}
""",
    "f_customer": """
SELECT c_custkey AS customer_id, 'C' || CAST(c_custkey AS STRING) AS customer_code, c_name AS customer_name,
  'A' || CAST(c_custkey % 400 AS STRING) AS customer_addr1, 'T' || CAST(c_custkey % 7 AS STRING) AS customer_city,
  'S' || CAST(c_custkey % 5 AS STRING) AS customer_state, CAST(10000 + c_custkey % 400 AS STRING) AS customer_zip,
  CAST(c_custkey % 2 AS INT) AS totes_required,
  CASE WHEN c_custkey % 3 = 0 THEN 'G' || CAST(c_custkey AS STRING) WHEN c_custkey % 3 = 1 THEN '' END AS gln,
  CASE WHEN c_custkey % 6 = 0 THEN 1 WHEN c_custkey % 6 = 3 THEN 0 END AS gs1_required_flag,
  c_mktsegment AS chain_name
FROM {customer}
""",
    "f_whse": """
SELECT DISTINCT 'W' || CAST(n_nationkey % 2 AS STRING) AS wh_id,
  CAST(900 + n_nationkey % 2 AS STRING) AS pod_whse FROM {nation}
""",
    "f_item": """
SELECT w.wh_id, 'P' || CAST(p_partkey AS STRING) AS item_number, p_name AS description,
  CASE p_type WHEN 'PROMO' THEN 'CIG' WHEN 'ECONOMY' THEN 'DRY' WHEN 'MEDIUM' THEN 'FRZ'
              WHEN 'SMALL' THEN 'CLR' WHEN 'LARGE' THEN 'PRO' END AS class_id,
  CASE p_partkey % 12 WHEN 0 THEN 'CIG' WHEN 1 THEN 'CIGP' WHEN 2 THEN 'LILCIG' WHEN 3 THEN 'SNF'
              WHEN 4 THEN 'SNFP' WHEN 5 THEN 'ECIG' ELSE 'GEN' END AS product_type,
  CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS gs1_required_flag,
  CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS net_weight_barcode
FROM {part} CROSS JOIN {f_whse} w
""",
    "f_item_uom": """
SELECT w.wh_id, 'P' || CAST(p_partkey AS STRING) AS item_number, u.uom,
  CASE u.uom WHEN 'EA' THEN 1 ELSE 2 + p_size % 6 END AS conversion_factor
FROM {part} CROSS JOIN {f_whse} w CROSS JOIN (SELECT 'EA' AS uom UNION ALL SELECT 'CS') u
""",
    "f_item_upc": """
SELECT i.wh_id, i.item_number, 'CS' AS uom, lpad(substring(i.item_number, 2), 13, '0') AS upc,
  TIMESTAMP '2024-01-01 00:00:00' AS modified_datetime FROM {f_item} i
  WHERE CAST(substring(i.item_number, 2) AS BIGINT) % 3 <> 0
UNION ALL
SELECT i.wh_id, i.item_number, 'CS' AS uom, lpad(substring(i.item_number, 2), 12, '7') AS upc,
  TIMESTAMP '2024-06-01 00:00:00' AS modified_datetime FROM {f_item} i
  WHERE CAST(substring(i.item_number, 2) AS BIGINT) % 5 = 1
UNION ALL
SELECT i.wh_id, i.item_number, 'EA' AS uom, lpad(substring(i.item_number, 2), 8, '5') AS upc,
  TIMESTAMP '2024-03-01 00:00:00' AS modified_datetime FROM {f_item} i
""",
    "f_pick": """
SELECT o.wh_id, o.load_id, o.order_number, 'P' || CAST(l.l_partkey AS STRING) AS item_number,
  CAST(l.l_linenumber AS STRING) || '.' || CAST(l.l_partkey AS STRING) AS line_number,
  o.order_number || '/' || CAST(l.l_linenumber AS STRING) || '.' || CAST(l.l_partkey AS STRING) AS pick_id,
  o.order_number || '-H' || CAST(l.l_linenumber % 3 AS STRING) AS container_id,
  CASE l.l_linenumber % 3 WHEN 0 THEN 'PALLET' WHEN 1 THEN 'TOTE' ELSE 'OTP' END AS container_type,
  CASE WHEN l.l_linenumber % 2 = 0 THEN 'CS' ELSE 'EA' END AS uom,
  CASE WHEN l.l_linenumber % 3 = 1 THEN 'TOTE' || o.order_number END AS cartonization_batch_id,
  CASE l.l_linenumber % 4 WHEN 0 THEN 'DRY' WHEN 1 THEN 'CIG' WHEN 2 THEN 'FRZ' ELSE 'X' END AS pick_area,
  l.qty AS planned_quantity,
  CASE WHEN l.l_linenumber = 7 THEN 0 ELSE l.qty END AS picked_quantity,
  CASE WHEN o.order_key % 97 = 0 THEN 'SHIPPED' WHEN l.l_linenumber = 7 THEN 'SHORTED' WHEN l.l_linenumber = 6 THEN 'PICKED' ELSE 'LOADED' END AS status
FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(SUM(l_quantity) AS INT) AS qty
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber, l_partkey) l
JOIN {f_order} o ON o.order_key = l.l_orderkey
""",
    "f_hu_shipped": """
SELECT DISTINCT container_id AS hu_id, wh_id, load_id, 'LO' AS type, order_number AS control_number,
  order_number AS parent_hu_id FROM {f_pick} WHERE picked_quantity > 0
""",
    "f_stored_shipped": """
SELECT container_id AS hu_id, wh_id, item_number, pick_id AS type, picked_quantity AS actual_qty
FROM {f_pick} WHERE picked_quantity > 0
""",
    "f_load": """
SELECT wh_id, load_id, MIN(route_id) AS route_id, MIN(earliest_ship_date) AS earliest_ship_date,
  MIN(order_date) AS created_date, MIN(order_key) AS load_master_id,
  CASE WHEN day(MIN(order_date)) % 2 = 0 THEN 'SHIPPED' ELSE 'OPEN' END AS status,
  CASE WHEN day(MIN(order_date)) % 14 = 0 THEN 'DOOR7' END AS door_loc,
  CASE day(MIN(order_date)) % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS invoiced_flag
FROM {f_order} GROUP BY wh_id, load_id
""",
    "f_hu": """
SELECT DISTINCT k.container_id AS hu_id, k.wh_id, k.order_number AS control_number,
  CASE WHEN k.container_type = 'OTP' AND o.order_key % 9 = 0 AND n.load_id IS NOT NULL THEN n.load_id ELSE k.load_id END AS load_id,
  CASE WHEN o.order_key % 8 = 7 THEN 'SO' ELSE 'LO' END AS type
FROM {f_pick} k JOIN {f_order} o ON o.order_number = k.order_number
LEFT JOIN {f_order} n ON n.order_key = o.order_key + 2
""",
    "f_wh_control": """
SELECT wh_id, 'WILL_CALL_POD' AS control_type, CASE WHEN wh_id = 'W0' THEN 'WC' END AS c1, 1 AS next_value FROM {f_whse}
UNION ALL
SELECT wh_id, 'WC_DEFAULT_DOOR' AS control_type, CASE WHEN wh_id = 'W1' THEN 'DOOR9' END AS c1, 0 AS next_value FROM {f_whse}
""",
    "f_load_queue": """
SELECT load_master_id AS unique_id, wh_id, load_id,
  CASE day(earliest_ship_date) % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS queue_status,
  CASE day(earliest_ship_date) % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS preship_scan_gs1
FROM {f_load} WHERE load_master_id % 5 <> 0
""",
    "f_container": """
SELECT w.wh_id, c.container_type, c.shipping_container FROM {f_whse} w CROSS JOIN
  (SELECT 'TOTE' AS container_type, 1 AS shipping_container UNION ALL SELECT 'OTP', 1 UNION ALL SELECT 'PALLET', 0) c
""",
    "f_vendor": """
SELECT 'V' || CAST(s_suppkey AS STRING) AS vendor_code, s_name AS vendor_name FROM {supplier}
""",
    "f_po": """
SELECT 'PO' || order_number AS po_number, order_key, 'W' || CAST(1 - order_key % 2 AS STRING) AS wh_id,
  wh_id AS carrier_scac, route_id, earliest_ship_date AS shipment_date,
  'V' || CAST(CAST(floor(order_key / 5) AS BIGINT) % 12 AS STRING) AS vendor_code,
  CASE WHEN order_key % 20 = 0 THEN 'C' ELSE 'O' END AS status,
  CASE WHEN order_key % 15 = 0 THEN 1 ELSE 0 END AS sent_flag
FROM {f_order} WHERE order_key % 5 = 0
""",
    "f_po_line": """
SELECT p.po_number, p.wh_id, k.line_number, k.item_number, k.uom AS order_uom, k.planned_quantity AS qty
FROM {f_po} p JOIN {f_pick} k ON 'PO' || k.order_number = p.po_number
""",
    "f_receipt": """
SELECT po_number, carrier_scac AS wh_id FROM {f_po} WHERE order_key % 70 = 0
""",
    "f_backhaul": """
SELECT po_number, wh_id, CASE WHEN order_key % 3 = 0 THEN 'COMPLETE' WHEN order_key % 3 = 1 THEN 'SENT' END AS status
FROM {f_po} WHERE order_key % 4 = 0 OR order_key % 25 = 0
UNION ALL
SELECT po_number, wh_id, 'SENT' AS status FROM {f_po} WHERE order_key % 24 = 0
""",
    "f_import": """
SELECT event_id AS unique_id, CAST((event_id * 7) % ((SELECT max(o_orderkey) FROM {orders}) + 1) AS STRING) AS order_number,
  CASE event_id % 5 WHEN 0 THEN 'OTA' WHEN 1 THEN 'Finalize' WHEN 2 THEN 'Web' WHEN 3 THEN 'Other' END AS trigger_type,
  CASE WHEN event_id % 17 = 0 THEN 'failure' WHEN event_id % 23 = 0 THEN 'timeout' WHEN event_id % 19 = 0 THEN 'error'
       WHEN event_id % 29 = 0 THEN 'malformed' WHEN event_id % 37 = 0 THEN 'nested' WHEN event_id % 41 = 0 THEN 'foreign'
       ELSE 'ok' END AS kind,
  CASE WHEN event_id % 11 = 0 THEN 'Backhaul' WHEN event_id % 13 = 0 THEN 'Product Pickup' END AS purpose,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id % 9 AS INT) END AS tote_count,
  CAST(event_id % 6 AS INT) AS cig_count, ts AS event_ts
FROM {events}
""",
    "f_message": """
SELECT event_id AS unique_id, CAST(event_id % ((SELECT max(o_orderkey) FROM {orders}) + 1) AS STRING) AS order_number,
  CASE event_id % 4 WHEN 0 THEN 'addPalletRequest' WHEN 1 THEN 'addOrderAndCustomerRequest'
       WHEN 2 THEN 'updateOrderAndCustomerRequest' ELSE 'reopenOrderRequest' END AS message_type,
  CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 1 END AS queue_status,
  CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 5 ELSE CAST(event_id % 3 AS INT) END AS retries,
  CASE WHEN event_id % 6 = 0 THEN 'E7:already there' WHEN event_id % 6 = 1 THEN '' END AS error_msg,
  CASE WHEN event_id % 17 = 0 THEN 'Failure' WHEN event_id % 19 = 0 THEN 'error' WHEN event_id % 13 = 0 THEN 'nested'
       ELSE 'ok' END AS reply_kind
FROM {events}
""",
    "f_rma": """
SELECT 'RMA' || order_number AS rma_number, wh_id, 'C' || CAST(customer_id AS STRING) AS customer_code, order_date,
  CAST(order_key % 2 AS INT) AS sent_flag, 'OPEN' AS status FROM {f_order} WHERE order_key % 40 < 2
""",
    "f_rma_line": """
SELECT r.rma_number, r.wh_id, k.line_number, k.item_number, k.uom, k.planned_quantity AS qty,
  CASE WHEN k.planned_quantity % 4 = 0 THEN k.planned_quantity WHEN k.planned_quantity % 4 = 1 THEN 1 END AS qty_received,
  CASE WHEN k.planned_quantity % 10 = 3 THEN 1 END AS received_flag
FROM {f_rma} r JOIN {f_pick} k ON 'RMA' || k.order_number = r.rma_number
""",
}

# Fixture views added by this repo (inputs the reference reads but the
# fixture list does not define). Same rules: one text, both engines.
# f_container_history and f_pod_shipments are what earlier runs wrote: the
# container counts of every load (dated by its ship date) and the counted
# products of every load.
VIEWS.update({
    "f_shipment": """
SELECT load_master_id, wh_id, CAST(load_master_id * 10 AS STRING) AS shipment_number
FROM {f_load} WHERE load_master_id % 3 = 0
""",
    "f_confirm_request": """
SELECT wh_id, load_id, 'user' || CAST(load_master_id % 7 AS STRING) AS username,
  CASE WHEN load_master_id % 5 = 1 THEN repeat('S', 600) ELSE 'SEAL' || CAST(load_master_id AS STRING) END AS seal,
  'TR' || CAST(load_master_id % 13 AS STRING) AS trailer
FROM {f_load} WHERE status = 'OPEN'
""",
    "f_employee": """
SELECT DISTINCT 'user' || CAST(n_nationkey % 5 AS STRING) AS username,
  'W' || CAST(n_nationkey % 2 AS STRING) AS wh_id,
  'E' || CAST(n_nationkey % 5 AS STRING) || CAST(n_nationkey % 2 AS STRING) AS employee_id
FROM {nation}
""",
    "f_pick_master": """
SELECT DISTINCT wh_id, load_id, container_id AS pick_master_id, container_type, 'RELEASED' AS status
FROM {f_pick}
""",
    "f_import_queue": """
SELECT unique_id, CASE WHEN unique_id % 10 = 9 THEN 'C' ELSE 'N' END AS status FROM {f_import}
""",
    "f_order_detail": """
SELECT wh_id, order_number, line_number, item_number, uom AS order_uom, planned_quantity AS qty
FROM {f_pick}
""",
    "f_control": """
SELECT DISTINCT 'POD_SIGN_FLAG' AS control_type, '1' AS c1 FROM {region}
""",
    "f_customer_totes": """
SELECT order_key AS unique_id, wh_id, 'C' || CAST(customer_id AS STRING) AS customer_code,
  CAST(order_key % 5 AS INT) AS tote_expected
FROM {f_order} WHERE order_key % 3 = 0
""",
    "f_tote_tracking": """
SELECT order_number, wh_id FROM {f_order} WHERE order_key % 50 = 0
""",
    "f_backhaul_log": """
SELECT po_number, carrier_scac AS wh_id,
  CASE WHEN order_key % 8 = 0 THEN TIMESTAMP '2001-09-01 06:00:00'
       ELSE TIMESTAMP '2001-08-15 06:00:00' END AS create_date
FROM {f_po} WHERE order_key % 4 = 0
""",
    "f_pod_header": """
SELECT order_number, wh_id FROM {f_order} WHERE order_key % 45 = 0
""",
    "f_pod_detail": """
SELECT order_number, wh_id FROM {f_order} WHERE order_key % 55 = 0
""",
    "f_reason": """
SELECT DISTINCT CASE WHEN n_nationkey % 2 = 0 THEN 'SHORT' ELSE 'DAMAGED' END AS reason_id,
  'RETURNS' AS type FROM {nation}
""",
    "f_rma_route": """
SELECT wh_id, CASE WHEN wh_id = 'W0' THEN 'ALL' ELSE 'R1' END AS route FROM {f_whse}
UNION ALL
SELECT wh_id, 'R3' AS route FROM {f_whse} WHERE wh_id = 'W1'
""",
    "f_container_history": """
WITH hs_all AS (
  SELECT hum.hu_id, hum.wh_id, k.order_number, hum.load_id, hum.parent_hu_id,
    '-' AS pallet_desc,
    CASE WHEN k.cartonization_batch_id IS NULL THEN i.description
         ELSE coalesce(k.pick_area, '') || '-' || coalesce(k.cartonization_batch_id, '') END AS hu_desc,
    s.item_number, i.description AS item_description, k.line_number,
    CAST(floor(round(CAST(sum(s.actual_qty) AS DOUBLE) / u.conversion_factor, 6)) AS INT) AS quantity,
    k.cartonization_batch_id, i.class_id, k.pick_area, k.uom AS order_uom, c.gln,
    CASE WHEN coalesce(i.gs1_required_flag, 0) = 1 AND coalesce(c.gs1_required_flag, 0) = 1
         THEN 1 ELSE 0 END AS gs1_required_flag,
    c.customer_code, o.stop_id, c.totes_required, c.customer_id,
    coalesce(o.tote_count_flag, 0) AS tote_count_flag,
    o.ship_to_addr1, o.ship_to_city, o.ship_to_state, o.ship_to_zip, k.container_type, o.carrier
  FROM {f_hu_shipped} hum
  JOIN {f_stored_shipped} s ON s.hu_id = hum.hu_id AND s.wh_id = hum.wh_id
  JOIN {f_pick} k ON s.type = k.pick_id
  JOIN {f_item} i ON i.item_number = s.item_number AND i.wh_id = s.wh_id
  JOIN {f_item_uom} u ON u.item_number = k.item_number AND u.uom = k.uom AND u.wh_id = k.wh_id
  JOIN {f_order} o ON o.order_number = k.order_number AND o.wh_id = k.wh_id
  JOIN {f_customer} c ON c.customer_id = o.customer_id
  WHERE EXISTS (SELECT 1 FROM {f_load} p WHERE p.wh_id = hum.wh_id AND p.load_id = hum.load_id)
  GROUP BY hum.hu_id, hum.wh_id, k.order_number, hum.load_id, hum.parent_hu_id, s.item_number,
    i.description, k.line_number, k.cartonization_batch_id, k.pick_area, k.uom,
    u.conversion_factor, i.class_id, c.gln, i.gs1_required_flag, c.gs1_required_flag,
    c.customer_code, c.customer_id, o.stop_id, c.totes_required, o.tote_count_flag,
    o.ship_to_addr1, o.ship_to_city, o.ship_to_state, o.ship_to_zip, k.container_type, o.carrier)

  SELECT h.wh_id, h.customer_code, h.load_id, h.order_number, h.container_type,
    CAST(count(DISTINCT h.hu_id) AS INT) AS shipped_qty, l.earliest_ship_date AS shipment_date,
    h.ship_to_addr1, h.ship_to_city, h.ship_to_state, h.ship_to_zip, h.stop_id, h.carrier
  FROM hs_all h JOIN {f_load} l ON l.wh_id = h.wh_id AND l.load_id = h.load_id
  JOIN {f_container} n ON n.wh_id = h.wh_id AND n.container_type = h.container_type
  WHERE coalesce(h.totes_required, 0) = 1 AND coalesce(n.shipping_container, 0) = 1
    AND h.quantity > 0
  GROUP BY h.wh_id, h.customer_code, h.load_id, h.order_number, h.container_type,
    h.ship_to_addr1, h.ship_to_city, h.ship_to_state, h.ship_to_zip, h.stop_id, h.carrier, l.earliest_ship_date
""",
    "f_pod_shipments": """
SELECT k.wh_id, c.customer_code, k.load_id, k.order_number, o.earliest_ship_date AS shipment_date,
  o.stop_id,
  CAST(floor(round(sum(CAST(k.planned_quantity AS DOUBLE) / u.conversion_factor), 6)) AS INT) AS uom_qty,
  i.product_type, CAST(TIMESTAMP '2001-09-01 00:00:00' AS TIMESTAMP) AS create_date,
  max(o.order_key) AS unique_id
FROM {f_pick} k
JOIN {f_item} i ON i.wh_id = k.wh_id AND i.item_number = k.item_number
JOIN {f_item_uom} u ON u.wh_id = k.wh_id AND u.item_number = k.item_number AND u.uom = k.uom
JOIN {f_order} o ON o.wh_id = k.wh_id AND o.order_number = k.order_number
JOIN {f_customer} c ON c.customer_id = o.customer_id
WHERE rtrim(i.product_type) IN ('LILCIG', 'ECIG', 'CIG', 'CIGP', 'SNF', 'SNFP')
  AND k.picked_quantity > 0 AND coalesce(o.order_type, '') <> 'TRANSFER'
GROUP BY k.wh_id, k.load_id, k.order_number, i.product_type, o.stop_id, c.customer_code,
  o.earliest_ship_date
""",
})

_REF = re.compile(r"\{(\w+)\}")


def deps(name: str) -> list[str]:
    """Direct table/view references of one fixture view, in text order."""
    return list(dict.fromkeys(_REF.findall(VIEWS[name])))


def closure(names) -> list[str]:
    """All fixture views needed by ``names``, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out or n not in VIEWS:
            return
        for d in deps(n):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def oracle_with(names) -> str:
    """``WITH`` clause defining the fixture views ``names`` (and their deps)
    over the raw DuckDB views."""
    parts = []
    for n in closure(names):
        body = _REF.sub(lambda m: m.group(1), VIEWS[n]).strip()
        parts.append(f"{n} AS (\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


@dataclass
class Fixtures:
    """Lazily built DataFrames for raw tables and fixture views of one sf dir.

    Every frame is built once per instance, so one job shares its scans.
    """

    spark: SparkSession
    sf_dir: str
    # optional folder of materialised views (``{name}.parquet``), read instead
    # of deriving them; see :func:`materialise`
    tables_dir: str | None = None
    _frames: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "sf_dir", "tables_dir"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            stored = name in VIEWS or name in DERIVED
            if self.tables_dir and stored and _exists(self.spark, f"{self.tables_dir}/{name}.parquet"):
                df = self.spark.read.parquet(f"{self.tables_dir}/{name}.parquet")
            elif name in DERIVED:
                df = DERIVED[name](self)
            elif name in RAW_TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in LEAN:
                df = LEAN[name](self)
            elif name in VIEWS:
                refs = {d: self[d] for d in deps(name)}
                df = self.spark.sql(VIEWS[name], **refs)
                if name in STORED:
                    df = _stored(df)
            else:
                raise KeyError(name)
            self._frames[name] = df
        return self._frames[name]


#: Views that other views and jobs read many times: an aggregate of the line or
#: order table each, computed and written once per instance.
STORED = ("f_pick", "f_load")


#: Views that Spark makes by a plan of its own, with the rows of their text.
LEAN = {
    "f_hu_shipped": lambda fx: lean.hu_shipped(fx.f_pick),
    "f_container_history": lambda fx: lean.container_history(
        fx.f_hu_shipped, fx.f_stored_shipped, fx.f_pick, fx.f_item, fx.f_item_uom, fx.f_order, fx.f_customer, fx.f_load,
        fx.f_container),
}


def _stored(df: DataFrame) -> DataFrame:
    """``df`` as a table under the checkpoint folder. It lasts as long as the
    instance, so no :func:`~dockyard.functions.keys.staging` block deletes it."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/view-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _import_queue(fx: "Fixtures") -> DataFrame:
    from dockyard.sources.documents import event_documents
    return event_documents(fx.f_import, fx.f_order, fx.f_customer, fx.f_whse, fx.f_pick, fx.f_import_queue)


def _replies(fx: "Fixtures") -> DataFrame:
    from dockyard.sources.documents import reply_documents
    return reply_documents(fx.f_message)


def _outbound_queue(fx: "Fixtures") -> DataFrame:
    from dockyard.sources.documents import outbound_queue
    return outbound_queue(fx.f_message)


# Inputs that hold XML documents: assembled by Spark (``to_xml``) from the
# fixture columns; like the views they can be materialised once.
DERIVED = {
    "d_import_queue": _import_queue,
    "d_replies": _replies,
    "d_outbound_queue": _outbound_queue,
}


def materialise(spark: SparkSession, sf_dir: str, out_dir: str, names=None) -> None:
    """Write fixture views and derived inputs as parquet tables (the
    warehouse tables they stand for), so jobs read them instead of re-deriving
    them from the star schema."""
    fx = Fixtures(spark, sf_dir)
    for n in names or [*VIEWS, *DERIVED]:
        fx[n].write.mode("overwrite").parquet(f"{out_dir}/{n}.parquet")
