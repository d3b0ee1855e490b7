"""Registered queries for outbound messages + their oracles."""

from __future__ import annotations

import uuid

from dockyard.functions.columns import AS_OF
from dockyard.functions.keys import stage
from dockyard.operators import outbound as O
from dockyard.plans.outbound import OutboundInputs, OutboundRun
from dockyard.plans.q_confirm import COUNTED_SQL
from dockyard.plans.registry import query
from dockyard.sources.bucketed import bucketed_inputs

TS = f"CAST(TIMESTAMP '{AS_OF}' AS TIMESTAMP)"
ADDR = "ship_to_addr1, ship_to_city, ship_to_state, ship_to_zip"


def _addr(a, b):
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in ADDR.split(", "))


def _hs(name: str, pend: str) -> str:
    """Oracle text of the work set over the loads in CTE ``pend``."""
    return f"""
{name} AS (
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
  FROM f_hu_shipped hum
  JOIN f_stored_shipped s ON s.hu_id = hum.hu_id AND s.wh_id = hum.wh_id
  JOIN f_pick k ON s.type = k.pick_id
  JOIN f_item i ON i.item_number = s.item_number AND i.wh_id = s.wh_id
  JOIN f_item_uom u ON u.item_number = k.item_number AND u.uom = k.uom AND u.wh_id = k.wh_id
  JOIN f_order o ON o.order_number = k.order_number AND o.wh_id = k.wh_id
  JOIN f_customer c ON c.customer_id = o.customer_id
  WHERE EXISTS (SELECT 1 FROM {pend} p WHERE p.wh_id = hum.wh_id AND p.load_id = hum.load_id)
  GROUP BY hum.hu_id, hum.wh_id, k.order_number, hum.load_id, hum.parent_hu_id, s.item_number,
    i.description, k.line_number, k.cartonization_batch_id, k.pick_area, k.uom,
    u.conversion_factor, i.class_id, c.gln, i.gs1_required_flag, c.gs1_required_flag,
    c.customer_code, c.customer_id, o.stop_id, c.totes_required, o.tote_count_flag,
    o.ship_to_addr1, o.ship_to_city, o.ship_to_state, o.ship_to_zip, k.container_type, o.carrier)"""


_CONTAINERS = """
  SELECT h.wh_id, h.customer_code, h.load_id, h.order_number, h.container_type,
    CAST(count(DISTINCT h.hu_id) AS INT) AS shipped_qty, {date} AS shipment_date,
    h.ship_to_addr1, h.ship_to_city, h.ship_to_state, h.ship_to_zip, h.stop_id, h.carrier
  FROM {hs} h {extra}
  JOIN f_container n ON n.wh_id = h.wh_id AND n.container_type = h.container_type
  WHERE coalesce(h.totes_required, 0) = 1 AND coalesce(n.shipping_container, 0) = 1
    AND h.quantity > 0
  GROUP BY h.wh_id, h.customer_code, h.load_id, h.order_number, h.container_type,
    h.ship_to_addr1, h.ship_to_city, h.ship_to_state, h.ship_to_zip, h.stop_id, h.carrier{gextra}
"""

_BASE = f"""
WITH pend AS (
  SELECT q.unique_id, q.wh_id, q.load_id, l.route_id, l.earliest_ship_date AS shipment_date
  FROM f_load_queue q LEFT JOIN f_load l ON l.wh_id = q.wh_id AND l.load_id = q.load_id
  WHERE q.queue_status = 0 AND coalesce(q.preship_scan_gs1, 0) = 0),
{_hs("hs", "pend").strip()},
od AS (SELECT wh_id, order_number, line_number, item_number, uom AS order_uom,
              planned_quantity AS qty FROM f_pick),
cand AS (
  SELECT DISTINCT customer_id, customer_code, wh_id, load_id, order_number, {ADDR} FROM hs
  WHERE coalesce(totes_required, 0) = 1 AND coalesce(tote_count_flag, 0) = 1),
elig AS (
  SELECT DISTINCT o.wh_id, o.ship_to_addr1, o.ship_to_city, o.ship_to_state, o.ship_to_zip,
    o.load_id, l.created_date
  FROM f_order o JOIN f_load l ON l.wh_id = o.wh_id AND l.load_id = o.load_id
  WHERE coalesce(o.order_type, '') <> 'TRANSFER'
    AND right(rtrim(coalesce(o.carrier, '')), 2) <> 'WC'),
prior AS (
  SELECT c.*, coalesce((
    SELECT e.load_id FROM elig e
    WHERE e.wh_id = c.wh_id AND {_addr('e', 'c')} AND e.load_id <> c.load_id
    ORDER BY e.created_date DESC, e.load_id DESC LIMIT 1), '') AS prior_load_id
  FROM cand c),
units AS (
  SELECT DISTINCT k.wh_id, o.load_id, o.customer_id, o.ship_to_addr1, o.ship_to_city,
    o.ship_to_state, o.ship_to_zip, k.container_id AS hu_id
  FROM f_pick k
  JOIN f_pick_master m ON m.pick_master_id = k.container_id
  JOIN f_container n ON n.wh_id = m.wh_id AND n.container_type = m.container_type
  JOIN f_order o ON o.order_number = k.order_number AND o.wh_id = k.wh_id
  WHERE coalesce(n.shipping_container, 0) = 1 AND k.picked_quantity > 0
    AND coalesce(o.order_type, '') <> 'TRANSFER'
    AND right(rtrim(coalesce(o.carrier, '')), 2) <> 'WC'),
ptc AS (
  SELECT p.*, CAST(coalesce((
    SELECT count(DISTINCT u.hu_id) FROM units u
    WHERE u.wh_id = p.wh_id AND u.load_id = p.prior_load_id
      AND (u.customer_id = p.customer_id OR ({_addr('u', 'p')}))), 0) AS INT) AS tote_count
  FROM prior p),
hist AS (SELECT * FROM f_container_history),
fbm AS (
  SELECT p.wh_id, p.load_id, p.order_number, p.customer_id, p.ship_to_addr1, p.ship_to_city,
    p.ship_to_state, p.ship_to_zip, CAST(hi.shipment_date AS DATE) AS d,
    hi.ship_to_addr1 AS a1, hi.ship_to_city AS a2, hi.ship_to_state AS a3, hi.ship_to_zip AS a4,
    sum(hi.shipped_qty) AS s
  FROM ptc p, hist hi JOIN f_customer cu ON cu.customer_code = hi.customer_code
  WHERE p.tote_count = 0
    AND (hi.load_id NOT LIKE '%WC%' OR hi.load_id NOT LIKE '%CC%' OR hi.load_id NOT LIKE '%UP%')
    AND right(rtrim(coalesce(hi.carrier, '')), 2) <> 'WC'
    AND CAST(hi.shipment_date AS DATE) < CAST({TS} AS DATE)
    AND (cu.customer_code = p.customer_code
         OR (cu.customer_addr1 = p.ship_to_addr1 AND cu.customer_city = p.ship_to_city
             AND cu.customer_state = p.ship_to_state AND cu.customer_zip = p.ship_to_zip))
  GROUP BY p.wh_id, p.load_id, p.order_number, p.customer_id, p.ship_to_addr1, p.ship_to_city,
    p.ship_to_state, p.ship_to_zip, CAST(hi.shipment_date AS DATE), hi.ship_to_addr1,
    hi.ship_to_city, hi.ship_to_state, hi.ship_to_zip),
fb AS (
  SELECT * FROM (SELECT fbm.*, row_number() OVER (
    PARTITION BY wh_id, load_id, order_number, customer_id, {ADDR}
    ORDER BY d DESC, a1, a2, a3, a4) AS rn FROM fbm) x WHERE rn = 1),
totes AS (
  SELECT p.customer_id, p.customer_code, p.wh_id, p.load_id, p.order_number, p.ship_to_addr1,
    p.ship_to_city, p.ship_to_state, p.ship_to_zip, p.prior_load_id,
    CASE WHEN p.tote_count = 0 AND fb.s IS NOT NULL THEN CAST(fb.s AS INT) ELSE p.tote_count END
      AS tote_count
  FROM ptc p LEFT JOIN fb ON fb.wh_id = p.wh_id AND fb.load_id = p.load_id
    AND fb.order_number = p.order_number AND fb.customer_id = p.customer_id
    AND {_addr('fb', 'p')}),
stops AS (
  SELECT p.wh_id, p.load_id, coalesce((
    SELECT max(o.stop_id) FROM f_order o JOIN f_load l ON l.wh_id = o.wh_id AND l.load_id = o.load_id
    WHERE o.wh_id = p.wh_id AND o.load_id = p.load_id), 1) + 1 AS po_stop
  FROM (SELECT DISTINCT wh_id, load_id FROM pend) p),
bpo AS (
  SELECT p.wh_id, p.load_id, m.po_number, m.wh_id AS po_wh_id, m.vendor_code,
    s.po_stop AS stop_id, m.route_id, d.line_number, d.item_number,
    m.sent_flag AS sent_to_service
  FROM pend p JOIN stops s ON s.wh_id = p.wh_id AND s.load_id = p.load_id
  JOIN f_po m ON m.carrier_scac = p.wh_id AND m.route_id = p.route_id
    AND m.shipment_date = p.shipment_date
  JOIN f_po_line d ON d.po_number = m.po_number AND d.wh_id = m.wh_id
  WHERE rtrim(m.status) = 'O'
    AND (NOT EXISTS (SELECT 1 FROM f_backhaul b WHERE b.po_number = m.po_number AND b.wh_id = m.wh_id)
         OR EXISTS (SELECT 1 FROM f_backhaul b WHERE b.po_number = m.po_number AND b.wh_id = m.wh_id
                    AND coalesce(rtrim(b.status), '') <> 'COMPLETE'))
    AND NOT EXISTS (SELECT 1 FROM f_receipt r
                    JOIN f_po m2 ON m2.po_number = r.po_number AND m2.carrier_scac = r.wh_id
                    WHERE m2.route_id = p.route_id AND m2.carrier_scac = p.wh_id
                      AND m2.shipment_date = p.shipment_date)),
caseupc AS (
  SELECT DISTINCT wh_id, item_number FROM f_item_upc
  WHERE rtrim(uom) = 'CS' AND length(rtrim(upc)) BETWEEN 12 AND 14),
lcg AS (
  SELECT wh_id, item_number, right('000' || upc, 14) AS gtin FROM (
    SELECT wh_id, item_number, upc, row_number() OVER (
      PARTITION BY wh_id, item_number ORDER BY modified_datetime DESC, upc DESC) AS rn
    FROM f_item_upc WHERE rtrim(uom) = 'CS' AND length(rtrim(upc)) BETWEEN 12 AND 14) x
  WHERE rn = 1),
lb AS (
  SELECT d.wh_id, h.load_id, d.order_number, d.line_number, d.item_number, d.order_uom, d.qty,
    i.class_id, i.description, i.net_weight_barcode, h.hu_id, h.gs1_required_flag, h.quantity,
    (rtrim(d.order_uom) = 'CS' AND coalesce(c.gln, '') <> ''
     AND EXISTS (SELECT 1 FROM caseupc cu WHERE cu.wh_id = d.wh_id AND cu.item_number = d.item_number))
      AS arm
  FROM od d
  JOIN f_item i ON i.item_number = d.item_number AND i.wh_id = d.wh_id
  JOIN hs h ON h.line_number = d.line_number AND h.order_number = d.order_number AND h.wh_id = d.wh_id
  JOIN f_customer c ON c.customer_id = h.customer_id),
ph AS (
  SELECT x.*, coalesce(rtrim(x.order_uom) = 'CS' AND coalesce(x.gln, '') <> ''
    AND EXISTS (SELECT 1 FROM caseupc cu WHERE cu.wh_id = x.wh_id AND cu.item_number = x.item_number),
    false) AS gs1_case_pick,
    CAST(CASE WHEN x.cartonization_batch_id LIKE 'TOTE%' THEN 27
         WHEN coalesce(x.class_id, '') <> '' THEN {{PC_CLASS}}
         ELSE {{PC_AREA}} END AS VARCHAR) AS purpose_number
  FROM (SELECT wh_id, load_id, hu_id, order_number, order_uom, gln, item_number, hu_desc,
          cartonization_batch_id, class_id, pick_area,
          row_number() OVER (PARTITION BY wh_id, load_id, hu_id
                             ORDER BY order_number, line_number, item_number) AS rn
        FROM hs) x WHERE x.rn = 1)
"""


def _pc(col: str) -> str:
    return (f"CASE rtrim({col}) WHEN 'CIG' THEN 20 WHEN 'CLR' THEN 3 WHEN 'DRY' THEN 4 "
            f"WHEN 'FRZ' THEN 6 WHEN 'PRO' THEN 7 ELSE 13 END")


BASE = _BASE.replace("{PC_CLASS}", _pc("x.class_id")).replace("{PC_AREA}", _pc("x.pick_area"))

_LINE_COLS = """'item' AS type_name, class_id AS type_description,
  CAST({pc} AS VARCHAR) AS purpose_number, description,
  CAST(sum(quantity) AS BIGINT) AS ordered_quantity, 0 AS fulfilled_quantity,
  CAST(sum(quantity) AS BIGINT) AS service_quantity,
  {gt} AS gs1_type, {gn} AS gs1_number,
  CASE WHEN coalesce(net_weight_barcode, 0) <> 0 THEN 'netWeightBarcode' END AS property_name,
  CASE WHEN coalesce(net_weight_barcode, 0) <> 0 THEN 'GS1NetWeightFlag' END AS property_description,
  CASE WHEN coalesce(net_weight_barcode, 0) <> 0 THEN 'string' END AS property_data_type,
  CASE WHEN coalesce(net_weight_barcode, 0) <> 0 THEN CAST(net_weight_barcode AS VARCHAR) END
    AS property_value,
  lb.item_number, order_uom"""

GS1_LINES = f"""
SELECT lb.wh_id, load_id, order_number,
  hu_id || CASE WHEN gs1_required_flag = 1 THEN '-GS1' ELSE '' END AS line_id,
  {_LINE_COLS.format(pc=_pc('class_id'), gt="CASE WHEN gs1_required_flag = 1 THEN 'GTIN' END",
                     gn="CASE WHEN gs1_required_flag = 1 THEN g.gtin END")}
FROM lb LEFT JOIN lcg g ON g.wh_id = lb.wh_id AND g.item_number = lb.item_number
WHERE arm
GROUP BY lb.wh_id, load_id, order_number, class_id, lb.item_number, line_number, description, qty,
  order_uom, hu_id, gs1_required_flag, net_weight_barcode, g.gtin
"""

STD_LINES = f"""
SELECT wh_id, load_id, order_number, line_number AS line_id,
  {_LINE_COLS.format(pc=_pc('class_id'), gt="CAST(NULL AS VARCHAR)", gn="CAST(NULL AS VARCHAR)")}
FROM lb
WHERE NOT arm
GROUP BY wh_id, load_id, order_number, class_id, item_number, line_number, description, qty,
  order_uom, net_weight_barcode
"""


def _run(fx) -> OutboundRun:
    return OutboundRun(OutboundInputs.from_fixtures(fx))


@query("pending_loads", BASE + "SELECT * FROM pend")
def q_pending_loads(fx):
    return _run(fx).pending


@query("po_stop", BASE + "SELECT * FROM stops")
def q_po_stop(fx):
    return _run(fx).stops


@query("shipped_lines", BASE + "SELECT * FROM hs")
def q_shipped_lines(fx):
    return _run(fx).lines


def _bucketed_run(fx) -> OutboundRun:
    """A run whose line tables are bucketed, with a bucket for every shuffle partition."""
    inputs = OutboundInputs.from_fixtures(fx)
    buckets = int(fx.spark.conf.get("spark.sql.shuffle.partitions"))
    return OutboundRun(inputs.replaced(**bucketed_inputs(inputs, buckets, f"lines_{uuid.uuid4().hex}", temporary=True)))


@query("shipped_lines_bucketed", BASE + "SELECT * FROM hs")
def q_shipped_lines_bucketed(fx):
    """The work set from bucketed tables: stored items and picks are not shuffled."""
    return _bucketed_run(fx).lines


@query("order_lines_bucketed", BASE + GS1_LINES + "UNION ALL" + STD_LINES)
def q_order_lines_bucketed(fx):
    """Message lines from bucketed tables: order detail isn't shuffled either."""
    return _bucketed_run(fx).order_lines


@query("tote_candidates", BASE + "SELECT * FROM cand")
def q_tote_candidates(fx):
    return _run(fx).candidates


@query("prior_load", BASE + "SELECT * FROM prior")
def q_prior_load(fx):
    return _run(fx).prior


@query("prior_tote_count", BASE + "SELECT * FROM ptc")
def q_prior_tote_count(fx):
    return _run(fx).prior_counts


@query("fallback_tote_count", BASE + "SELECT * FROM totes")
def q_fallback_tote_count(fx):
    return _run(fx).totes


_DAYS = """
SELECT customer_code, CAST(shipment_date AS DATE) AS ship_date, ship_to_addr1 AS cs_ship_to_addr1, ship_to_city AS cs_ship_to_city,
  ship_to_state AS cs_ship_to_state, ship_to_zip AS cs_ship_to_zip, CAST(sum(shipped_qty) AS BIGINT) AS shipped_qty
FROM ({rows}) h
WHERE (load_id NOT LIKE '%WC%' OR load_id NOT LIKE '%CC%' OR load_id NOT LIKE '%UP%') AND right(rtrim(coalesce(carrier, '')), 2) <> 'WC'
GROUP BY customer_code, CAST(shipment_date AS DATE), ship_to_addr1, ship_to_city, ship_to_state, ship_to_zip
QUALIFY dense_rank() OVER (PARTITION BY customer_code ORDER BY CAST(shipment_date AS DATE) DESC) <= 2
"""


@query("latest_days", _DAYS.format(rows="SELECT * FROM f_container_history"))
def q_latest_days(fx):
    """The kept table made from the whole history: the newest two ship days of each customer code."""
    return O.latest_days(O.shipped_days(fx.f_container_history))


@query("fallback_tote_count_kept", BASE + "SELECT * FROM totes")
def q_fallback_tote_count_kept(fx):
    """The fallback counts from the kept table; the history isn't read by the run."""
    kept = stage(O.latest_days(O.shipped_days(fx.f_container_history)))
    return OutboundRun(OutboundInputs.from_fixtures(fx), kept_days=kept).totes


@query("tote_expectations", BASE + f"""
SELECT t.wh_id, c.customer_code, c.customer_name, t.prior_load_id AS load_id,
  t.load_id AS source_load_id, t.order_number, t.tote_count AS tote_expected, {TS} AS create_date
FROM totes t JOIN f_customer c ON c.customer_id = t.customer_id
""")
def q_tote_expectations(fx):
    return _run(fx).tote_log


@query("container_shipments", BASE + _CONTAINERS.format(date=TS, hs="hs", extra="", gextra=""))
def q_container_shipments(fx):
    return _run(fx).container_rows


@query("backhaul_pos", BASE + "SELECT * FROM bpo")
def q_backhaul_pos(fx):
    return _run(fx).po


@query("order_gtins", BASE + """
SELECT h.wh_id, h.load_id, h.order_number, d.line_number, u.upc,
  CAST(row_number() OVER (PARTITION BY h.wh_id, h.load_id, h.order_number, d.line_number
                          ORDER BY u.upc DESC) AS INT) AS rownum
FROM (SELECT DISTINCT wh_id, load_id, order_number FROM hs) h
JOIN f_order o ON o.order_number = h.order_number AND o.wh_id = h.wh_id
JOIN f_customer c ON c.customer_id = o.customer_id
JOIN od d ON d.order_number = o.order_number AND d.wh_id = o.wh_id
JOIN f_item_upc u ON u.item_number = d.item_number AND u.wh_id = d.wh_id
JOIN f_item i ON i.item_number = d.item_number AND i.wh_id = d.wh_id
WHERE rtrim(d.order_uom) = 'CS' AND length(rtrim(u.upc)) BETWEEN 12 AND 14
  AND coalesce(c.gln, '') <> '' AND i.gs1_required_flag = 1
  AND coalesce(c.gs1_required_flag, 0) <> 0
""")
def q_order_gtins(fx):
    return _run(fx).gtins


TOTALS_SQL = """
SELECT wh_id, load_id, order_number,
  CAST(coalesce(sum(CASE WHEN rtrim(product_type) IN ('CIG', 'CIGP') THEN uom_qty END), 0) AS INT) AS cig_count,
  CAST(coalesce(sum(CASE WHEN rtrim(product_type) = 'LILCIG' THEN uom_qty END), 0) AS INT) AS lil_cig_count,
  CAST(coalesce(sum(CASE WHEN rtrim(product_type) IN ('SNF', 'SNFP') THEN uom_qty END), 0) AS INT) AS snuff_count,
  CAST(coalesce(sum(CASE WHEN rtrim(product_type) = 'ECIG' THEN uom_qty END), 0) AS INT) AS ecig_count
FROM cps GROUP BY wh_id, load_id, order_number
"""


@query("counted_product_totals", "WITH cps AS (" + COUNTED_SQL + ")\n" + TOTALS_SQL)
def q_counted_product_totals(fx):
    from dockyard.operators import confirm as C
    s = C.counted_product_shipments(fx.f_pick, fx.f_item, fx.f_item_uom, fx.f_order,
                                    fx.f_customer)
    return O.counted_product_totals(s)


@query("purpose_code", f"""
SELECT wh_id, item_number, class_id, {_pc('class_id')} AS purpose_code FROM f_item
""")
def q_purpose_code(fx):
    from dockyard.functions.columns import purpose_code
    return fx.f_item.select("wh_id", "item_number", "class_id",
                            purpose_code("class_id").alias("purpose_code"))


@query("latest_case_gtin", BASE + "SELECT * FROM lcg")
def q_latest_case_gtin(fx):
    return O.latest_case_gtin(fx.f_item_upc)


@query("gs1_order_lines", BASE + GS1_LINES)
def q_gs1_order_lines(fx):
    return _run(fx).gs1_lines


@query("standard_order_lines", BASE + STD_LINES)
def q_standard_order_lines(fx):
    return _run(fx).standard_lines


@query("order_lines", BASE + GS1_LINES + "UNION ALL" + STD_LINES)
def q_order_lines(fx):
    return _run(fx).order_lines


_PROPS = [
    ("destGLN", "Customer Destination GLN",
     "coalesce(gln, '') <> '' AND coalesce(cust_gs1, 0) <> 0", "gln"),
    ("ExpectedPickups", "Expected Pickups", "coalesce(tote_count, 0) <> 0",
     "CAST(tote_count AS VARCHAR)"),
    ("chainName", "GS1 Chain Name",
     "coalesce(chain_name, '') <> '' AND coalesce(cust_gs1, 0) <> 0", "chain_name"),
    ("ExpectedCigCount", "Expected Cig Count", "cig_count <> 0", "CAST(cig_count AS VARCHAR)"),
    ("ExpectedLilCigCount", "Expected Lil Cig Count", "lil_cig_count <> 0",
     "CAST(lil_cig_count AS VARCHAR)"),
    ("ExpectedECigCount", "Expected E-Cig Count", "ecig_count <> 0", "CAST(ecig_count AS VARCHAR)"),
    ("ExpectedSnuffCount", "Expected Snuff Count", "snuff_count <> 0",
     "CAST(snuff_count AS VARCHAR)"),
]

HEADERS = f""",
cps AS (SELECT * FROM f_pod_shipments),
tot AS ({TOTALS_SQL}),
hdr AS (
  SELECT k.wh_id, k.load_id, k.order_number, c.customer_id, c.customer_code, c.customer_name,
    c.gln, c.gs1_required_flag AS cust_gs1, c.chain_name, t.tote_count,
    coalesce(tt.cig_count, 0) AS cig_count, coalesce(tt.lil_cig_count, 0) AS lil_cig_count,
    coalesce(tt.snuff_count, 0) AS snuff_count, coalesce(tt.ecig_count, 0) AS ecig_count
  FROM (SELECT DISTINCT wh_id, load_id, order_number FROM hs) k
  JOIN f_order o ON o.wh_id = k.wh_id AND o.order_number = k.order_number
  JOIN f_customer c ON c.customer_id = o.customer_id
  LEFT JOIN totes t ON t.wh_id = k.wh_id AND t.load_id = k.load_id
    AND t.order_number = k.order_number AND t.customer_id = o.customer_id
  LEFT JOIN tot tt ON tt.wh_id = k.wh_id AND tt.load_id = k.load_id
    AND tt.order_number = k.order_number)
"""

PROPS_SQL = "\nUNION ALL\n".join(
    f"SELECT wh_id, load_id, order_number, {i + 1} AS pos, '{n}' AS name, '{d}' AS description, "
    f"'string' AS data_type, {v} AS value FROM hdr WHERE {t}"
    for i, (n, d, t, v) in enumerate(_PROPS))


@query("order_properties", BASE + HEADERS + """
SELECT wh_id, load_id, order_number, name, description, data_type, value,
  CAST(row_number() OVER (PARTITION BY wh_id, load_id, order_number ORDER BY pos) AS INT) AS pos
FROM (""" + PROPS_SQL + ") p")
def q_order_properties(fx):
    from pyspark.sql import functions as F
    h = _run(fx).headers
    return (h.select("wh_id", "load_id", "order_number",
                     F.posexplode("properties").alias("pos", "p"))
            .select("wh_id", "load_id", "order_number", F.col("p._name").alias("name"),
                    F.col("p._description").alias("description"),
                    F.col("p._dataType").alias("data_type"), F.col("p._VALUE").alias("value"),
                    (F.col("pos") + 1).cast("int").alias("pos")))


PO_LINES = """
SELECT s.wh_id, s.load_id, s.po_number, d.line_number, 'item' AS type_name,
  i.class_id AS type_description, 'pickup' AS purpose_number, i.description,
  CAST(sum(d.qty) AS INT) AS ordered_quantity, 0 AS fulfilled_quantity,
  CAST(sum(d.qty) AS INT) AS service_quantity, d.item_number, d.order_uom
FROM (SELECT DISTINCT wh_id, load_id, po_number, po_wh_id, line_number FROM bpo) s
JOIN f_po_line d ON d.po_number = s.po_number AND d.wh_id = s.po_wh_id AND d.line_number = s.line_number
JOIN f_item i ON i.item_number = d.item_number AND i.wh_id = d.wh_id
WHERE (rtrim(d.order_uom) = 'CS' AND EXISTS (SELECT 1 FROM caseupc cu WHERE cu.wh_id = d.wh_id AND cu.item_number = d.item_number))
   OR NOT (rtrim(d.order_uom) = 'CS' AND EXISTS (SELECT 1 FROM caseupc cu WHERE cu.wh_id = d.wh_id AND cu.item_number = d.item_number))
GROUP BY s.wh_id, s.load_id, s.po_number, i.class_id, d.item_number, d.line_number, i.description,
  d.qty, d.order_uom
"""


@query("po_lines_message", BASE + PO_LINES)
def q_po_lines_message(fx):
    return _run(fx).po_lines_msg


@query("po_state_update", BASE + """
SELECT m.po_number, m.wh_id, m.status,
  CASE WHEN EXISTS (SELECT 1 FROM bpo WHERE bpo.po_number = m.po_number) THEN 1 ELSE m.sent_flag END
    AS sent_flag
FROM f_po m
""")
def q_po_state_update(fx):
    return _run(fx).po_state[0].select("po_number", "wh_id", "status", "sent_flag")


@query("backhaul_state_update", BASE + """
SELECT b.po_number, b.wh_id,
  CASE WHEN EXISTS (SELECT 1 FROM bpo WHERE bpo.po_number = b.po_number AND bpo.sent_to_service = 1)
       THEN 'SENT' ELSE b.status END AS status
FROM f_backhaul b
""")
def q_backhaul_state_update(fx):
    return _run(fx).po_state[1]


@query("pallet_purpose", BASE + """
SELECT wh_id, load_id, hu_id, cartonization_batch_id, class_id, pick_area, purpose_number FROM ph
""")
def q_pallet_purpose(fx):
    return _run(fx).pallet_heads.select("wh_id", "load_id", "hu_id", "cartonization_batch_id",
                                        "class_id", "pick_area", "purpose_number")


@query("non_gs1_pallets", BASE + """
SELECT wh_id, load_id, hu_id, order_number, item_number, hu_desc, purpose_number FROM ph
WHERE NOT gs1_case_pick
""")
def q_non_gs1_pallets(fx):
    return _run(fx).pallets.select("wh_id", "load_id", "hu_id", "order_number", "item_number",
                                   "hu_desc", "purpose_number")


@query("pallet_items", BASE + """
SELECT wh_id, load_id, hu_id, order_number, line_number, CAST(sum(quantity) AS BIGINT) AS quantity
FROM hs GROUP BY wh_id, load_id, hu_id, order_number, line_number
""")
def q_pallet_items(fx):
    return _run(fx).pallet_items


@query("complete_loads", BASE + f"""
SELECT q.unique_id, q.wh_id, q.load_id,
  CASE WHEN p.unique_id IS NOT NULL THEN 2 ELSE q.queue_status END AS queue_status,
  q.preship_scan_gs1,
  CASE WHEN p.unique_id IS NOT NULL THEN {TS} END AS dt_processed
FROM f_load_queue q LEFT JOIN pend p ON p.unique_id = q.unique_id
""")
def q_complete_loads(fx):
    return _run(fx).queue_done
