"""Registered queries for ship confirmation + their oracles."""

from __future__ import annotations


from dockyard.functions.columns import AS_OF
from dockyard.operators import confirm as C
from dockyard.plans.confirm import ConfirmInputs, ConfirmRun
from dockyard.plans.registry import query

TS = f"CAST(TIMESTAMP '{AS_OF}' AS TIMESTAMP)"

# Oracle CTEs shared by the chain: carrier class, the two checks, accepted
# loads, shipment numbers, doors, units after the will-call move.
_CHAIN = f"""
WITH car AS (
  SELECT wh_id, load_id, carrier,
    CASE WHEN right(rtrim(coalesce(carrier, '')), 2) = 'WC' THEN 1 ELSE 0 END AS will_call
  FROM (SELECT wh_id, load_id, carrier,
          row_number() OVER (PARTITION BY wh_id, load_id ORDER BY order_number) AS rn
        FROM f_order) x
  WHERE rn = 1),
nfl AS (
  SELECT DISTINCT k.wh_id, k.load_id FROM f_pick k
  LEFT JOIN f_hu h ON h.hu_id = k.container_id AND h.wh_id = k.wh_id
  JOIN car c ON c.wh_id = k.wh_id AND c.load_id = k.load_id AND c.will_call = 0
  WHERE NOT (k.picked_quantity = 0 AND rtrim(k.status) IN ('SHORTED', 'UNPICKED'))
    AND rtrim(k.status) <> 'LOADED' AND coalesce(rtrim(h.type), 'SO') <> 'LO'),
shp AS (SELECT DISTINCT wh_id, load_id FROM f_pick WHERE rtrim(status) = 'SHIPPED'),
acc AS (
  SELECT r.* FROM f_confirm_request r
  WHERE NOT EXISTS (SELECT 1 FROM nfl n WHERE n.wh_id = r.wh_id AND n.load_id = r.load_id)
    AND NOT EXISTS (SELECT 1 FROM shp s WHERE s.wh_id = r.wh_id AND s.load_id = r.load_id)),
sj AS (
  SELECT l.wh_id, l.load_id, l.load_master_id, s.shipment_number
  FROM f_load l JOIN (SELECT DISTINCT wh_id, load_id FROM acc) a
    ON a.wh_id = l.wh_id AND a.load_id = l.load_id
  LEFT JOIN f_shipment s ON s.load_master_id = l.load_master_id),
ship AS (
  SELECT wh_id, load_id, load_master_id, shipment_number, 0 AS is_new,
    CAST(NULL AS VARCHAR) AS status, CAST(NULL AS TIMESTAMP) AS created_date
  FROM sj WHERE coalesce(shipment_number, '') <> ''
  UNION ALL
  SELECT wh_id, load_id, load_master_id,
    CAST((SELECT coalesce(max(CAST(shipment_number AS BIGINT)), 0) FROM f_shipment)
         + row_number() OVER (ORDER BY wh_id, load_id) AS VARCHAR),
    1, 'S', {TS}
  FROM sj WHERE coalesce(shipment_number, '') = ''),
door AS (
  SELECT l.wh_id, l.load_id, coalesce(l.door_loc, w.c1, 'DOOR001') AS door_loc
  FROM f_load l
  JOIN car c ON c.wh_id = l.wh_id AND c.load_id = l.load_id AND c.will_call = 1
  JOIN f_wh_control w ON w.wh_id = l.wh_id AND rtrim(w.control_type) = 'WC_DEFAULT_DOOR'
  WHERE EXISTS (SELECT 1 FROM acc a WHERE a.wh_id = l.wh_id AND a.load_id = l.load_id)),
hus1 AS (
  SELECT h.hu_id, h.wh_id, h.control_number, h.load_id,
    CASE WHEN d.door_loc IS NOT NULL AND coalesce(rtrim(h.type), '') <> 'LO' THEN 'LO' ELSE h.type END AS type,
    CASE WHEN d.door_loc IS NOT NULL AND coalesce(rtrim(h.type), '') <> 'LO' THEN d.door_loc END AS location_id
  FROM f_hu h LEFT JOIN door d ON d.wh_id = h.wh_id AND d.load_id = h.load_id),
items1 AS (
  SELECT s.hu_id, s.wh_id, s.item_number, s.type, s.actual_qty, m.door_loc AS location_id
  FROM f_stored_shipped s LEFT JOIN (
    SELECT h.hu_id, h.wh_id, d.door_loc FROM f_hu h
    JOIN door d ON d.wh_id = h.wh_id AND d.load_id = h.load_id
    WHERE coalesce(rtrim(h.type), '') <> 'LO') m
  ON m.hu_id = s.hu_id AND m.wh_id = s.wh_id),
arch AS (
  SELECT h.*, s.shipment_number FROM hus1 h
  JOIN ship s ON s.wh_id = h.wh_id AND s.load_id = h.load_id
  WHERE rtrim(h.type) = 'LO'),
loads1 AS (
  SELECT l.*,
    CASE WHEN a.load_id IS NOT NULL THEN 'SHIPPED' ELSE l.status END AS status1,
    CASE WHEN a.load_id IS NOT NULL THEN a.seal END AS seal_number,
    CASE WHEN a.load_id IS NOT NULL THEN {TS} END AS actual_ship_date
  FROM f_load l LEFT JOIN acc a ON a.wh_id = l.wh_id AND a.load_id = l.load_id),
orders1 AS (
  SELECT o.*,
    CASE WHEN a.load_id IS NOT NULL THEN 'S' ELSE o.status END AS status1,
    CASE WHEN a.load_id IS NOT NULL THEN {TS} END AS actual_ship_date
  FROM f_order o LEFT JOIN (SELECT DISTINCT wh_id, load_id FROM acc) a
    ON a.wh_id = o.wh_id AND a.load_id = o.load_id),
carried AS (
  SELECT DISTINCT h.control_number AS order_number, h.wh_id FROM hus1 h
  WHERE rtrim(h.type) = 'LO'
    AND EXISTS (SELECT 1 FROM acc a WHERE a.wh_id = h.wh_id AND a.load_id = h.load_id)),
blocked AS (
  SELECT DISTINCT h.control_number AS order_number, h.wh_id FROM hus1 h
  JOIN loads1 l ON l.wh_id = h.wh_id AND l.load_id = h.load_id
  WHERE rtrim(l.status1) <> 'SHIPPED'),
orders2 AS (
  SELECT o.*, CASE WHEN c.order_number IS NOT NULL AND b.order_number IS NULL
                    AND rtrim(o.status1) <> 'S' THEN 'S' ELSE o.status1 END AS status2
  FROM orders1 o
  LEFT JOIN carried c ON c.order_number = o.order_number AND c.wh_id = o.wh_id
  LEFT JOIN blocked b ON b.order_number = o.order_number AND b.wh_id = o.wh_id),
touched AS (
  SELECT DISTINCT o.wh_id, o.load_id FROM orders2 o
  JOIN carried c ON c.order_number = o.order_number AND c.wh_id = o.wh_id),
open_o AS (SELECT DISTINCT wh_id, load_id FROM orders2 WHERE rtrim(status2) <> 'S'),
loads2 AS (
  SELECT l.*, CASE WHEN t.load_id IS NOT NULL AND p.load_id IS NULL
                    AND rtrim(l.status1) <> 'SHIPPED' THEN 'SHIPPED' ELSE l.status1 END AS status2
  FROM loads1 l
  LEFT JOIN touched t ON t.wh_id = l.wh_id AND t.load_id = l.load_id
  LEFT JOIN open_o p ON p.wh_id = l.wh_id AND p.load_id = l.load_id)
"""


def _run(fx) -> ConfirmRun:
    return ConfirmRun(ConfirmInputs.from_fixtures(fx))


ADDR = "ship_to_addr1, ship_to_city, ship_to_state, ship_to_zip"


@query("order_stop_rank", f"""
SELECT wh_id, load_id, stop_id, {ADDR}, order_number, 1 AS tote_count_flag,
  CAST(row_number() OVER (PARTITION BY wh_id, load_id, {ADDR} ORDER BY stop_id DESC) AS INT) AS stop_rank
FROM (SELECT wh_id, load_id, stop_id, {ADDR}, max(order_number) AS order_number
      FROM f_order GROUP BY wh_id, load_id, stop_id, {ADDR}) g
""")
def q_order_stop_rank(fx):
    return C.order_stop_rank(fx.f_order)


@query("tote_flag_update", _CHAIN + f""",
rk AS (
  SELECT order_number, wh_id, stop_rank FROM (
    SELECT wh_id, order_number,
      row_number() OVER (PARTITION BY wh_id, load_id, {ADDR} ORDER BY stop_id DESC) AS stop_rank
    FROM (SELECT wh_id, load_id, stop_id, {ADDR}, max(order_number) AS order_number
          FROM orders2 o
          WHERE EXISTS (SELECT 1 FROM acc a WHERE a.wh_id = o.wh_id AND a.load_id = o.load_id)
          GROUP BY wh_id, load_id, stop_id, {ADDR}) g) r
  WHERE stop_rank = 1)
SELECT o.order_number, o.wh_id, o.load_id, o.status2 AS status,
  CASE WHEN EXISTS (SELECT 1 FROM rk WHERE rk.order_number = o.order_number AND rk.wh_id = o.wh_id)
       THEN 1 ELSE o.tote_count_flag END AS tote_count_flag
FROM orders2 o
""")
def q_tote_flag_update(fx):
    return _run(fx).orders_toted.select("order_number", "wh_id", "load_id", "status",
                                        "tote_count_flag")


@query("load_carrier_class", _CHAIN + "SELECT wh_id, load_id, carrier, will_call FROM car")
def q_load_carrier_class(fx):
    return C.load_carrier_class(fx.f_order)


@query("not_fully_loaded", _CHAIN + "SELECT wh_id, load_id, 'NOT FULLY LOADED' AS reason FROM nfl")
def q_not_fully_loaded(fx):
    return C.not_fully_loaded(fx.f_pick, fx.f_hu, C.load_carrier_class(fx.f_order))


@query("already_shipped", _CHAIN + "SELECT wh_id, load_id, 'LOAD ALREADY SHIPPED' AS reason FROM shp")
def q_already_shipped(fx):
    return C.already_shipped(fx.f_pick)


@query("reject_loads", _CHAIN + """
SELECT r.wh_id, r.load_id,
  CASE WHEN n.load_id IS NOT NULL THEN 'NOT FULLY LOADED' ELSE 'LOAD ALREADY SHIPPED' END AS reason
FROM (SELECT DISTINCT wh_id, load_id FROM f_confirm_request) r
LEFT JOIN nfl n ON n.wh_id = r.wh_id AND n.load_id = r.load_id
LEFT JOIN shp s ON s.wh_id = r.wh_id AND s.load_id = r.load_id
WHERE n.load_id IS NOT NULL OR s.load_id IS NOT NULL
""")
def q_reject_loads(fx):
    return _run(fx).rejected


@query("assign_shipments", _CHAIN + "SELECT * FROM ship")
def q_assign_shipments(fx):
    return _run(fx).shipments


@query("uninvoiced_loads", _CHAIN + """
SELECT l.wh_id, l.load_id FROM f_load l
WHERE coalesce(l.invoiced_flag, 0) = 0
  AND EXISTS (SELECT 1 FROM acc a WHERE a.wh_id = l.wh_id AND a.load_id = l.load_id)
""")
def q_uninvoiced_loads(fx):
    r = _run(fx)
    return C.uninvoiced_loads(fx.f_load, r.accepted)


@query("will_call_door", _CHAIN + "SELECT * FROM door")
def q_will_call_door(fx):
    return _run(fx).doors


@query("will_call_hu_update", _CHAIN + "SELECT * FROM hus1")
def q_will_call_hu_update(fx):
    return _run(fx).hus_wc


@query("will_call_item_update", _CHAIN + "SELECT * FROM items1")
def q_will_call_item_update(fx):
    return _run(fx).items_wc


@query("archive_handling_units", _CHAIN + "SELECT * FROM arch")
def q_archive_handling_units(fx):
    return _run(fx).hus_archived


@query("archive_stored_items", _CHAIN + """
SELECT i.*, a.shipment_number FROM items1 i JOIN arch a ON a.hu_id = i.hu_id AND a.wh_id = i.wh_id
""")
def q_archive_stored_items(fx):
    return _run(fx).items_archived


@query("close_load_rows", _CHAIN + """
SELECT wh_id, load_id, route_id, earliest_ship_date, created_date, load_master_id,
  status1 AS status, door_loc, invoiced_flag, seal_number, actual_ship_date FROM loads1
""")
def q_close_load_rows(fx):
    return _run(fx).loads_closed


@query("close_pick_rows", _CHAIN + """
SELECT k.wh_id, k.load_id, k.order_number, k.pick_id, k.picked_quantity,
  CASE WHEN a.load_id IS NOT NULL THEN 'SHIPPED' ELSE k.status END AS status,
  CASE WHEN a.load_id IS NOT NULL THEN k.picked_quantity END AS shipped_quantity
FROM f_pick k LEFT JOIN (SELECT DISTINCT wh_id, load_id FROM acc) a
  ON a.wh_id = k.wh_id AND a.load_id = k.load_id
""")
def q_close_pick_rows(fx):
    return _run(fx).picks_closed.select("wh_id", "load_id", "order_number", "pick_id",
                                        "picked_quantity", "status", "shipped_quantity")


@query("close_order_rows", _CHAIN + """
SELECT order_number, wh_id, load_id, status1 AS status, actual_ship_date FROM orders1
""")
def q_close_order_rows(fx):
    return _run(fx).orders_closed.select("order_number", "wh_id", "load_id", "status",
                                         "actual_ship_date")


@query("close_cross_load_orders", _CHAIN + """
SELECT order_number, wh_id, load_id, status2 AS status FROM orders2
""")
def q_close_cross_load_orders(fx):
    return _run(fx).orders_cross.select("order_number", "wh_id", "load_id", "status")


@query("close_cross_load_loads", _CHAIN + """
SELECT wh_id, load_id, status2 AS status FROM loads2
""")
def q_close_cross_load_loads(fx):
    return _run(fx).loads_cross.select("wh_id", "load_id", "status")


@query("purge_shipped", _CHAIN + """
SELECT h.* FROM hus1 h
WHERE NOT (rtrim(h.type) = 'LO'
           AND EXISTS (SELECT 1 FROM arch a WHERE a.hu_id = h.hu_id AND a.wh_id = h.wh_id))
""")
def q_purge_shipped(fx):
    return _run(fx).hus_left


@query("purge_shipped_items", _CHAIN + """
SELECT i.* FROM items1 i
WHERE NOT EXISTS (SELECT 1 FROM arch a WHERE a.hu_id = i.hu_id AND a.wh_id = i.wh_id)
""")
def q_purge_shipped_items(fx):
    return _run(fx).items_left


@query("ship_audit_log", _CHAIN + f"""
SELECT '370' AS tran_type, 'Load Management Ship Confirm' AS description,
  {TS} AS start_tran_date, {TS} AS end_tran_date,
  coalesce(e.employee_id, a.username) AS employee_id, a.wh_id, a.load_id,
  a.trailer AS generic_attribute_1, left(a.seal, 500) AS generic_attribute_2,
  s.shipment_number AS shipment_id
FROM acc a
LEFT JOIN ship s ON s.wh_id = a.wh_id AND s.load_id = a.load_id
LEFT JOIN f_employee e ON e.username = a.username AND e.wh_id = a.wh_id
""")
def q_ship_audit_log(fx):
    return _run(fx).audit


_WC_Q = """
wcq AS (
  SELECT DISTINCT o.load_id, o.wh_id, 0 AS queue_status FROM f_order o
  JOIN f_wh_control w ON w.wh_id = o.wh_id AND rtrim(w.control_type) = 'WILL_CALL_POD'
    AND w.next_value = 1
  WHERE EXISTS (SELECT 1 FROM acc a WHERE a.wh_id = o.wh_id AND a.load_id = o.load_id)
    AND right(rtrim(coalesce(o.carrier, '')), 2) = coalesce(w.c1, 'WC')
    AND NOT EXISTS (SELECT 1 FROM f_load_queue q WHERE q.wh_id = o.wh_id AND q.load_id = o.load_id))
"""


@query("enqueue_will_call", _CHAIN + "," + _WC_Q + "SELECT * FROM wcq")
def q_enqueue_will_call(fx):
    return _run(fx).enqueue_wc


@query("enqueue_standard", _CHAIN + "," + _WC_Q + """
SELECT DISTINCT o.load_id, o.wh_id, 0 AS queue_status FROM f_order o
WHERE EXISTS (SELECT 1 FROM acc a WHERE a.wh_id = o.wh_id AND a.load_id = o.load_id)
  AND (right(rtrim(coalesce(o.carrier, '')), 2) <> 'WC' OR o.load_id LIKE '%ADD%')
  AND right(rtrim(coalesce(o.carrier, '')), 3) <> 'TRF'
  AND NOT EXISTS (SELECT 1 FROM f_load_queue q WHERE q.wh_id = o.wh_id AND q.load_id = o.load_id)
  AND NOT EXISTS (SELECT 1 FROM wcq w WHERE w.wh_id = o.wh_id AND w.load_id = o.load_id)
""")
def q_enqueue_standard(fx):
    return _run(fx).enqueue_std


COUNTED_SQL = f"""
SELECT k.wh_id, c.customer_code, k.load_id, k.order_number, o.earliest_ship_date AS shipment_date,
  o.stop_id,
  CAST(floor(round(sum(CAST(k.planned_quantity AS DOUBLE) / u.conversion_factor), 6)) AS INT) AS uom_qty,
  i.product_type, {TS} AS create_date
FROM f_pick k
JOIN f_item i ON i.wh_id = k.wh_id AND i.item_number = k.item_number
JOIN f_item_uom u ON u.wh_id = k.wh_id AND u.item_number = k.item_number AND u.uom = k.uom
JOIN f_order o ON o.wh_id = k.wh_id AND o.order_number = k.order_number
JOIN f_customer c ON c.customer_id = o.customer_id
WHERE rtrim(i.product_type) IN ('LILCIG', 'ECIG', 'CIG', 'CIGP', 'SNF', 'SNFP')
  AND k.picked_quantity > 0 AND coalesce(o.order_type, '') <> 'TRANSFER'
GROUP BY k.wh_id, k.load_id, k.order_number, i.product_type, o.stop_id, c.customer_code,
  o.earliest_ship_date
"""


@query("counted_product_shipments", COUNTED_SQL)
def q_counted_product_shipments(fx):
    """Flagship: counted-product quantities per order and type, all loads."""
    return C.counted_product_shipments(fx.f_pick, fx.f_item, fx.f_item_uom, fx.f_order,
                                       fx.f_customer)


@query("confirmed_counted_shipments", _CHAIN + COUNTED_SQL.replace(
    "WHERE rtrim(i.product_type)",
    "WHERE EXISTS (SELECT 1 FROM acc a WHERE a.wh_id = k.wh_id AND a.load_id = k.load_id)\n"
    "  AND rtrim(i.product_type)"))
def q_confirmed_counted_shipments(fx):
    """Counted products of the loads accepted by this confirm run."""
    return _run(fx).counted
