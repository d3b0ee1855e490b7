"""Import documents and message nodes: odd rows, and where their rows meet."""

import datetime as dt

from pyspark.sql import functions as F

from dockyard.functions.xml_nodes import message_nodes
from dockyard.sources.documents import event_documents


def _documents(spark, imports):
    i = spark.createDataFrame(
        [(u, o, "OTA", "ok", None, 1, 1, dt.datetime(2001, 1, 1)) for u, o in imports],
        "unique_id bigint, order_number string, trigger_type string, kind string, purpose string, "
        "tote_count int, cig_count int, event_ts timestamp_ntz")
    o = spark.createDataFrame([(n, "W0", "R1", 1, "a", "c", "s", "z") for n in ("1", "2", "2")],
                              "order_number string, wh_id string, route_id string, customer_id bigint, ship_to_addr1 string, "
                              "ship_to_city string, ship_to_state string, ship_to_zip string")
    c = spark.createDataFrame([(1, "x < y & z")], "customer_id bigint, customer_name string")
    w = spark.createDataFrame([("W0", "900")], "wh_id string, pod_whse string")
    k = spark.createDataFrame([(n, ln, "P1", "H1", "TOTE", 2, 2) for n in ("1", "2") for ln in ("2.1", "1.1")],
                              "order_number string, line_number string, item_number string, container_id string, "
                              "container_type string, planned_quantity int, picked_quantity int")
    q = i.select("unique_id").distinct().withColumn("status", F.lit("N"))
    return event_documents(i, o, c, w, k, q)


def test_f6_events_have_the_items_of_all_their_rows(spark):
    rows = _documents(spark, [(4, "1"), (8, "2"), (12, "9"), (16, "1"), (16, "1")]).collect()
    n = {r.unique_id: r.xml_response.count("<i:orderItemStatusSummary>") for r in rows}
    # order 2 has two rows, event 16 comes twice, order 9 is unknown
    assert n == {4: 2, 8: 4, 12: 0, 16: 4} and len(rows) == 6
    one = next(r.xml_response for r in rows if r.unique_id == 4)
    assert one.index("1.1</i:lineNumber>") < one.index("2.1</i:lineNumber>")
    assert "x &lt; y &amp; z" in one and "\n" not in one
    assert one.startswith('<i:orderStatusSummaryEvent xmlns:i="urn:example:delivery-integration"><i:trigger ')


def test_f6_picks_are_collected_per_order(spark):
    plan = _documents(spark, [(4, "1")])._jdf.queryExecution().optimizedPlan().toString()
    collects = [line for line in plan.splitlines() if "collect_list" in line]
    assert len(collects) == 1 and "Aggregate [order_number" in collects[0]


def test_f1_nodes_take_one_regular_expression_a_message(spark):
    m = spark.createDataFrame([(1, '<a x="1>2"><b>t > u\n</b></a>'), (2, None), (3, "")], "message_id int, message_xml string")
    out = message_nodes(m)
    got = [tuple(r) for r in out.orderBy("message_id", "pos").collect()]
    assert got == [(1, 1, 'a x="1', '2">'), (1, 2, "b", "t > u\n"), (1, 3, "/b", ""), (1, 4, "/a", "")]
    assert "regexp_extract(" not in out._jdf.queryExecution().optimizedPlan().toString()
