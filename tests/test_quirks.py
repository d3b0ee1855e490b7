"""Hand-written edge cases, one per reference quirk."""

from pyspark.sql import functions as F

from dockyard.functions.keys import assign_ids, first_wins_new
from dockyard.operators import confirm as C
from dockyard.operators import inbound as I
from dockyard.operators import outbound as O


def test_k3_first_wins_keeps_null_keys_and_respects_target(spark):
    df = spark.createDataFrame(
        [(1, "A", "W0"), (2, "A", "W0"), (3, None, "W0"), (4, None, "W0"), (5, "B", "W0")],
        "import_id int, order_number string, wh_id string")
    existing = spark.createDataFrame([("B", "W0")], "order_number string, wh_id string")
    out = first_wins_new(df, ["order_number", "wh_id"], "import_id", existing)
    assert sorted(r.import_id for r in out.collect()) == [1, 3, 4]


def test_assign_ids_do_not_depend_on_partitions(spark):
    df = spark.range(0, 500).select(F.col("id").cast("string").alias("k"))
    a = {r.k: r._seq for r in assign_ids(df, ["k"], num_partitions=3).collect()}
    b = {r.k: r._seq for r in assign_ids(df.repartition(7), ["k"], num_partitions=11).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, 501))
    assert a[min(a)] == 1


def test_k17_carrier_with_trailing_blanks_is_will_call(spark):
    o = spark.createDataFrame([("W0", "L1", "1", "XWC  "), ("W0", "L2", "2", None)],
                              "wh_id string, load_id string, order_number string, carrier string")
    r = {x.load_id: x.will_call for x in C.load_carrier_class(o).collect()}
    assert r == {"L1": 1, "L2": 0}


def test_k7_not_like_or_is_true_unless_all_marks(spark):
    h = spark.createDataFrame(
        [("WC-CC-UP", "C1", "2001-01-01", "a", "c", "s", "z", 5, "X"),
         ("WC-1", "C1", "2001-01-02", "a", "c", "s", "z", 7, "X")],
        "load_id string, customer_code string, shipment_date string, ship_to_addr1 string, "
        "ship_to_city string, ship_to_state string, ship_to_zip string, shipped_qty int, "
        "carrier string").withColumn("shipment_date", F.to_timestamp("shipment_date"))
    cands = spark.createDataFrame(
        [("W0", "L9", "O1", 1, "C1", "a", "c", "s", "z", 0)],
        "wh_id string, load_id string, order_number string, customer_id int, customer_code string, "
        "ship_to_addr1 string, ship_to_city string, ship_to_state string, ship_to_zip string, "
        "tote_count int")
    cust = spark.createDataFrame([("C1", "a", "c", "s", "z")],
                                 "customer_code string, customer_addr1 string, customer_city string, "
                                 "customer_state string, customer_zip string")
    r = O.fallback_tote_count(cands, h, cust).collect()
    # the load holding all three marks is skipped, so the latest usable day is 01-02
    assert r[0].tote_count == 7


def test_k9_null_uom_line_is_in_neither_arm(spark):
    lines = spark.createDataFrame(
        [("W0", "L1", "O1", "1", "H1", 0, 3, "G1")],
        "wh_id string, load_id string, order_number string, line_number string, hu_id string, "
        "gs1_required_flag int, quantity int, gln string")
    od = spark.createDataFrame([("W0", "O1", "1", "P1", None, 3)],
                               "wh_id string, order_number string, line_number string, "
                               "item_number string, order_uom string, qty int")
    items = spark.createDataFrame([("W0", "P1", "CIG", "d", 0)],
                                  "wh_id string, item_number string, class_id string, "
                                  "description string, net_weight_barcode int")
    upcs = spark.createDataFrame([("W0", "P1", "CS", "1234567890123", None)],
                                 "wh_id string, item_number string, uom string, upc string, "
                                 "modified_datetime timestamp")
    assert O.gs1_order_lines(lines, od, items, upcs).count() == 0
    assert O.standard_order_lines(lines, od, items, upcs).count() == 0
    # with a unit of measure the line is in one arm
    named = od.withColumn("order_uom", F.lit("CS"))
    assert O.gs1_order_lines(lines, named, items, upcs).count() == 1
    assert O.standard_order_lines(lines, named, items, upcs).count() == 0


def _events(spark, nodes):
    wf = "".join(f'<stopWorkflowData name="{n}">{v}</stopWorkflowData>' for n, v in nodes)
    xml = (f"<orderStatusSummaryEvent><orderStatusDetail><visit><service>{wf}</service></visit>"
           f"</orderStatusDetail></orderStatusSummaryEvent>")
    q = spark.createDataFrame([(1, xml)], "unique_id long, xml_response string")
    return I.parse_events(q, stage_result=False)


def test_two_position_rule_and_k18(spark):
    ev = _events(spark, [("Notes", "x"), ("Actual Qty", "4"), ("Actual Cig Count", "2"),
                         ("Actual Snuff Count", "n/a")])
    r = I.workflow_counts(ev).collect()[0]
    assert (r.tote_count, r.cig_count, r.snuff_count, r.parse_error) == (4, 2, None, True)


def test_malformed_document_is_an_error(spark):
    q = spark.createDataFrame([(1, "<orderStatusSummaryEvent><trigger>")],
                              "unique_id long, xml_response string")
    r = I.event_result(I.parse_events(q, stage_result=False)).collect()[0]
    assert r.error_msg == I.MALFORMED


def test_prior_load_skips_the_current_load(spark):
    orders = spark.createDataFrame(
        [("W0", "L1", "a", "c", "s", "z", "STD", "HRT"), ("W0", "L2", "a", "c", "s", "z", "STD", "HRT")],
        "wh_id string, load_id string, ship_to_addr1 string, ship_to_city string, "
        "ship_to_state string, ship_to_zip string, order_type string, carrier string")
    loads = spark.createDataFrame([("W0", "L1", "2001-01-01"), ("W0", "L2", "2001-02-01")],
                                  "wh_id string, load_id string, created_date string")
    cands = spark.createDataFrame([("W0", "L2", "a", "c", "s", "z"), ("W0", "L1", "a", "c", "s", "z")],
                                  "wh_id string, load_id string, ship_to_addr1 string, "
                                  "ship_to_city string, ship_to_state string, ship_to_zip string")
    r = {x.load_id: x.prior_load_id for x in O.prior_load(cands, orders, loads).collect()}
    assert r == {"L2": "L1", "L1": "L2"}


_AD = "ship_to_addr1 string, ship_to_city string, ship_to_state string, ship_to_zip string"


def test_f5_prior_count_of_own_and_address_units(spark):
    a, b = ("a", "c", "s", "z"), ("b", "c", "s", "z")
    cands = spark.createDataFrame(
        [("W0", "L9", "1", 1, *a, "L1"), ("W0", "L9", "2", 2, *a, "L1"), ("W0", "L9", "3", 3, *b, "")],
        f"wh_id string, load_id string, order_number string, customer_id int, {_AD}, prior_load_id string")
    units = spark.createDataFrame(
        [("W0", "L1", 1, *a, "h1"), ("W0", "L1", 1, *a, "h1"), ("W0", "L1", 1, *b, "h1"), ("W0", "L1", 1, *b, "h2"),
         ("W0", "L1", 5, *a, "h3"), ("W0", "L1", 5, *a, None), ("W0", "L1", 1, *b, None)],
        f"wh_id string, load_id string, customer_id int, {_AD}, hu_id string")
    got = {r.order_number: r.tote_count for r in O.prior_tote_count(cands, units).collect()}
    # order 1: h1, h3 and the unit without an id at its address, h2 of its customer elsewhere
    assert got == {"1": 4, "2": 3, "3": 0}


def test_f5_address_history_is_summed_once_per_address(spark):
    a = ("a", "c", "s", "z")
    cands = spark.createDataFrame(
        [("W0", "L9", str(i), i, *a, f"C{i}", 0) for i in range(40)] + [("W0", "L9", "x", 99, "q", "c", "s", "z", "C7", 0)],
        f"wh_id string, load_id string, order_number string, customer_id int, {_AD}, customer_code string, tote_count int")
    customers = spark.createDataFrame([(f"C{i}", *a) for i in range(40)], "customer_code string, customer_addr1 string, "
                                      "customer_city string, customer_state string, customer_zip string")
    kept = spark.createDataFrame(
        [(f"C{i}", "2001-08-0" + str(1 + i % 2), *a, 1) for i in range(40)] + [("C7", "2001-08-02", "A", "c", "s", "z", 3)],
        "customer_code string, ship_date string, cs_ship_to_addr1 string, cs_ship_to_city string, "
        "cs_ship_to_state string, cs_ship_to_zip string, shipped_qty bigint").withColumn("ship_date", F.to_date("ship_date"))
    out = O.fallback_tote_count(cands, None, customers, "2001-09-01 00:00:00", kept)
    got = {r.order_number: r.tote_count for r in out.collect()}
    # the newest day is the 2nd; its smallest address is C7's "A"
    assert set(got.values()) == {3} and len(got) == 41
    # no join makes a row per candidate and customer of its address: candidates meet one row per address
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by(struct" in plan.replace("named_struct", "struct")
