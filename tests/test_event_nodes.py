"""Hand-made event and reply documents: repeated nodes, results at any depth, the root, control rows."""

import pytest

from dockyard.operators import inbound as I
from dockyard.operators import replies as R
from dockyard.operators import returns as RT

EVENT = """<i:orderStatusSummaryEvent xmlns:i="urn:x"><i:trigger type="OTA"><i:centerNumber>901</i:centerNumber></i:trigger>
<i:orderStatusSummary><i:status>fulfilled</i:status><i:status>other</i:status><i:orderNumber>PO7</i:orderNumber>
<i:serviceSummary><i:serviceSummaryEntry><i:purposeNumber>Backhaul</i:purposeNumber></i:serviceSummaryEntry>
<i:serviceSummaryEntry><i:purposeNumber>Delivery</i:purposeNumber></i:serviceSummaryEntry></i:serviceSummary>
<i:orderItemStatusGroup><i:orderItemStatusSummary><i:lineNumber>1</i:lineNumber></i:orderItemStatusSummary>
<i:orderItemStatusSummary><i:lineNumber>2</i:lineNumber></i:orderItemStatusSummary></i:orderItemStatusGroup>
<i:orderItemStatusGroup><i:orderItemStatusSummary><i:lineNumber>3</i:lineNumber></i:orderItemStatusSummary></i:orderItemStatusGroup>
</i:orderStatusSummary><i:orderStatusDetail>
<i:visit><i:service><i:actualStart>a</i:actualStart><i:stopWorkflowData name="Actual Qty">4</i:stopWorkflowData>
<i:receipt lineNumber="1"><i:palletNumber>H1</i:palletNumber></i:receipt></i:service></i:visit>
<i:visit><i:service><i:actualStart>b</i:actualStart><i:stopWorkflowData name="Actual Cig Count">6</i:stopWorkflowData>
<i:receipt lineNumber="2"><i:palletNumber>H2</i:palletNumber></i:receipt>
<i:receipt lineNumber="3"><i:palletNumber>H3</i:palletNumber></i:receipt></i:service></i:visit>
</i:orderStatusDetail></i:orderStatusSummaryEvent>"""
NESTED = "<r><body><result><resultType>failure</resultType><errorCode>E1</errorCode><message>no</message></result></body></r>"


@pytest.fixture(scope="module")
def events(spark):
    rows = [(1, EVENT), (2, EVENT.replace("orderStatusSummaryEvent", "anotherEvent")), (3, NESTED), (4, "<a><b>"), (5, None)]
    return I.parse_events(spark.createDataFrame(rows, "unique_id long, xml_response string"))


def test_all_groups_visits_and_services_count(events):
    one = events.filter("unique_id = 1")
    assert {(r.line_number, r.container_id) for r in I.event_items(one).collect()} == {("1", "H1"), ("2", "H2"), ("3", "H3")}
    c = I.workflow_counts(one).head()
    assert (c.tote_count, c.cig_count) == (4, 6)
    h = I.event_header(one).head()
    assert (h.status, h.purpose_number, h.actual_start_time) == ("fulfilled", "Backhaul", "a")


def test_only_events_under_their_root_are_delivered(events):
    assert [r.unique_id for r in I.deliverable_events(events).collect()] == [1]


def test_a_result_at_any_depth_is_read(spark, events):
    got = {r.unique_id: r.error_msg for r in I.event_result(events).collect()}
    assert got[3] == "E1:no" and got[1] is None and got[4] == I.MALFORMED
    replies = spark.createDataFrame([(1, NESTED, 5, 1), (2, NESTED.replace("failure", "ok"), 5, 1), (3, "<r/>", 5, 1)],
                                    "unique_id long, response_xml string, ms_elapsed int, attempts int")
    assert {r.unique_id: r.error_msg for r in R.reply_result(replies).collect()} == {1: "E1:no", 2: None, 3: None}


@pytest.mark.parametrize("control,n", [([("POD_SIGN_FLAG", "1")], 1), ([("POD_SIGN_FLAG", "0")], 0), ([], 0)])
def test_backhaul_status_and_signature_control(spark, events, control, n):
    whse = spark.createDataFrame([("901", "W1")], "pod_whse string, wh_id string")
    header = I.resolve_warehouse(I.event_header(events.filter("unique_id = 1")), whse)
    none = spark.createDataFrame([], "wh_id string, order_number string, product_type string, uom_qty int, unique_id long")
    out = I.delivery_header(header, I.workflow_counts(events), I.expected_counts(header, none), none,
                            spark.createDataFrame(control, "control_type string, c1 string")).collect()
    assert [r.order_status for r in out] == ["COMPLETE"] * n


def test_return_numbers_go_on_and_are_not_cut(spark):
    items = spark.sql("""SELECT 7L AS unique_id, named_struct('lineNumber', array('L1'), 'acceptedQuantity', array('1'),
        'expectedQuantity', array('1'), 'createdOnClient', array(named_struct('reason', array(named_struct('reasonCode', array('SHORT'),
        'reasonDescription', array('x'))))), 'purposeNumber', array('18'), 'adjustment', array(named_struct('adjustQuantity', array('-2'),
        'reason', array(named_struct('reasonCode', array('SHORT'), 'reasonDescription', array('x')))))) AS it""")
    header = spark.createDataFrame([(7, "W1", "o1", "c", "n")], "unique_id long, wh_id string, order_number string, customer_code string, customer_name string")
    out = RT.return_intake(
        items, header, spark.createDataFrame([("SHORT", "RETURNS")], "reason_id string, type string"),
        spark.createDataFrame([], "wh_id string, item_number string, uom string, upc string"),
        spark.createDataFrame([("W1", "I1")], "wh_id string, item_number string"),
        spark.createDataFrame([("RTN12345677", "W1")], "rma_number string, wh_id string"),
        spark.createDataFrame([("W1", "o1", "H", "L1", "I1", "EA")],
                              "wh_id string, order_number string, container_id string, line_number string, item_number string, uom string"))
    assert [r.rma_number for r in out.collect()] == ["RTN12345678"]
