"""Fields of event documents: what is flattened, and which texts are searched with an expression."""

from pyspark.sql import functions as F

from dockyard.operators import inbound as I
from dockyard.operators import replies as R
from dockyard.sources.documents import _flat

ITEM = """<orderStatusSummaryEvent><orderStatusSummary><orderItemStatusGroup><orderItemStatusSummary><lineNumber>1</lineNumber>
<lineNumber>9</lineNumber><adjustment><adjustQuantity>-2</adjustQuantity><reason><reasonCode>A</reasonCode></reason></adjustment>
<adjustment><adjustQuantity>-3</adjustQuantity></adjustment></orderItemStatusSummary></orderItemStatusGroup></orderStatusSummary>
<orderStatusDetail><visit><service><receipt lineNumber="1"><palletNumber>H1</palletNumber><palletNumber>H2</palletNumber></receipt>
<receipt lineNumber="1"/></service></visit></orderStatusDetail></orderStatusSummaryEvent>"""


def test_f16_f20_fields_of_a_single_node_are_not_flattened(spark):
    ev = I.parse_events(spark.createDataFrame([(1, ITEM)], "unique_id long, xml_response string"))
    items = I.event_items(ev)
    got = {(r.container_id, r.line_number, r.adjusted_qty, r.reason_code, r.item_status) for r in items.collect()}
    assert got == {("H1", "1", -2, "A", None), (None, "1", -2, "A", None)}
    plan = items._jdf.queryExecution().optimizedPlan().toString()
    assert "array(it#" not in plan and "array(rc#" not in plan


def test_f17_only_texts_with_the_word_are_searched(spark):
    rows = [(1, "<a><b>x</b></a>"), (2, None), (3, "<a><b>result</b></a>"),
            (4, "<r><x><result><message>m</message></result></x></r>"), (5, "<a/>result")]
    df = spark.createDataFrame(rows, "id int, x string")
    none = F.lit(None).cast("struct<resultType: string, errorCode: string, message: string>")
    out = df.select("id", R.result_node("x", none, F.lit(False)).alias("r"))
    assert {r.id: r.r and r.r.message for r in out.collect() if r.id != 2} == {1: None, 3: None, 4: "m", 5: None}
    assert "contains(x" in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_f16_white_space_between_tags(spark):
    texts = ["<a>\n<b>x</b>\n</a>", "<a>\n  <b>\n \n</b><c> \n</c>\n\n</a>", "<a>x &gt;\n</a>", None, "<a>\n</a>"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    want = df.select(F.regexp_replace("x", r">\n\s*<", "><")).collect()
    assert df.select(_flat(F.col("x"))).collect() == want
