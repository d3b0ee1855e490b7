"""Bucketed line tables: same rows, and the history isn't shuffled."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from dockyard.functions.xml_nodes import message_nodes, message_text
from dockyard.operators import outbound as O
from dockyard.plans.outbound import OutboundInputs, OutboundRun
from dockyard.sources.bucketed import LAYOUT, append_bucketed, bucketed_inputs, buckets_of, write_bucketed
from dockyard.sources.fixtures import Fixtures, materialise
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    d = tempfile.mkdtemp(prefix="dockyard-bucketed-")
    materialise(spark, SF_SMALL, d)
    return OutboundInputs.from_fixtures(Fixtures(spark, SF_SMALL, d))


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _moved(df, column):
    """Whether rows of the scan that reads ``column`` reach an exchange before they are joined."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[\s:|+\-]*", x)[0]) for x in lines]
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and re.search(rf"\b{column}#", x))
    level = depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            level = depth[i]
            if "Exchange" in lines[i]:
                return True
            if "Join" in lines[i]:
                return False
    return False


def _lines(t):
    return O.shipped_lines(O.pending_loads(t.queue, t.loads), t.hus_shipped, t.stored_shipped, t.picks,
                           t.items, t.uoms, t.orders, t.customers)


def test_history_stays_where_it_is(spark, inputs, no_broadcast):
    t = inputs.replaced(**bucketed_inputs(inputs, 8, "stay", temporary=True))
    plain, bucketed = _lines(inputs), _lines(t)
    for column in ("actual_qty", "cartonization_batch_id", "tote_count_flag"):
        assert _moved(plain, column) and not _moved(bucketed, column), column
    assert sorted(map(str, plain.collect())) == sorted(map(str, bucketed.collect()))
    run = OutboundRun(t)
    assert not _moved(O.order_lines(run.lines, t.order_detail, t.items, t.upcs), "qty")


def test_buckets_grow_and_keep_null_keys(spark):
    kind = "pick_id string, n int"
    first = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("a", 4)], kind)
    path = tempfile.mkdtemp(prefix="dockyard-bucketed-")
    df = write_bucketed(first, "grown", ["pick_id"], 4, f"{path}/t")
    assert buckets_of(spark, "grown") == 4 and df.count() == 4
    assert append_bucketed(spark.createDataFrame([(None, 5), ("c", 6)], kind), "grown", ["pick_id"], 4).count() == 6
    per = spark.table("grown").select("pick_id", F.input_file_name().alias("f")).distinct()
    bucket = per.withColumn("b", F.regexp_extract("f", r"_(\d{5})\.", 1)).groupBy("pick_id").agg(F.countDistinct("b").alias("n"))
    assert {r.n for r in bucket.collect()} == {1}
    write_bucketed(first.limit(0), "grown", ["pick_id"], 4, f"{path}/t")
    assert spark.table("grown").count() == 0
    with pytest.raises(ValueError, match="no column line"):
        write_bucketed(first, "grown", ["pick_id", "line"], 4)
    assert set(LAYOUT) <= set(OutboundInputs.NAMES)


def test_nodes_hold_the_whole_text(spark):
    texts = ['<a x="1"><b>one</b><c>two</c><b/>tail</a>', "<a>x &lt; y</a>", "", None, "<a></a>"]
    df = spark.createDataFrame(list(enumerate(texts)), "message_id long, message_xml string")
    nodes = message_nodes(df)
    back = {r.message_id: r.message_xml for r in message_text(nodes).collect()}
    assert back == {i: t for i, t in enumerate(texts) if t}
    swapped = df.withColumn("message_xml", F.replace("message_xml", F.lit("<b>one</b><c>two</c>"), F.lit("<c>two</c><b>one</b>")))
    assert message_nodes(swapped).exceptAll(nodes).count() > 0


def test_swapped_elements_of_a_message_are_seen(spark, inputs):
    sent = OutboundRun(inputs).pallet_messages.select("message_id", "message_xml").limit(5).cache()
    nodes = set(map(tuple, message_nodes(sent).collect()))
    tags = ["palletNumber", "description", "purposeNumber", "barcode"]
    for a, b in zip(tags, tags[1:]):
        pair = rf"(<{a}[ >].*?</{a}>)(<{b}[ >].*?</{b}>)"
        other = sent.withColumn("message_xml", F.regexp_replace("message_xml", pair, "$2$1"))
        assert set(map(tuple, message_nodes(other).collect())) != nodes, (a, b)
    sent.unpersist()
