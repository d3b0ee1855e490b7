"""XML files as a source, ordered message files, and the load queue as a stream."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from dockyard.functions.columns import AS_OF
from dockyard.operators import inbound as I
from dockyard.plans import live_jobs as J
from dockyard.plans.outbound import OutboundInputs, OutboundRun
from dockyard.sources.fixtures import Fixtures, materialise
from dockyard.sources.live import Live
from dockyard.sources.sinks import append_ordered, manifest
from dockyard.sources.xml_files import read_import_files, stream_import_files
from dockyard.streaming.outbound import start_outbound_stream
from tests.conftest import SF_SMALL

EVENT = ('<orderStatusSummaryEvent><trigger type="OTA"><centerNumber>900</centerNumber></trigger><orderStatusSummary>'
         "<orderNumber>{}</orderNumber><status>a &amp; b</status></orderStatusSummary></orderStatusSummaryEvent>")
ROWS = [(1, "N", EVENT.format("o1")), (2, "C", EVENT.format("o2")), (3, "N", "<error><message>no</message></error>"),
        (4, "N", "<orderStatusSummaryEvent><trigger></orderStatusSummaryEvent>"),
        (5, "N", '<x:orderStatusSummaryEvent xmlns:x="u"><result><resultType>failure</resultType><errorCode>E1</errorCode>'
                 "<message>bad</message></result></x:orderStatusSummaryEvent>"), (6, "N", EVENT.format("o6"))]


def _file(path, rows):
    with open(path, "w") as f:
        f.write("<imports>\n" + "\n".join(f'<import uniqueId="{i}" status="{s}"><document>{x}</document></import>' for i, s, x in rows) + "\n</imports>")


def test_xml_files_give_the_events_of_the_column_source(spark):
    d = tempfile.mkdtemp(prefix="dockyard-xml-")
    _file(f"{d}/a.xml", ROWS[:4])
    _file(f"{d}/b.xml", ROWS[4:])
    column = spark.createDataFrame(ROWS, "unique_id long, status string, xml_response string")

    def events(queue):
        ev = I.parse_events(I.pending_imports(queue))
        found = ev.select("unique_id", "root", "malformed", "result", I._error().alias("error"), *I.header_columns())
        return sorted(map(str, found.collect()))

    want = events(column)
    assert events(read_import_files(spark, d)) == want and len(want) == 5 and sum("malformed=True" in r for r in want) == 1
    out = tempfile.mkdtemp(prefix="dockyard-xml-") + "/out"
    q = (stream_import_files(spark, d, max_files_per_trigger=1).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert events(spark.read.parquet(out)) == want


def test_ordered_files(spark):
    out = tempfile.mkdtemp(prefix="dockyard-ordered-") + "/t"
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("unique_id"), F.col("id").alias("x")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for _ in range(2):
            append_ordered(rows, out, "r1", "unique_id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = manifest(spark, out, "r1").collect()
    assert len(files) > 1 and all(a["last"] < b["first"] for a, b in zip(files, files[1:]))
    import pyarrow.parquet as pq
    seen = [i for f in files for i in pq.read_table(f"{out}/run_id=r1/{f.file_name}")["unique_id"].to_pylist()]
    assert seen == sorted(r.unique_id for r in rows.collect()) and sum(f.n_rows for f in files) == len(seen)
    assert spark.read.parquet(out).count() == 5000
    append_ordered(rows.limit(0), out, "r2", "unique_id")
    assert manifest(spark, out, "r2").count() == 0


@pytest.fixture(scope="module")
def fx(spark):
    """Few pending loads of two halves of the queue, without shared purchase orders."""
    d = tempfile.mkdtemp(prefix="dockyard-outstream-")
    whole = Fixtures(spark, SF_SMALL)
    materialise(spark, SF_SMALL, d)
    fx = Fixtures(spark, SF_SMALL, d)
    run = OutboundRun(OutboundInputs.from_fixtures(fx), AS_OF)
    with_po = [r.load_id for r in run.po.select("load_id").distinct().orderBy("load_id").limit(2).collect()]
    other = [r.load_id for r in run.returns.select("load_id").distinct().orderBy("load_id").limit(6).collect()]
    assert whole is not fx and with_po and other
    return fx, fx.f_load_queue.filter(F.col("load_id").isin(with_po + other)), d


def test_two_batches_give_the_ids_and_rows_of_one_run(spark, fx):
    fx, queue, d = fx
    queue = queue.select(F.col("unique_id").cast("bigint"), "wh_id", "load_id", F.col("queue_status").cast("int"), F.col("preship_scan_gs1").cast("int"))
    ids = sorted(r.unique_id for r in queue.collect())
    cut = ids[len(ids) // 2]
    src, out = tempfile.mkdtemp(prefix="dockyard-src-"), tempfile.mkdtemp(prefix="dockyard-out-") + "/o"
    queue.filter(F.col("unique_id") < cut).coalesce(1).write.parquet(f"{src}/part=0")
    queue.filter(F.col("unique_id") >= cut).coalesce(1).write.parquet(f"{src}/part=1")
    t = OutboundInputs.from_fixtures(fx)
    start = fx.f_message.agg(F.max("unique_id")).first()[0]
    tables = {n: t._makers[n] for n in t._makers if n not in ("queue", "message_queue")}
    start_outbound_stream(spark, f"{src}/*", tables, out, f"{out}/ckpt", start=start, as_of=AS_OF, max_files_per_trigger=1).awaitTermination(900)
    t = OutboundInputs.from_fixtures(fx)
    t._makers["queue"] = lambda: queue
    run = OutboundRun(t, AS_OF)
    got = spark.read.parquet(f"{out}/message_queue")
    assert got.select("run_id").distinct().count() == 2 and len(os.listdir(f"{out}/ids")) >= 2
    want = run.queue_rows
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    totes = run.tote_log
    assert sorted(map(str, spark.read.parquet(f"{out}/customer_totes").select(*totes.columns).collect())) == sorted(map(str, totes.collect()))


def test_sending_on_live_tables_touches_only_its_partitions(spark, fx):
    fx, queue, _ = fx
    # the chosen loads are due, all others are done
    ids = [r.unique_id for r in queue.collect()]
    t = OutboundInputs.from_fixtures(fx)
    whole = fx.f_load_queue.withColumn("queue_status", F.when(F.col("unique_id").isin(ids), F.col("queue_status")).otherwise(2))
    whole = whole.filter(F.col("unique_id").isin(ids) | (F.col("unique_id") % 20 == 1))
    t._makers["queue"] = lambda: whole
    root = tempfile.mkdtemp(prefix="dockyard-send-")
    live = Live(spark, root, J.SEND_LAYOUTS)
    J.create_send_tables(live, t, 2)
    tables = {n: f for n, f in t._makers.items() if n not in ("queue", "pos", "backhauls")}

    def files(table):
        return set(glob.glob(f"{root}/live/{table}/**/*.parquet", recursive=True))

    before, was = {x: files(x) for x in J.SEND_LAYOUTS}, {x: live.read(x).collect() for x in J.SEND_LAYOUTS}
    assert J.send_loads(live, tables, AS_OF, "r1") and not J.send_loads(live, tables, AS_OF, "r1")
    run = OutboundRun(t, AS_OF)
    pos, backhauls = run.po_state
    for table, want in (("load_queue", run.queue_done), ("po_master", pos), ("po_backhaul", backhauls)):
        now = live.read(table)
        assert sorted(map(str, now.select(*want.columns).collect())) == sorted(map(str, want.collect())), table
        changed = set(map(str, now.collect())) ^ set(map(str, was[table]))
        assert bool(changed) == bool(before[table] ^ files(table)) and len(before[table] - files(table)) < len(before[table]) / 2 + 1, table
    got = live.read_log("message_queue")
    assert sorted(map(str, got.select(*run.queue_rows.columns).collect())) == sorted(map(str, run.queue_rows.collect()))
