"""The streaming import gives the batch result; replayed batches and repeated
events add nothing, also where a business key is missing."""

import tempfile

from pyspark.sql import functions as F

from dockyard.functions.columns import AS_OF
from dockyard.plans.inbound import InboundInputs, InboundRun
from dockyard.sources.fixtures import Fixtures
from dockyard.streaming.imports import TARGETS, batch_time, fixture_tables, import_batch, start_import_stream
from tests.conftest import SF_SMALL

TABLES = [*TARGETS, "po_received", "import_status"]


def _rows(spark, out, table):
    return sorted(map(str, spark.read.parquet(f"{out}/{table}").collect()))


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    fx = Fixtures(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="dockyard-stream-")
    out = f"{root}/out"
    queue = fx.d_import_queue.select("unique_id", "status", "xml_response")
    # an event without a warehouse: its key has a NULL part
    nowhere = queue.filter("unique_id = 5").select(
        F.lit(10**9).cast("long").alias("unique_id"), F.lit("N").alias("status"),
        F.regexp_replace("xml_response", "centerNumber>[0-9]+<", "centerNumber>none<").alias("xml_response"))
    queue = queue.unionByName(nowhere)
    queue.filter("unique_id % 2 = 0").coalesce(1).write.parquet(f"{root}/src/part=0")
    queue.filter("unique_id % 2 = 1").coalesce(1).write.parquet(f"{root}/src/part=1")
    # one file per micro-batch: the guards must also hold across batches
    q = start_import_stream(spark, f"{root}/src/*", fixture_tables(fx), out, f"{root}/ckpt", as_of=AS_OF,
                            max_files_per_trigger=1)
    q.awaitTermination(600)
    batch = InboundRun(InboundInputs.from_fixtures(fx))
    for table, attr in (("delivery_header", "pod_header"), ("tote_tracking", "totes")):
        own = spark.read.parquet(f"{out}/{table}").filter("import_id < 1000000000")
        want = getattr(batch, attr)
        assert {r[0] for r in own.select("order_number").collect()} == {r[0] for r in want.select("order_number").collect()}, table
        assert own.count() == want.count(), table
    before = {t: _rows(spark, out, t) for t in TABLES}
    assert any("import_id=1000000000" in r for r in before["delivery_header"])
    # the second micro-batch again, and then all events once more as a new batch
    odd = spark.read.parquet(f"{root}/src/part=0", f"{root}/src/part=1").filter("unique_id % 2 = 1")
    even = spark.read.parquet(f"{root}/src/part=0", f"{root}/src/part=1").filter("unique_id % 2 = 0")
    ids = {r["run_id"] for r in spark.read.parquet(f"{out}/import_status").filter("unique_id % 2 = 1").select("run_id").distinct().collect()}
    import_batch(spark, odd, fixture_tables(fx), out, ids.pop(), AS_OF)
    import_batch(spark, even.unionByName(odd), fixture_tables(fx), out, 77, AS_OF)
    assert {t: _rows(spark, out, t) for t in TABLES} == before


def test_a_batch_keeps_its_time(spark):
    out = tempfile.mkdtemp(prefix="dockyard-time-")
    assert batch_time(spark, out, 3) == batch_time(spark, out, 3)
