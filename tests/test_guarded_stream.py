"""The guarded import stream: the rows of one batch run, whatever the batches,
failures and repeated events, without reading the report tables it writes."""

import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from dockyard.functions import keys
from dockyard.functions.columns import AS_OF
from dockyard.plans.inbound import InboundInputs, InboundRun
from dockyard.sources.fixtures import Fixtures, materialise
from dockyard.streaming import guarded as G
from dockyard.streaming.imports import fixture_tables
from tests.conftest import SF_SMALL

SEEDED = {"pod_header": "f_pod_header", "pod_detail": "f_pod_detail", "tote_tracking": "f_tote_tracking", "backhaul_log": "f_backhaul_log"}
TABLES = {"delivery_header": "pod_header", "delivery_detail": "detail", "tote_tracking": "totes", "backhaul_receipts": "backhauls",
          "po_received": "pos_received"}


@pytest.fixture(scope="module")
def given(spark):
    """Fixture tables on disk, and the import queue with an event of no known warehouse and one of no order."""
    root = tempfile.mkdtemp(prefix="dockyard-guarded-")
    names = ["f_whse", "f_pod_shipments", "f_customer", "f_customer_totes", "f_order", "f_po", "f_control", "f_pod_header",
             "f_pod_detail", "f_tote_tracking", "f_backhaul_log", "d_import_queue"]
    materialise(spark, SF_SMALL, f"{root}/tables", names)
    fx = Fixtures(spark, SF_SMALL, f"{root}/tables")
    queue = fx.d_import_queue.select("unique_id", "status", "xml_response")
    # an event that gives rows, once without a warehouse and once without an order
    one = InboundRun(InboundInputs.from_fixtures(fx), AS_OF).detail.agg(F.min("import_id")).first()[0]
    odd = [F.regexp_replace("xml_response", "centerNumber>[0-9]+<", "centerNumber>none<"),
           F.regexp_replace("xml_response", "<orderNumber>[^<]*</orderNumber>", "")]
    for n, xml in enumerate(odd):
        queue = queue.unionByName(fx.d_import_queue.filter(F.col("unique_id") == one).select(
            F.lit(10**9 + n).cast("long").alias("unique_id"), F.lit("N").alias("status"), xml.alias("xml_response")))
    queue.write.parquet(f"{root}/queue")
    return root, fx, spark.read.parquet(f"{root}/queue")


def _source(spark, queue, cuts):
    """A folder with a file of queue rows per cut, in order."""
    src = tempfile.mkdtemp(prefix="dockyard-src-")
    for n, cut in enumerate(cuts):
        queue.filter(cut).coalesce(1).write.parquet(f"{src}/part={n}")
    return f"{src}/*"


def _start(spark, root, fx, src, out, **more):
    return G.start_guarded_import(spark, src, fixture_tables(fx), out, f"{out}/ckpt", day=AS_OF[:10], as_of=AS_OF, max_files_per_trigger=1,
                                  seeds={t: f"{root}/tables/{v}.parquet" for t, v in SEEDED.items()}, **more)


def _rows(spark, out, table):
    return sorted(map(str, spark.read.parquet(f"{out}/{table}").drop("run_id").collect()))


def _all(spark, out):
    return {t: _rows(spark, out, t) for t in [*TABLES, "import_status"]}


@pytest.fixture(scope="module")
def streamed(spark, given):
    """Three batches by rising id, then every event once more; and the plans of the batches."""
    root, fx, queue = given
    third = queue.agg(F.max(F.when(F.col("unique_id") < 10**9, F.col("unique_id")))).first()[0] // 3
    src = _source(spark, queue, [F.col("unique_id") < third, F.col("unique_id").between(third, 2 * third),
                                 F.col("unique_id") > 2 * third, F.lit(True)])
    out, plans = tempfile.mkdtemp(prefix="dockyard-out-") + "/o", []
    stage, append = keys.stage, G.append

    def seen(f):
        def g(df, *a):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return f(df, *a)
        return g

    G.stage, G.append = seen(stage), seen(append)
    try:
        _start(spark, root, fx, src, out).awaitTermination(900)
    finally:
        G.stage, G.append = stage, append
    return src, out, plans


def test_three_batches_give_the_rows_of_one_run(spark, given, streamed):
    root, fx, queue = given
    t = InboundInputs.from_fixtures(fx)
    t._makers["queue"] = lambda: queue
    run = InboundRun(t, AS_OF)
    for table, attr in TABLES.items():
        want = getattr(run, attr)
        got = spark.read.parquet(f"{streamed[1]}/{table}").select(*want.columns)
        assert want.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, want.collect())), table
    want = run.queue_after.join(queue.filter("status = 'N'").select("unique_id"), "unique_id", "left_semi")
    got = spark.read.parquet(f"{streamed[1]}/import_status").select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_events_that_come_again_add_nothing(spark, streamed):
    last = spark.read.parquet(f"{streamed[1]}/import_status").agg(F.max(F.col("run_id").cast("int"))).first()[0]
    assert last < 3  # the fourth batch has no new event


def test_no_batch_reads_a_report_table(streamed):
    assert len(streamed[2]) > 20
    for name in (*TABLES, *SEEDED.values()):
        assert not any(f"/{name}" in p and "Scan" in p and f"/o/{name}" in p for p in streamed[2]), name
        assert not any(f"tables/{name}" in p for p in streamed[2][1:] if name in SEEDED.values()), name


def test_a_failed_batch_is_run_again_from_its_state(spark, given, streamed):
    root, fx, _ = given
    src, want, _ = streamed
    out, calls = tempfile.mkdtemp(prefix="dockyard-out-") + "/o", {"n": 0}
    append = G.append

    def broken(df, path, part):
        append(df, path, part)
        calls["n"] += 1
        if calls["n"] == 9:  # in the second batch, after some of its tables
            raise RuntimeError("lost")

    G.append = broken
    try:
        with pytest.raises(Exception, match="lost"):
            _start(spark, root, fx, src, out).awaitTermination(900)
        _start(spark, root, fx, src, out).awaitTermination(900)
    finally:
        G.append = append
    assert _all(spark, out) == _all(spark, want)


def test_guards_of_one_order():
    import pandas as pd

    class State:
        exists, get = False, ("{}",)

        def update(self, v):
            self.exists, self.get = True, v

    def rows(*given):
        base = {c.split()[0]: None for c in G._ROW.split(", ")}
        return pd.DataFrame([{**base, "payload": "p", **r} for r in given], columns=list(base))

    state = State()
    first = [rows({"unique_id": 9, "header": "W0", "detail": "W0"}, {"unique_id": 5, "header": "W1"}),
             rows({"unique_id": 7, "header": "W0"}, {"unique_id": None, "header": "W1"}, {"unique_id": 8, "header": G.OPEN})]
    got = pd.concat(G.first_wins(("o",), iter(first), state)).set_index("unique_id")
    assert {i: (bool(r.header), bool(r.detail), r.payload) for i, r in got.iterrows()} == {
        9: (False, True, "p"), 5: (False, False, None), 7: (True, False, "p"), 8: (True, False, "p")}
    again = pd.concat(G.first_wins(("o",), iter([rows({"unique_id": 1, "header": "W0", "tote": "W0"})]), state))
    assert [(r.header, r.detail, r.tote) for r in again.itertuples()] == [(False, False, True)]
