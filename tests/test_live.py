"""Jobs on live tables: they touch only the partitions concerned, and a job
that breaks anywhere and is run again leaves the tables of one run."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from dockyard.functions.columns import AS_OF
from dockyard.plans import live_jobs as J
from dockyard.plans.confirm import ConfirmInputs, ConfirmRun
from dockyard.sources import live as L
from dockyard.sources.fixtures import Fixtures, materialise
from tests.conftest import SF_SMALL

BUCKETS = 3
REFERENCE = {"wh_control": "f_wh_control", "employees": "f_employee", "item_master": "f_item", "uoms": "f_item_uom", "customers": "f_customer"}
LOGS = ["confirm_rejections", "shipment_master", "hu_master_shipped", "stored_item_shipped", "tran_log", "pod_shipments"]


LOADS = 8


@pytest.fixture(scope="module")
def fx(spark):
    """The warehouse tables of a few loads, among them one with units of another load's orders."""
    d = tempfile.mkdtemp(prefix="dockyard-live-")
    names = ["f_confirm_request", "f_order", "f_pick", "f_pick_master", "f_hu", "f_load", "f_load_queue"]
    materialise(spark, SF_SMALL, f"{d}/all", [*names, "f_stored_shipped", "f_shipment", *REFERENCE.values()])
    whole = Fixtures(spark, SF_SMALL, f"{d}/all")
    ok = ConfirmRun(ConfirmInputs.from_fixtures(whole), AS_OF).accepted.select("load_id").distinct()
    cross = (whole.f_hu.filter("type = 'LO'").join(ok, "load_id").join(
        whole.f_order.select(F.col("order_number").alias("control_number"), F.col("load_id").alias("own")), "control_number")
        .filter("own <> load_id").orderBy("load_id", "own").first())
    keep = {cross.load_id, cross.own, *(r.load_id for r in whole.f_load.orderBy(F.desc("load_id")).limit(LOADS).collect()),
            ok.agg(F.max("load_id")).first()[0]}
    for name in names:
        whole[name].filter(F.col("load_id").isin(sorted(keep))).coalesce(1).write.parquet(f"{d}/some/{name}.parquet")
    for name in ("f_stored_shipped", "f_shipment", *REFERENCE.values()):
        whole[name].coalesce(1).write.parquet(f"{d}/some/{name}.parquet")
    return Fixtures(spark, SF_SMALL, f"{d}/some")


def requests(fx):
    """Two loads that pass the checks: one with units of another load's order, and the last."""
    ok = ConfirmRun(ConfirmInputs.from_fixtures(fx), AS_OF).accepted.select("load_id").distinct()
    ids = [r[0] for r in ok.orderBy("load_id").collect()]
    return fx.f_confirm_request.filter(F.col("load_id").isin(ids[0], ids[-1]))


@pytest.fixture(scope="module")
def root(spark, fx):
    """Tables as they are before the job; copied by each test."""
    root = tempfile.mkdtemp(prefix="dockyard-live-")
    J.create_confirm_tables(L.Live(spark, root, J.LAYOUTS), ConfirmInputs.from_fixtures(fx), BUCKETS)
    return root


def copy(root):
    import shutil
    new = tempfile.mkdtemp(prefix="dockyard-live-")
    shutil.copytree(root, new, dirs_exist_ok=True)
    return new


def confirm(spark, fx, root, run_id="r1"):
    live = L.Live(spark, root, J.LAYOUTS)
    return J.confirm_loads(live, requests(fx), BUCKETS, AS_OF, run_id, **{k: fx[v] for k, v in REFERENCE.items()})


def files(root, table):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/live/{table}/**/*.parquet", recursive=True)}


def state(spark, root):
    live = L.Live(spark, root, J.LAYOUTS)
    out = {t: sorted(map(str, live.read(t).collect())) for t in J.LAYOUTS}
    return out | {t: sorted(map(str, df.collect())) if (df := live.read_log(t)) is not None else None for t in LOGS}


@pytest.fixture(scope="module")
def done(spark, fx, root):
    new = copy(root)
    assert confirm(spark, fx, new)
    return new


def test_a_confirm_run_gives_the_whole_table_result(spark, fx, done):
    t = ConfirmInputs.from_fixtures(fx)
    t.requests = requests(fx)
    r = ConfirmRun(t, AS_OF)
    live = L.Live(spark, done, J.LAYOUTS)
    assert r.accepted.count() == 2 and live.read_log("hu_master_shipped").count() > 0
    units = fx.f_hu.select("hu_id", "wh_id", "load_id")
    for table, want in (("load_master", r.loads_cross), ("pick_detail", r.picks_closed), ("pick_master", r.pick_masters_closed),
                        ("order", r.orders_toted), ("hu_master", r.hus_left),
                        ("stored_item", r.items_left.join(units, ["hu_id", "wh_id"]))):
        got = live.read(table).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), table
    for table, want in (("hu_master_shipped", r.hus_archived), ("stored_item_shipped", r.items_archived), ("tran_log", r.audit),
                        ("pod_shipments", r.counted)):
        got = live.read_log(table).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), table
    new = live.read("load_queue").join(fx.f_load_queue, ["wh_id", "load_id"], "left_anti")
    want = r.enqueue_wc.unionByName(r.enqueue_std)
    assert sorted(map(tuple, new.select("wh_id", "load_id", "queue_status").collect())) == sorted(
        map(tuple, want.select("wh_id", "load_id", "queue_status").collect()))
    ids = [r.unique_id for r in live.read("load_queue").collect()]
    assert len(ids) == len(set(ids))


def test_files_of_all_other_days_stay(spark, fx, root, done):
    """Every partition whose rows are the same has the same files; the job has changed few."""
    days = {str(r[0]) for r in requests(fx).join(fx.f_load, ["wh_id", "load_id"]).select(F.to_date("earliest_ship_date")).collect()}
    was, now = (L.Live(spark, r, J.LAYOUTS) for r in (root, done))
    for table in J.LAYOUTS:
        before = {f.removeprefix(root) for f in files(root, table)}
        after = {f.removeprefix(done) for f in files(done, table)}
        touched = {f.split("ship_day=")[1].split("/")[0] for f in before ^ after}
        old, new = was.read(table), now.read(table)
        # an order that the two loads' units carry may close, and then its load, on another day
        changed = {str(r.ship_day) for r in new.exceptAll(old).unionByName(old.exceptAll(new)).select("ship_day").collect()}
        assert touched == changed and (touched <= days or table in ("order", "load_master")), table
        assert len(before - after) < len(before) / 2, table


def test_a_broken_job_leaves_the_tables_of_one_run(spark, fx, root, done, monkeypatch):
    want, start = state(spark, done), state(spark, root)
    assert want != start
    writes = {"n": 0, "stop": None}

    class Broken(Exception):
        pass

    def counted(f):
        def g(*a, **b):
            out = f(*a, **b)
            writes["n"] += 1
            if writes["n"] == writes["stop"]:
                raise Broken
            return out
        return g

    for owner, name in ((L.Run, "append"), (L.Run, "replace"), (L.Live, "_write"), (L.Live, "_mark"), (L, "append"), (L, "delete")):
        monkeypatch.setattr(owner, name, counted(getattr(owner, name)))
    clean = copy(root)
    confirm(spark, fx, clean)
    total = writes["n"]
    assert state(spark, clean) == want
    # after each write of the run's own folder, each marker and each step of the copying
    for stop in (total - 22, total - 8):
        here = copy(root)
        writes.update(n=0, stop=stop)
        with pytest.raises(Broken):
            confirm(spark, fx, here)
        writes["stop"] = None
        seen = state(spark, here)
        assert seen in (start, want), stop  # a reader sees the run whole or not at all
        confirm(spark, fx, here)
        assert state(spark, here) == want, stop
        assert not confirm(spark, fx, here) and state(spark, here) == want


def test_partition_names(spark):
    root = tempfile.mkdtemp(prefix="dockyard-live-")
    live = L.Live(spark, root, {"t": ["a", "b"]})
    rows = [("x/y", 1, 1), ("01", 1, 2), (None, 2, 3), ("a=b c%", None, 4), ("-", 5, 5)]
    live.create("t", spark.createDataFrame(rows, "a string, b int, x int"))
    assert sorted(map(str, map(tuple, live.read("t").select("a", "b", "x").collect()))) == sorted(map(str, rows))

    def empty(run):
        old = live.read("t")
        run.replace("t", old, old.filter("x = 2"))

    assert live.run("1", empty)
    assert [tuple(r) for r in live.read("t").select("a", "b", "x").collect()] == [("01", 1, 2)]
    assert len(files(root, "t")) == 1
