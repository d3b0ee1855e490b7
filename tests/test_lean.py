"""Shuffles of tables written between steps, and views that Spark makes by a plan of its own."""

import datetime as dt
import time

from pyspark.sql import functions as F

from dockyard.functions.keys import stage
from dockyard.session import CLEANUP, shuffles_dropped
from dockyard.sources import fixtures, lean


def _files(spark):
    return {f.getName() for f in _each(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles())}


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]


def _shuffled(spark):
    x = spark.range(20000).withColumn("v", F.hash("id"))
    return x.join(x.groupBy("v").agg(F.count("*").alias("n")).hint("merge"), "v")


def test_f5_shuffles_of_a_staged_table_go_when_it_is_written(spark):
    before, had = _files(spark), spark.conf.get(CLEANUP, None)
    out = stage(_shuffled(spark))
    for _ in range(50):  # the session is told, not waited for
        left = {f for f in _files(spark) - before if f.startswith("shuffle_")}
        if not left:
            break
        time.sleep(0.2)
    assert not left and spark.conf.get(CLEANUP, None) == had
    assert out.count() == 20000


def test_f5_the_setting_is_put_back_by_the_last_of_several_writes(spark):
    had = spark.conf.get(CLEANUP, None)
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP, None) == had


def _tables(spark):
    """Orders of one number in two warehouses, repeated and null keys, and a unit that is whole only with its repeated item."""
    day = dt.datetime(2001, 1, 2)
    pick = [("W0", "L1", "1", "P1", "1.P1", "1/1.P1", "H1", "TOTE", "CS", "TOTE1", "DRY", 1),
            ("W0", "L1", "1", "P1", "1.P1", "1/1.P1", "H1", "TOTE", "CS", "TOTE1", "DRY", 1),
            ("W0", "L1", "1", "P2", "2.P2", "1/2.P2", "H2", "OTP", "CS", None, None, 3),
            ("W1", "L2", "1", "P1", "1.P1", "1/9.P1", "H3", "TOTE", "EA", None, "DRY", 2),
            ("W1", "L2", "2", "P1", "1.P1", "2/1.P1", "H4", "PALLET", "EA", None, "DRY", 2),
            ("W1", "L2", "3", "P1", "1.P1", None, "H5", "TOTE", "EA", None, "DRY", 2),
            ("W0", None, "4", "P1", "1.P1", "4/1.P1", "H6", "TOTE", "EA", None, "DRY", 2),
            ("W0", "L1", "5", "P1", "1.P1", "5/1.P1", "H7", "TOTE", "EA", None, "DRY", 0)]
    cols = ("wh_id string, load_id string, order_number string, item_number string, line_number string, pick_id string, container_id string, "
            "container_type string, uom string, cartonization_batch_id string, pick_area string, picked_quantity int")
    order = [("1", "W0", 1, 1, 1), ("1", "W0", 1, 1, 1), ("1", "W0", 2, 4, None), ("1", "W1", 1, 2, 1), ("2", "W1", 1, 1, 1), ("3", "W1", 1, 1, 1),
             ("4", "W0", 1, 1, 1), ("5", "W0", 1, 1, 1), ("1", None, 1, 1, 1), ("1", "W0", 3, 1, 1)]
    p = spark.createDataFrame(pick, cols)
    return {
        "f_pick": p,
        "f_item": spark.createDataFrame([("W0", "P1", "a", "CIG", 1)] * 3 + [("W0", "P1", "b", "CIG", 1), ("W1", "P1", None, None, None), ("W0", "P2", "c", "x", 0)],
                                        "wh_id string, item_number string, description string, class_id string, gs1_required_flag int"),
        "f_item_uom": spark.createDataFrame([("W0", "P1", "CS", 20), ("W0", "P1", "EA", 1), ("W1", "P1", "EA", 1), ("W0", "P2", "CS", 2)],
                                            "wh_id string, item_number string, uom string, conversion_factor int"),
        "f_order": spark.createDataFrame([(n, w, c, s, t, "a", "c", "s", None, "HRT") for n, w, c, s, t in order],
                                         "order_number string, wh_id string, customer_id bigint, stop_id int, tote_count_flag int, ship_to_addr1 string, "
                                         "ship_to_city string, ship_to_state string, ship_to_zip string, carrier string"),
        "f_customer": spark.createDataFrame([(1, "C1", "G", 1, 1), (2, "C2", None, 0, 1), (2, "C2", "", 0, 1), (3, "C3", None, 0, 0)],
                                            "customer_id bigint, customer_code string, gln string, gs1_required_flag int, totes_required int"),
        "f_load": spark.createDataFrame([("W0", "L1", day), ("W1", "L2", None)], "wh_id string, load_id string, earliest_ship_date timestamp_ntz"),
        "f_container": spark.createDataFrame([("W0", "TOTE", 1), ("W0", "TOTE", 1), ("W1", "TOTE", 1), ("W0", "OTP", 1), ("W0", "PALLET", 0), ("W1", "PALLET", None)],
                                             "wh_id string, container_type string, shipping_container int"),
    }


def test_f13_history_has_the_rows_of_its_text(spark):
    t = _tables(spark)
    t["f_hu_shipped"] = spark.sql(fixtures.VIEWS["f_hu_shipped"], f_pick=t["f_pick"])
    assert sorted(lean.hu_shipped(t["f_pick"]).collect(), key=str) == sorted(t["f_hu_shipped"].collect(), key=str)
    t["f_stored_shipped"] = spark.sql(fixtures.VIEWS["f_stored_shipped"], f_pick=t["f_pick"])
    text = spark.sql(fixtures.VIEWS["f_container_history"], **{n: t[n] for n in fixtures.deps("f_container_history")})
    own = lean.container_history(**{n: t[n] for n in fixtures.deps("f_container_history")})
    rows = sorted(own.collect(), key=str)
    assert own.dtypes == text.dtypes and rows == sorted(text.collect(), key=str)
    assert {(r.wh_id, r.order_number, r.container_type) for r in rows} >= {("W0", "1", "TOTE"), ("W0", "1", "OTP"), ("W1", "1", "TOTE")}


def test_f13_lines_of_the_history_are_not_dealt_with_item_texts(spark):
    fx = fixtures.Fixtures(spark, "/root/testdata/sf0.001")
    plan = fx.f_container_history._jdf.queryExecution().sparkPlan().toString().splitlines()
    wide = [x for x in plan if "Aggregate(" in x and "hu_id" in x and ("description" in x or "class_id" in x)]
    assert not wide
