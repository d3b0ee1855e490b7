"""Bench: headline queries on local Spark; prints ONE JSON line.

Inputs: the driver's star schema at $BENCH_SF_DIR. The warehouse tables the
jobs read (the fixture views) are written to parquet once first (reported as
``prepare_sec``, not part of the metric), as they would exist on a cluster.
Each query is then run to completion through the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dockyard.plans.registry import queries  # noqa: E402
from dockyard.session import get_session  # noqa: E402
from dockyard.sources.fixtures import materialise  # noqa: E402

HEADLINE = [
    "counted_product_shipments",
    "confirmed_counted_shipments",
    "close_cross_load_loads",
    "purge_shipped",
    "shipped_lines",
    "fallback_tote_count",
    "backhaul_pos",
    "order_lines",
    "order_properties",
    "pallet_items",
    "message_queue_rows",
    "event_header",
    "delivery_detail",
    "message_status",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    scratch = tempfile.mkdtemp(prefix="dockyard-bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    t0 = time.time()
    materialise(spark, sf_dir, f"{scratch}/tables")
    prepare = time.time() - t0
    qs = queries()
    times = {}
    for name in HEADLINE:
        if name not in qs:
            continue
        t = time.time()
        qs[name](spark, sf_dir, f"{scratch}/tables").write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "prepare_sec": round(prepare, 3)}))


if __name__ == "__main__":
    main()
