"""Session settings the library relies on.

Only ``get_session`` creates a session (tests, bench, CLI). Library code never
changes session state except to fill in a checkpoint dir when none is set, and
while it writes a table between steps (:func:`shuffles_dropped`).
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Whether the shuffle files of an execution go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
# sessions with a write under way: how many, and the setting before the first
_writing: dict[str, list] = {}

# Spark settings this library is tuned for (AQE re-plans joins and coalesces
# partitions at run time; skew join splits a hot warehouse/load key).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "dockyard", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Where it is unset, a session on a local master gets a temporary folder
    (tests); any other session is an error, since its executors could not see
    a folder of the driver's machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="dockyard-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within the block, an execution's shuffle files are deleted when it ends.

    For a table that is written once and read back: nothing reads the shuffles
    behind it again, and else they stay on disk until the driver happens to
    collect its garbage. The session's setting is put back by the last of the
    writes that run at the same time."""
    key = spark._jsparkSession.sessionUUID()
    with _lock:
        mine = _writing.setdefault(key, [0, spark.conf.get(CLEANUP, None)])
        mine[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            mine[0] -= 1
            if not mine[0]:
                del _writing[key]
                if mine[1] is None:
                    spark.conf.unset(CLEANUP)
                else:
                    spark.conf.set(CLEANUP, mine[1])
