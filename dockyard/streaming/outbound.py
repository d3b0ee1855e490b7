"""The load queue as a stream: each micro-batch of queue rows is one outbound run.

Message ids go on across batches: a batch starts after the highest id that the
batches before it have written to the id ledger, and a batch that is run again
starts from the same id and replaces its parts. A later batch also sees what
earlier ones did to the tables it reads: purchase orders sent, and containers
shipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.functions.keys import staging
from dockyard.plans.outbound import OutboundInputs, OutboundRun
from dockyard.sources.sinks import append, append_ordered, exists
from dockyard.streaming.imports import batch_time

QUEUE_SCHEMA = "unique_id bigint, wh_id string, load_id string, queue_status int, preship_scan_gs1 int"


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What the batches before this one wrote to a table; None before the first."""
    if not exists(spark, path):
        return None
    return spark.read.parquet(path).filter(F.col("run_id").cast("bigint") < batch_id).drop("run_id")


def last_id(spark: SparkSession, out_dir: str, batch_id: int, start: int) -> int:
    """The highest message id that was given before this batch."""
    ledger = _before(spark, f"{out_dir}/ids", batch_id)
    return start if ledger is None else max(start, ledger.agg(F.max("last_id")).first()[0] or start)


def outbound_batch(spark: SparkSession, batch: DataFrame, tables: dict[str, Callable[[], DataFrame]], out_dir: str,
                   batch_id: int, as_of, start: int, system_name: str = "legacySystem") -> None:
    """Build and queue the messages of one batch of load-queue rows."""
    part, given = str(batch_id), dict(tables)
    base = last_id(spark, out_dir, batch_id, start)
    sent, resent = (_before(spark, f"{out_dir}/{t}", batch_id) for t in ("po_sent", "po_resent"))
    shipped = _before(spark, f"{out_dir}/container_shipments", batch_id)
    if sent is not None:
        given["pos"] = lambda: _set(tables["pos"](), sent, "sent_flag", F.lit(1))
        given["backhauls"] = lambda: _set(tables["backhauls"](), resent, "status", F.lit("SENT"))
    if shipped is not None:
        given["container_history"] = lambda: (h := tables["container_history"]()).unionByName(shipped.select(*h.columns))
    with staging(spark):
        given["queue"] = lambda: batch
        given["message_queue"] = lambda: spark.createDataFrame([(base,)], "unique_id bigint")
        r = OutboundRun(OutboundInputs(**given), as_of, system_name)
        append(r.tote_log, f"{out_dir}/customer_totes", part)
        append(r.container_rows, f"{out_dir}/container_shipments", part)
        append(r.po.select("po_number").distinct(), f"{out_dir}/po_sent", part)
        append(r.po.filter("sent_to_service = 1").select("po_number").distinct(), f"{out_dir}/po_resent", part)
        append_ordered(r.queue_rows, f"{out_dir}/message_queue", part, "unique_id")
        append(r.pending.select("unique_id"), f"{out_dir}/loads_done", part)
        last = r.message_ids.agg(F.coalesce(F.max("message_id"), F.lit(base)).cast("bigint").alias("last_id"))
        append(last, f"{out_dir}/ids", part)


def _set(df: DataFrame, keys: DataFrame, col: str, value) -> DataFrame:
    """``df`` with ``col`` set in the rows of the purchase orders ``keys``."""
    hit = keys.select("po_number").distinct().withColumn("_hit", F.lit(True))
    return df.join(hit, "po_number", "left").withColumn(col, F.when(F.col("_hit"), value).otherwise(F.col(col))).select(*df.columns)


def start_outbound_stream(spark: SparkSession, source_dir: str, tables: dict[str, Callable[[], DataFrame]], out_dir: str,
                          checkpoint_location: str, start: int = 0, as_of=None, once: bool = True,
                          max_files_per_trigger: int | None = None):
    """Start the stream: files of load-queue rows in ``source_dir`` -> messages in ``out_dir``.

    ``tables`` are the inputs of :class:`OutboundInputs` except the queue and
    the message queue, ``start`` the highest message id that was given before
    the stream.
    """
    r = spark.readStream.schema(QUEUE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def each(df: DataFrame, batch_id: int) -> None:
        s = df.sparkSession
        outbound_batch(s, df, tables, out_dir, batch_id, as_of or batch_time(s, out_dir, batch_id), start)

    w = r.parquet(source_dir).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")).start()
