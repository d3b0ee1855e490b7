"""Written intermediates in the shared checkpoint folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dockyard.session import shuffles_dropped


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a session on a local master gets a temporary folder
    (tests); any other session is an error, since executors on other machines
    could not see it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later steps read the files instead of repeating the work, and a lost
    executor costs no more than its own tasks.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table that :func:`staged` gave and that nothing reads any more."""
    spark = df.sparkSession
    conf = spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 1)[1].startswith("llm-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def in_files(df: DataFrame, size: int, each: int) -> DataFrame:
    """``df`` in at most one task, and so one file, for ``each`` of ``size`` (rows or bytes of what it is made from).

    A small table isn't dealt over all shuffle partitions: on a local disk the
    JVM starts processes for every file that it writes, which count as a
    second JVM until they have begun.
    """
    return df.coalesce(max(1, -(-size // each)))


def release(spark: SparkSession) -> None:
    """Ask for the shuffle files of finished steps to be dropped.

    Spark does so once the driver has collected the plans that made them. It
    takes two collections: the first lets go of the frames, the second of
    their shuffles.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def tasks(spark: SparkSession) -> int:
    """The session's shuffle partition count, which the user sizes with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
