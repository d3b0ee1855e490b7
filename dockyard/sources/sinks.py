"""Sinks: appended rows and new table versions.

The reference appends with INSERT and changes tables with UPDATE / DELETE.
Here an operator returns either rows to append or the next version of a
table; a sink writes it, so that a job that is run again with the same run id
leaves the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, run_id: str) -> None:
    """INSERT: add the rows to the table at ``path`` as the part of this run.
    A rerun with the same id replaces its part instead of adding it twice."""
    df.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def append_ordered(df: DataFrame, path: str, run_id: str, key: str) -> None:
    """INSERT in the order of ``key`` (unique), as the part of this run.

    The files hold ranges of ``key`` that don't overlap, each file sorted: a
    reader that takes them in the order of :func:`manifest` sees all rows in
    order, though no task has sorted them all.
    """
    part = f"{path}/run_id={run_id}"
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(part)
    files = df.sparkSession.read.schema(df.schema).parquet(part).groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n_rows"))
    files.write.mode("overwrite").parquet(f"{part}/_manifest")  # Spark's readers skip names that begin with _


def manifest(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The files of a run's ordered part: ``file_name, first, last, n_rows``, in order."""
    return spark.read.parquet(f"{path}/run_id={run_id}/_manifest").orderBy("first")


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  touched: DataFrame | None = None) -> None:
    """UPDATE / DELETE: write the table's next version.

    With ``partition_by`` and ``touched`` (the partition values the job has
    changed) only those partitions are rewritten, and those that have no rows
    left are removed; files of all others stay as they are. The driver sees
    the values of emptied partitions only. ``df`` must not read ``path``
    itself: see :mod:`dockyard.sources.live` for tables that jobs change in place.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    if touched is not None:
        keys = touched.select(*partition_by).distinct()
        df = df.join(keys, partition_by, "left_semi")
        # known before anything is overwritten
        emptied = keys.join(df.select(*partition_by).distinct(), partition_by, "left_anti").collect()
    df.write.mode("overwrite").partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)
    if touched is not None:
        for row in emptied:
            delete(df.sparkSession, path + "".join(f"/{k}={row[k]}" for k in partition_by))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
