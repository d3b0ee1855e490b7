"""Bucketed copies of the line tables, for joins that leave them where they are.

The history of picks and stored items grows with every day, the work of a job
with its pending loads. Kept in buckets of the keys the jobs join on, the
history is read in place: only the rows of the pending loads are shuffled, to
the buckets of the table they meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.functions.keys import staging_path

#: Table -> keys of its buckets, as the line and message joins use them.
LAYOUT = {
    "stored_shipped": ["wh_id", "hu_id"],
    "picks": ["pick_id"],
    "orders": ["wh_id", "order_number"],
    "order_detail": ["wh_id", "order_number", "line_number"],
}


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Replace ``table`` by the rows of ``df`` in ``buckets`` buckets of ``keys``, sorted by them.

    Rows are shuffled to their bucket first, so a bucket is one file and not
    one of each task. A key that holds many rows stays in one bucket; it is
    split by adaptive execution where it is joined. Rows with a NULL key are
    kept. ``path`` is the table's folder, by default one in the warehouse.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"{table} has no column {', '.join(missing)}")
    writer = (df.repartition(buckets, *keys).write.format("parquet").mode("overwrite")
              .bucketBy(buckets, *keys).sortBy(*keys))
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def append_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> DataFrame:
    """Add rows to a bucketed table; a bucket gets one more file, the others' files stay."""
    (df.repartition(buckets, *keys).write.format("parquet").mode("append")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def buckets_of(spark: SparkSession, table: str) -> int:
    """The number of a table's buckets, 0 where it has none."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").filter(F.col("col_name") == "Num Buckets").collect()
    return int(rows[0]["data_type"]) if rows else 0


def bucketed_inputs(inputs, buckets: int, prefix: str, temporary: bool = False, names=tuple(LAYOUT)) -> dict[str, DataFrame]:
    """Write the tables ``names`` of ``inputs`` as bucketed tables ``prefix_name``; the frames that read them.

    ``temporary`` tables lie in the checkpoint folder with a job's other intermediates, others in the warehouse.
    """
    out = {}
    for n in names:
        df = getattr(inputs, n)
        out[n] = write_bucketed(df, f"{prefix}_{n}", LAYOUT[n], buckets, staging_path(df.sparkSession) if temporary else None)
    return out
