"""Import documents that arrive as XML files, read into the import queue's shape.

A file holds any number of ``<import uniqueId="5" status="N"><document>`` rows,
the event document inside. Spark's text reader splits the files at the end tag
of a row, so large files are read by many tasks and a row that isn't well formed
spoils no other. The document stays as it was written: the import job parses it
with an explicit schema and a corrupt-record column and decides by its root.
(Spark's XML reader with a row tag was tried first; as text it returns a nested
document with its entities resolved, which is another document.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tag that ends a row; it must not occur inside a document.
END = "</import>"


def _queue(rows: DataFrame) -> DataFrame:
    """``unique_id, status, xml_response`` of each row; rows without an id can't be reported and are left out."""
    tag = F.regexp_extract("value", r"<import\b([^>]*)>", 1)

    def attribute(name: str) -> Column:
        return F.nullif(F.regexp_extract(tag, name + r"\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit(""))

    document = F.regexp_extract("value", r"(?s)<document>(.*?)(?:</document>\s*)?$", 1)
    q = rows.select(attribute("uniqueId").try_cast("bigint").alias("unique_id"), attribute("status").alias("status"),
                    document.alias("xml_response"))
    return q.filter(F.col("unique_id").isNotNull())


def read_import_files(spark: SparkSession, path: str) -> DataFrame:
    """The import rows of the XML files under ``path``."""
    return _queue(spark.read.option("lineSep", END).text(path))


def stream_import_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream: each file is read once, when it has arrived."""
    r = spark.readStream.option("lineSep", END)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _queue(r.text(path))
