"""Exact deduplication: group by a 128-bit content hash, compare the bytes inside groups.

Only DataFrame functions; no Python on the executors.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.llm.tables import fresh, in_files, staged, tasks

#: Rows of one hash that are compared in one task.
PART = 1024
#: Rows of hashes and ids that a file has, at least.
ROWS = 1 << 16


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of ASCII alone take the fast built-in path."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "min") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows are in one group when their texts are equal after lower-casing A-Z.
    The row with the smallest (``keep="min"``) or largest id of a group stays;
    of rows that repeat both id and text all have ``kept`` true, as they can't
    be told apart. Null text counts as empty; a null id stays only when its
    whole group has null ids. Other columns of ``docs`` are not read, so any
    names are allowed. An empty table gives an empty result.

    The text is hashed once into a narrow table. Hash groups of two rows or
    more are found by a pre-aggregated count; only their rows are read with
    the text again, and the smallest and the largest text of each hash are
    compared: where they are the same bytes, so is everything between. Rows of
    a hash with unequal texts are grouped by the text itself, so a collision
    never merges two texts. A hash that very many rows share is reduced on
    the map side in every aggregate, and split by the skew join elsewhere.
    """
    best = F.max if keep == "max" else F.min
    keyed = docs.select(F.col(id_col).alias("_id"), ascii_lower(F.coalesce(text_col, F.lit(""))).alias("_text"))
    keyed = keyed.withColumn("_hash", F.unhex(F.md5("_text")))
    narrow = staged(keyed.select("_id", "_hash", F.unhex(F.sha2("_text", 256)).alias("_sha")))

    n = narrow.count()
    groups = staged(in_files(narrow.groupBy("_hash").agg(best("_id").alias("_keep"), F.count(F.lit(1)).alias("_n")), n, ROWS))
    several = groups.filter("_n > 1").select("_hash", "_n")
    # a large group is compared in parts, and then part by part
    salt = F.when(F.col("_n") > PART, F.pmod(F.xxhash64("_id"), F.ceil(F.col("_n") / PART))).otherwise(0)
    members = keyed.join(several, "_hash").withColumn("_salt", salt).repartition(tasks(docs.sparkSession), "_hash", "_salt")
    parts = staged(members.groupBy("_hash", "_salt", "_n").agg(F.min("_text").alias("_a"), F.max("_text").alias("_b"))
                   .filter((F.col("_a") != F.col("_b")) | (F.col("_n") > PART)))
    mixed = (parts.groupBy("_hash").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b"))
             .filter("_a <> _b").select("_hash"))

    plain = narrow.join(mixed, "_hash", "left_anti").join(groups, "_hash")
    collided = keyed.join(mixed, "_hash", "left_semi")
    exact = collided.groupBy("_hash", "_text").agg(best("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    apart = (collided.join(exact, ["_hash", "_text"])
             .select("_hash", "_id", F.unhex(F.sha2("_text", 256)).alias("_sha"), "_keep", "_n"))
    both = plain.select("_id", "_sha", "_keep", "_n").unionByName(apart.select("_id", "_sha", "_keep", "_n"))
    return in_files(both, n, ROWS).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """``docs`` with one row of each group of :func:`exact_groups`; all columns stay.

    Of rows that repeat both id and text, one (any) stays.
    """
    groups = staged(exact_groups(docs, id_col, text_col, keep).withColumnRenamed(id_col, "_id"))
    ids = groups.groupBy("_id").agg(F.max("kept").alias("_any"), F.count(F.lit(1)).alias("_n"))
    gone, sha = fresh(docs, "_gone"), fresh(docs, "_sha")
    out = ids.filter("not _any").select(F.col("_id").alias(gone))
    again = staged(ids.filter("_any and _n > 1").select(F.col("_id").alias(gone)))
    if again.isEmpty():
        return docs.join(out, docs[id_col].eqNullSafe(F.col(gone)), "left_anti")
    # rows that share their id with others: those of a text that stays, once each
    whole = docs.join(out.union(again), docs[id_col].eqNullSafe(F.col(gone)), "left_anti")
    close = (docs.join(again, docs[id_col].eqNullSafe(F.col(gone)), "left_semi")
             .withColumn(sha, F.sha2(ascii_lower(F.coalesce(text_col, F.lit(""))).cast("binary"), 256)))
    kept = groups.filter("kept").select(F.col("_id").alias(gone), F.col("text_sha256").alias(sha + "_")).distinct()
    stays = close.join(kept, close[id_col].eqNullSafe(F.col(gone)) & (F.col(sha) == F.col(sha + "_")), "left_semi")
    return whole.unionByName(stays.dropDuplicates([id_col, sha]).select(*docs.columns))
