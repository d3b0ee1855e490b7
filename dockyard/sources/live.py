"""Live tables that jobs change in place, one published run after another.

A table is a folder of Parquet files partitioned by the columns of its layout
(warehouse, ship day and load bucket for everything that hangs on a load). A
job reads only the partitions its input names, and a run goes through three
states:

1. *open*: new versions of the partitions read, and appended rows, are written
   to the run's own folder. Live tables are as before; a run that fails here
   is written anew.
2. *published*: one marker, written last, makes the whole run visible.
   Readers take the partitions it touched from its folder, all others from
   the live table.
3. *applied*: the touched partitions have been copied over the live ones (a
   dynamic partition overwrite, which can be repeated), appended rows have
   become the part of the run. A second marker ends the run.

Jobs on one folder run one at a time. Nothing here reads a path that it
overwrites.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockyard.sources.sinks import append, delete, exists

LOAD = ["wh_id", "load_id"]
#: Layout of tables that hang on a load.
LOAD_LAYOUT = ["wh_id", "ship_day", "bucket"]


def bucket_of(n: int, *keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def lay_out(df: DataFrame, loads: DataFrame, buckets: int) -> DataFrame:
    """``df`` (with a load key) and the layout columns of its load; rows of an unknown load have no ship day."""
    days = loads.select(*LOAD, F.to_date("earliest_ship_date").alias("ship_day"))
    return df.join(days, LOAD, "left").withColumn("bucket", bucket_of(buckets, *LOAD))


_SEP, _NULL = "\u0001", "\u0002"
# The characters that Spark writes as %XX in the name of a partition folder.
_ESCAPED = set("\"#%'*/:=?\\{[]^\u007f") | {chr(i) for i in range(1, 32)}


def _token(layout: list[str]) -> Column:
    """The partition of a row as one text; an expression of partition columns only, so it prunes the listing."""
    return F.concat_ws(_SEP, *[F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in layout])


def folder_of(layout: list[str], token: str) -> str:
    """The folder of a partition below its table."""
    def name(v: str) -> str:
        return "__HIVE_DEFAULT_PARTITION__" if v in (_NULL, "") else "".join(f"%{ord(x):02X}" if x in _ESCAPED else x for x in v)
    return "/".join(f"{c}={name(v)}" for c, v in zip(layout, token.split(_SEP)))


def tokens(df: DataFrame, layout: list[str]) -> set[str]:
    """The partitions ``df`` has rows in."""
    return {r[0] for r in df.select(_token(layout)).distinct().collect()}


@dataclass
class Live:
    """The live tables under ``root``; ``layouts`` names the partition columns of each changing table."""

    spark: SparkSession
    root: str
    layouts: dict[str, list[str]] = field(default_factory=dict)

    # ------------------------------------------------------------- creation

    def create(self, table: str, df: DataFrame) -> None:
        """The first version of a changing table."""
        cols = [c for c in df.columns if c not in self.layouts[table]]
        df = df.select(*cols, *self.layouts[table])
        df.limit(0).write.mode("overwrite").parquet(f"{self.root}/schema/{table}")
        self._write(df, f"{self.root}/live/{table}", table)

    def create_log(self, table: str, df: DataFrame) -> None:
        """The first rows of an appended table."""
        append(df, f"{self.root}/log/{table}", "first")

    # -------------------------------------------------------------- reading

    def read(self, table: str, only: set[str] | None = None) -> DataFrame:
        """The current version of a changing table, of the partitions ``only`` (None: all)."""
        run = self.pending()
        df = self._part(self._read(f"{self.root}/live/{table}", table), table, only)
        touched = self._touched(run, table) if run else set()
        if touched:
            df = self._part(df, table, touched, keep=False)
            new = self._read(f"{self.root}/runs/{run}/changed/{table}", table)
            df = df.unionByName(self._part(new, table, touched if only is None else touched & only))
        return df

    def read_log(self, table: str) -> DataFrame | None:
        """An appended table, of published runs only; None before its first rows."""
        run, path = self.pending(), f"{self.root}/log/{table}"
        df = self._log(path) if exists(self.spark, path) else None
        new = f"{self.root}/runs/{run}/added/{table}"
        if run and exists(self.spark, new):
            rows = self.spark.read.parquet(new)
            df = rows if df is None else df.filter(F.col("run_id") != run).drop("run_id").unionByName(rows)
            return df
        return None if df is None else df.drop("run_id")

    def _log(self, path: str) -> DataFrame:
        # run ids stay texts, whatever they look like
        plain = self.spark.read.option("recursiveFileLookup", "true").parquet(path).schema
        return self.spark.read.schema(plain.add("run_id", "string")).parquet(path)

    def _read(self, path: str, table: str) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.root}/schema/{table}").schema
        return self.spark.read.schema(schema).parquet(path)

    def _part(self, df: DataFrame, table: str, only: set[str] | None, keep: bool = True) -> DataFrame:
        if only is None:
            return df
        inside = _token(self.layouts[table]).isin(sorted(only)) if only else F.lit(False)
        return df.filter(inside if keep else ~inside)

    # ----------------------------------------------------------------- runs

    def _marked(self, kind: str) -> set[str]:
        """Names in a folder below the root."""
        path = f"{self.root}/{kind}"
        if not exists(self.spark, path):
            return set()
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return {s.getPath().getName() for s in p.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(p)}

    def _mark(self, kind: str, run_id: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/{run_id}")
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(p, True).close()

    def pending(self) -> str | None:
        """The run that is published and not applied yet."""
        runs = self._marked("published") - self._marked("applied")
        return min(runs) if runs else None

    def _touched(self, run_id: str, table: str) -> set[str]:
        path = f"{self.root}/runs/{run_id}/touched/{table}"
        return {r[0] for r in self.spark.read.parquet(path).collect()} if exists(self.spark, path) else set()

    def _write(self, df: DataFrame, path: str, table: str) -> None:
        # one file a partition, several only for a large one (AQE splits it)
        df.hint("rebalance", *self.layouts[table]).write.mode("overwrite").partitionBy(*self.layouts[table]).option("partitionOverwriteMode", "dynamic").parquet(path)

    def run(self, run_id: str, job) -> bool:
        """Do ``job(run)`` as the run ``run_id``: once, however often it is asked for or fails.

        A published run is finished first. False when the run was done before.
        """
        before = self.pending()
        if before:
            self.apply(before)
        if run_id in self._marked("applied"):
            return False
        delete(self.spark, f"{self.root}/runs/{run_id}")
        job(Run(self, run_id))
        self._mark("published", run_id)
        self.apply(run_id)
        return True

    def apply(self, run_id: str) -> None:
        """Copy a published run into the live tables; can be repeated at any point."""
        folder = f"{self.root}/runs/{run_id}"
        for table in sorted(self.layouts):
            touched = self._touched(run_id, table)
            if not touched:
                continue
            new = self._part(self._read(f"{folder}/changed/{table}", table), table, touched)
            left = tokens(new, self.layouts[table])
            self._write(new, f"{self.root}/live/{table}", table)
            for token in touched - left:
                delete(self.spark, f"{self.root}/live/{table}/{folder_of(self.layouts[table], token)}")
        for table in sorted(self._marked(f"runs/{run_id}/added")):
            append(self.spark.read.parquet(f"{folder}/added/{table}"), f"{self.root}/log/{table}", run_id)
        self._mark("applied", run_id)
        delete(self.spark, folder)
        delete(self.spark, f"{self.root}/published/{run_id}")


@dataclass
class Run:
    """An open run: everything it writes stays in its own folder."""

    live: Live
    run_id: str

    def append(self, table: str, rows: DataFrame) -> None:
        """Rows to add to an appended table."""
        rows.write.mode("overwrite").parquet(f"{self._folder}/added/{table}")

    def replace(self, table: str, old: DataFrame, new: DataFrame) -> None:
        """``new`` is the next version of the partitions ``old`` was read from.

        Only partitions whose rows differ are touched. Both frames hold no
        more than the partitions the job has read.
        """
        live, layout = self.live, self.live.layouts[table]
        path = f"{self._folder}/changed/{table}"
        live._write(new.select(*old.columns), path, table)
        written = live._read(path, table).select(*old.columns) if exists(live.spark, path) else old.limit(0)
        differ = written.exceptAll(old).unionByName(old.exceptAll(written))
        differ.select(_token(layout).alias("token")).distinct().coalesce(1).write.mode("overwrite").parquet(f"{self._folder}/touched/{table}")

    @property
    def _folder(self) -> str:
        return f"{self.live.root}/runs/{self.run_id}"
