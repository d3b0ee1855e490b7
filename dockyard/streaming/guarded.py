"""The import job as a stream whose first-wins guards are keyed state.

Each event becomes one row: its result, the guards it asks for and its report
fields. The rows of one order number meet in a stateful operator that knows
which report rows that order has already got, so a micro-batch never reads the
report tables it writes. Rows that existed before the stream began enter the
state once, as file streams of their tables (seeds).

A micro-batch that failed is run again by Spark from the state before it and
replaces its parts; an event that arrives again in a later batch is dropped by
its id (``dropDuplicates`` keeps all ids, as the reference's guards never
expire; with the RocksDB state store the state is on disk).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dockyard.functions.columns import as_of_lit, nz
from dockyard.functions.keys import stage, staging
from dockyard.operators import inbound as I
from dockyard.sources.sinks import append
from dockyard.streaming.imports import QUEUE_SCHEMA, batch_time

#: The guards: a report row each, at most once per order and ``slot``.
GUARDS = ["header", "detail", "tote", "receipt", "received"]
#: Seed table -> guard, and the columns of its order number, warehouse and time.
SEEDS = {"pod_header": ("header", "order_number", "wh_id", None), "pod_detail": ("detail", "order_number", "wh_id", None),
         "tote_tracking": ("tote", "order_number", "wh_id", None), "backhaul_log": ("receipt", "po_number", "wh_id", "create_date")}

_ROW = f"unique_id long, {', '.join(f'{g} string' for g in GUARDS)}, error_code string, error_msg string, payload string"
_OUT = f"unique_id long, {', '.join(f'{g} boolean' for g in GUARDS)}, error_code string, error_msg string, payload string"
#: The slot of a row whose key has a null part: never guarded.
OPEN = "?"


def _flag(asked: Column, slot: Column) -> Column:
    """The slot of a guard that a row asks for (null: it doesn't); a null part of the key leaves it open."""
    return F.when(F.coalesce(asked, F.lit(False)), F.coalesce(slot, F.lit(OPEN)))


def event_rows(queue: DataFrame, tables: dict[str, Callable[[], DataFrame]], day: str) -> DataFrame:
    """One row per pending event: ``key`` (its order number, else its own id), the slot of every guard it asks for,
    its result and its report fields as JSON. Only joins with small or pre-aggregated tables; works on streams."""
    ev = I.parse_events(I.pending_imports(queue), stage_result=False)
    fine = (F.coalesce(I._error(), F.lit("")) == "") & I.trigger_type().isin(*I.DELIVERABLE_TRIGGERS)
    x = ev.select("unique_id", F.col("result.errorCode").alias("error_code"), I._error().alias("error_msg"), fine.alias("_fine"),
                  *I.header_columns(), *I.count_columns(), I.items_column().alias("items"))
    x = I.resolve_warehouse(x, tables["whse"]())
    cu = tables["customers"]().filter(nz("totes_required") == 1).select("customer_code").distinct().withColumn("_totes", F.lit(True))
    unflagged = (tables["orders"]().filter(nz("tote_count_flag") == 0).select("order_number", "wh_id").distinct()
                 .withColumn("_unflagged", F.lit(True)))
    x = x.join(cu, "customer_code", "left").join(unflagged, ["order_number", "wh_id"], "left")
    signed = tables["control"]().filter(F.col("control_type") == "POD_SIGN_FLAG").agg(
        F.coalesce(F.max(F.col("c1").try_cast("int")), F.lit(0)) == 1).scalar()
    purpose = F.coalesce(F.col("purpose_number"), F.lit(""))
    backhaul = F.col("_fine") & (purpose == "Backhaul")
    wh = F.when(F.col("order_number").isNotNull(), F.col("wh_id"))
    asked = {
        "header": (F.col("_fine") & signed, wh), "detail": (F.col("_fine") & signed & (F.size("items") > 0), wh),
        "tote": (F.col("_fine") & F.col("tote_count").isNotNull() & F.col("_totes") & ~purpose.isin("Product Pickup", "Backhaul")
                 & F.col("_unflagged").isNull(), wh),
        "receipt": (backhaul, F.concat(F.lit(day + " "), wh)),
        "received": (backhaul & F.col("order_number").isNotNull(), F.lit("any"))}
    payload = F.to_json(F.struct(*[c for c in x.columns if c not in ("unique_id", "error_code", "error_msg") and not c.startswith("_")]))
    return x.select(
        F.coalesce("order_number", F.concat(F.lit("event "), F.col("unique_id").cast("string"))).alias("key"), "unique_id",
        *[_flag(*asked[g]).alias(g) for g in GUARDS], "error_code", "error_msg", F.when(F.col("_fine"), payload).alias("payload"))


def seed_rows(df: DataFrame, table: str) -> DataFrame:
    """Rows of a report table in the shape of :func:`event_rows`: they fill a guard and ask for nothing."""
    guard, order, wh, time = SEEDS[table]
    slot = F.col(wh) if time is None else F.concat(F.to_date(time).cast("string"), F.lit(" "), F.col(wh))
    none = F.lit(None).cast("string")
    return df.filter(F.col(order).isNotNull() & slot.isNotNull()).select(
        F.col(order).alias("key"), F.lit(None).cast("long").alias("unique_id"),
        *[(slot if g == guard else none).alias(g) for g in GUARDS], none.alias("error_code"), none.alias("error_msg"), none.alias("payload"))


def first_wins(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The guards each event of an order wins: slots nobody had, by the smallest event id of the batch.

    Seeds count first whatever their place in the batch. Only events that may
    still win a slot are held, one for each guard and slot; the others leave as
    they come, without their report fields.
    """
    had = {g: set(s) for g, s in json.loads(state.get[0]).items()} if state.exists else {}
    seeds: dict[str, set[str]] = {g: set() for g in GUARDS}
    best: dict[tuple[str, str], int] = {}
    held: dict[int, dict] = {}

    def out(rows: list[dict]) -> pd.DataFrame:
        done = []
        for r in rows:
            flags = {g: r[g] == OPEN or best.get((g, r[g])) == r["unique_id"] for g in GUARDS}
            done.append({**r, **flags, "payload": r["payload"] if any(flags.values()) else None})
        return pd.DataFrame(done, columns=[c.split()[0] for c in _OUT.split(", ")])

    for frame in frames:
        for r in frame.to_dict("records"):
            for g in GUARDS:
                r[g] = r[g] if isinstance(r[g], str) else None
                if r[g] and pd.isna(r["unique_id"]):
                    seeds[g].add(r[g])
            if pd.isna(r["unique_id"]):
                continue
            r["unique_id"] = int(r["unique_id"])
            held[r["unique_id"]] = r
            for g in GUARDS:
                if r[g] and r[g] != OPEN and r[g] not in had.get(g, ()):
                    best[g, r[g]] = min(best.get((g, r[g]), r["unique_id"]), r["unique_id"])
        first = set(best.values())
        rest = [held.pop(i) for i in [*held] if i not in first]
        if rest:
            yield out(rest)
    best = {(g, s): i for (g, s), i in best.items() if s not in seeds[g]}
    slots = {g: sorted(had.get(g, set()) | seeds[g] | {s for h, s in best if h == g}) for g in GUARDS}
    state.update((json.dumps({g: s for g, s in slots.items() if s}),))
    if held:
        yield out([*held.values()])


def write_winners(spark: SparkSession, rows: DataFrame, tables: dict[str, Callable[[], DataFrame]], fields: str,
                  out_dir: str, batch_id: int, as_of) -> None:
    """The report rows of a batch's winners, as the part of its id; no report table is read."""
    with staging(spark):
        rows = stage(rows)
        x = rows.filter("payload IS NOT NULL").select("unique_id", *GUARDS, F.from_json("payload", fields).alias("p"))
        x = stage(x.select("unique_id", *GUARDS, "p.*"))
        counts, none = x.select("unique_id", *I.COUNT_COLS), spark.createDataFrame([], "order_number string, wh_id string, po_number string, create_date timestamp_ntz")
        header = x.filter("header").drop(*I.COUNT_COLS)
        items = x.filter("detail").select("unique_id", F.inline("items"))
        part = str(batch_id)
        append(I.delivery_header(header, counts, I.expected_counts(header, tables["shipments"]()), none, tables["control"](), as_of),
               f"{out_dir}/delivery_header", part)
        append(I.delivery_detail(I.normalise_items(items), x.filter("detail"), none), f"{out_dir}/delivery_detail", part)
        append(I.tote_tracking(x.filter("tote").drop(*I.COUNT_COLS), counts, tables["customers"](), tables["customer_totes"](), tables["orders"](), none, as_of),
               f"{out_dir}/tote_tracking", part)
        append(I.backhaul_receipts(x.filter("receipt"), tables["pos"](), none, as_of), f"{out_dir}/backhaul_receipts", part)
        append(x.filter("received").select(F.col("order_number").alias("po_number")).distinct(), f"{out_dir}/po_received", part)
        queue = rows.select("unique_id", F.lit("N").alias("status"))
        append(I.import_status(queue, rows.select("unique_id", "error_code", "error_msg"), as_of), f"{out_dir}/import_status", part)


def start_guarded_import(spark: SparkSession, source_dir: str, tables: dict[str, Callable[[], DataFrame]], out_dir: str,
                         checkpoint_location: str, day: str, seeds: dict[str, str] | None = None, as_of=None, once: bool = True,
                         max_files_per_trigger: int | None = None):
    """Start the stream: files of import-queue rows in ``source_dir`` -> report tables in ``out_dir``.

    ``tables`` are the reference tables of the job, ``seeds`` the folders of
    report tables that were there before (see SEEDS). ``day`` is the day that
    backhaul receipts are guarded for: a stream that runs over midnight is
    started again.
    """
    r = spark.readStream.schema(QUEUE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = event_rows(r.parquet(source_dir).dropDuplicates(["unique_id"]), tables, day)
    for table, path in (seeds or {}).items():
        _, *cols = SEEDS[table]
        schema = spark.read.parquet(path).select(*[c for c in cols if c]).schema
        rows = rows.unionByName(seed_rows(spark.readStream.schema(schema).parquet(path), table))
    won = rows.groupBy("key").applyInPandasWithState(first_wins, _OUT, "slots string", "append", GroupStateTimeout.NoTimeout)
    fields = payload_schema(spark, tables, day)

    def each(df: DataFrame, batch_id: int) -> None:
        s = df.sparkSession
        write_winners(s, df, tables, fields, out_dir, batch_id, as_of or batch_time(s, out_dir, batch_id))

    w = won.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="30 seconds")).start()


def payload_schema(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]], day: str) -> str:
    """DDL of the report fields that ``payload`` holds."""
    ev = I.parse_events(spark.createDataFrame([], QUEUE_SCHEMA), stage_result=False)
    x = I.resolve_warehouse(ev.select("unique_id", *I.header_columns(), *I.count_columns(), I.items_column().alias("items")), tables["whse"]())
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in x.schema.fields if f.name != "unique_id")
