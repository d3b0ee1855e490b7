"""End-to-end jobs: run a chain and write every output with the sinks.

Outputs land under ``out_dir/<table>``; appended rows use :func:`append`,
changed tables :func:`write_version`. ``as_of`` is the job's "now" and
``run_id`` names the run: a job that failed half-way is run again with the
same two and leaves the tables of one complete run. The staged intermediates
are deleted from the checkpoint folder at the end, also of a failed run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from dockyard.functions.keys import staging
from dockyard.operators import replies as R
from dockyard.plans.confirm import ConfirmInputs, ConfirmRun
from dockyard.plans.inbound import InboundInputs, InboundRun
from dockyard.plans.outbound import OutboundInputs, OutboundRun
from dockyard.sources.sinks import append, append_ordered, write_version


def run_confirm(t: ConfirmInputs, out_dir: str, as_of, run_id: str) -> None:
    """Ship-confirm all requested loads. The changed tables are
    partitioned by warehouse; only warehouses with an accepted load are
    rewritten."""
    with staging(t.loads.sparkSession):
        r = ConfirmRun(t, as_of)
        part = dict(partition_by=["wh_id"], touched=r.accepted)
        append(r.rejected, f"{out_dir}/confirm_rejections", run_id)
        append(r.shipments.filter("is_new = 1"), f"{out_dir}/shipment_master", run_id)
        append(r.hus_archived, f"{out_dir}/hu_master_shipped", run_id)
        append(r.items_archived, f"{out_dir}/stored_item_shipped", run_id)
        write_version(r.loads_cross, f"{out_dir}/load_master", **part)
        write_version(r.picks_closed, f"{out_dir}/pick_detail", **part)
        write_version(r.pick_masters_closed, f"{out_dir}/pick_master", **part)
        write_version(r.orders_toted, f"{out_dir}/order", **part)
        write_version(r.hus_left, f"{out_dir}/hu_master", **part)
        write_version(r.items_left, f"{out_dir}/stored_item", **part)
        append(r.audit, f"{out_dir}/tran_log", run_id)
        append(r.enqueue_wc.unionByName(r.enqueue_std), f"{out_dir}/load_queue_new", run_id)
        append(r.counted, f"{out_dir}/pod_shipments", run_id)


def run_outbound(t: OutboundInputs, out_dir: str, as_of, run_id: str, system_name: str = "legacySystem") -> None:
    """Build and queue the messages of all pending loads."""
    with staging(t.queue.sparkSession):
        r = OutboundRun(t, as_of, system_name)
        append(r.tote_log, f"{out_dir}/customer_totes", run_id)
        append(r.container_rows, f"{out_dir}/container_shipments", run_id)
        append_ordered(r.queue_rows, f"{out_dir}/message_queue", run_id, "unique_id")
        new_pos, new_backhauls = r.po_state
        write_version(new_pos, f"{out_dir}/po_master")
        write_version(new_backhauls, f"{out_dir}/po_backhaul")
        write_version(r.queue_done, f"{out_dir}/load_queue")


def run_import(t: InboundInputs, out_dir: str, as_of, run_id: str) -> None:
    """Consume all pending inbound event documents."""
    with staging(t.queue.sparkSession):
        r = InboundRun(t, as_of)
        append(r.totes, f"{out_dir}/tote_tracking", run_id)
        append(r.backhauls, f"{out_dir}/po_backhaul_receipts", run_id)
        write_version(r.po_update, f"{out_dir}/po_master")
        append(r.pod_header, f"{out_dir}/pod_header", run_id)
        append(r.detail, f"{out_dir}/pod_detail", run_id)
        write_version(r.queue_after, f"{out_dir}/import_queue")


def run_send_results(queue: DataFrame, replies: DataFrame, out_dir: str, as_of, run_id: str,
                     max_retries: int = R.DEFAULT_MAX_RETRIES) -> None:
    """Take in the service's replies: messages to send again,
    then the queue with statuses, failed pallet messages queued as updates."""
    append(R.retry_plan(queue, replies, max_retries), f"{out_dir}/retries", run_id)
    write_version(R.pallet_resend(R.message_status(queue, replies, as_of)), f"{out_dir}/message_queue")
