"""Inbound chain: import queue -> parsed events -> report rows.

The same function serves batch runs and streaming micro-batches (see
:mod:`dockyard.streaming.imports`): every guard reads its target table inside
the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from dockyard.functions.keys import stage
from dockyard.operators import inbound as I


class InboundInputs:
    """Tables read by the import job (lazy)."""

    def __init__(self, **makers):
        self._makers = makers
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name not in self._makers:
                raise AttributeError(name)
            v = self._makers[name]
            self._frames[name] = v() if callable(v) else v
        return self._frames[name]

    @classmethod
    def from_fixtures(cls, fx) -> "InboundInputs":
        return cls(queue=lambda: fx.d_import_queue, whse=lambda: fx.f_whse,
                   shipments=lambda: fx.f_pod_shipments,
                   customers=lambda: fx.f_customer, customer_totes=lambda: fx.f_customer_totes,
                   orders=lambda: fx.f_order, tote_tracking=lambda: fx.f_tote_tracking,
                   pos=lambda: fx.f_po, backhaul_log=lambda: fx.f_backhaul_log,
                   pod_header=lambda: fx.f_pod_header, pod_detail=lambda: fx.f_pod_detail,
                   control=lambda: fx.f_control)


class InboundRun:
    def __init__(self, t: InboundInputs, as_of=None):
        self.t = t
        self.as_of = as_of
        self._memo: dict[str, DataFrame] = {}

    def _m(self, k, f):
        if k not in self._memo:
            self._memo[k] = f()
        return self._memo[k]

    @property
    def pending(self):
        return I.pending_imports(self.t.queue)

    @property
    def events(self):
        # one parse per document, staged: later filters read the parsed rows
        return self._m("events", lambda: I.parse_events(self.pending))

    @property
    def results(self):
        return self._m("results", lambda: I.event_result(self.events))

    @property
    def deliverable(self):
        return self._m("dlv", lambda: I.deliverable_events(self.events))

    @property
    def counts(self):
        return self._m("counts", lambda: I.workflow_counts(self.deliverable))

    @property
    def header(self):
        return self._m("header", lambda: stage(I.resolve_warehouse(
            I.event_header(self.deliverable), self.t.whse)))

    @property
    def expected(self):
        return self._m("expected", lambda: I.expected_counts(self.header, self.t.shipments))

    @property
    def totes(self):
        return I.tote_tracking(self.header, self.counts, self.t.customers, self.t.customer_totes,
                               self.t.orders, self.t.tote_tracking, self.as_of)

    @property
    def backhauls(self):
        return I.backhaul_receipts(self.header, self.t.pos, self.t.backhaul_log, self.as_of)

    @property
    def po_update(self):
        return I.backhaul_po_update(self.t.pos, self.header)

    @property
    def pos_received(self):
        return I.backhaul_pos_received(self.header)

    @property
    def pod_header(self):
        return I.delivery_header(self.header, self.counts, self.expected, self.t.pod_header,
                                 self.t.control, self.as_of)

    @property
    def raw_items(self):
        return self._m("items0", lambda: I.event_items(self.deliverable))

    @property
    def items(self):
        return self._m("items", lambda: I.normalise_items(self.raw_items))

    @property
    def detail(self):
        return I.delivery_detail(I.with_signatures(self.items, self.t.control), self.header, self.t.pod_detail)

    @property
    def queue_after(self):
        return I.import_status(self.t.queue.drop("xml_response"), self.results, self.as_of)
