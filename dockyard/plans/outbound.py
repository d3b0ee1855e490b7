"""Outbound chain: pending loads -> work set -> message sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.functions.keys import stage
from dockyard.operators import messages as M
from dockyard.operators import outbound as O
from dockyard.operators import returns as RT


class OutboundInputs:
    """Tables read by the outbound job. Built lazily: a query only pays for
    the tables it touches."""

    NAMES = ("queue", "loads", "orders", "hus_shipped", "stored_shipped", "picks", "order_detail",
             "pick_masters", "items", "uoms", "upcs", "customers", "containers", "pos",
             "po_lines", "receipts", "backhauls", "vendors", "whse",
             "shipments",          # counted-product shipments written by confirm
             "container_history",  # container shipments of earlier runs
             "message_queue",      # outbound message queue (ids continue after it)
             "rmas", "rma_lines", "rma_routes")

    def __init__(self, **frames):
        self._frames = {}
        self._makers = {}
        for k, v in frames.items():
            (self._makers if callable(v) else self._frames)[k] = v

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name not in self._makers:
                raise AttributeError(name)
            self._frames[name] = self._makers[name]()
        return self._frames[name]

    def replaced(self, **frames) -> "OutboundInputs":
        """The same inputs with some tables read from elsewhere."""
        return OutboundInputs(**{**self._makers, **self._frames, **frames})

    @classmethod
    def from_fixtures(cls, fx) -> "OutboundInputs":
        f = {n: (lambda v=v: fx[v]) for n, v in dict(
            queue="f_load_queue", loads="f_load", orders="f_order", hus_shipped="f_hu_shipped",
            stored_shipped="f_stored_shipped", pick_masters="f_pick_master", items="f_item",
            uoms="f_item_uom", upcs="f_item_upc", customers="f_customer",
            containers="f_container", pos="f_po", po_lines="f_po_line", receipts="f_receipt",
            backhauls="f_backhaul", vendors="f_vendor", whse="f_whse",
            message_queue="f_message", rmas="f_rma", rma_lines="f_rma_line",
            rma_routes="f_rma_route").items()}
        # fixture picks have one pick master per container
        f["picks"] = lambda: fx.f_pick.withColumns({
            "shipped_quantity": F.col("picked_quantity"), "pick_master_id": F.col("container_id")})
        f["order_detail"] = lambda: fx.f_order_detail
        # what earlier runs wrote (fixture inputs, see sources.fixtures)
        f["shipments"] = lambda: fx.f_pod_shipments
        f["container_history"] = lambda: fx.f_container_history
        return cls(**f)


class OutboundRun:
    """Lazily built steps of one outbound job."""

    def __init__(self, t: OutboundInputs, as_of=None, system_name: str = "legacySystem",
                 pallet_system_name: str | None = None, kept_days: DataFrame | None = None):
        self.t = t
        # the kept table of the newest ship days (operators.outbound.merge_latest_days), read instead of the history
        self.kept_days = kept_days
        self.as_of = as_of
        self.system_name = system_name
        # K20: a setting for both message kinds (the reference hard-codes it
        # for pallets); defaults to the order setting.
        self.pallet_system_name = pallet_system_name or system_name
        self._memo: dict[str, DataFrame] = {}

    def _m(self, k, f):
        if k not in self._memo:
            self._memo[k] = f()
        return self._memo[k]

    @property
    def order_detail(self):
        return self.t.order_detail

    @property
    def pending(self):
        return self._m("pending", lambda: O.pending_loads(self.t.queue, self.t.loads))

    @property
    def stops(self):
        return self._m("stops", lambda: O.po_stop(self.pending, self.t.loads, self.t.orders))

    @property
    def lines(self):
        return self._m("lines", lambda: stage(O.shipped_lines(
            self.pending, self.t.hus_shipped, self.t.stored_shipped, self.t.picks,
            self.t.items, self.t.uoms, self.t.orders, self.t.customers)))

    @property
    def candidates(self):
        return self._m("cands", lambda: O.tote_candidates(self.lines))

    @property
    def prior(self):
        return self._m("prior", lambda: stage(O.prior_load(self.candidates, self.t.orders, self.t.loads)))

    @property
    def units(self):
        prior_loads = self.prior.select("wh_id", F.col("prior_load_id").alias("load_id"))
        return self._m("units", lambda: stage(O.shipped_units(
            self.t.picks, self.t.pick_masters, self.t.orders, self.t.containers, prior_loads)))

    @property
    def prior_counts(self):
        return self._m("ptc", lambda: stage(O.prior_tote_count(self.prior, self.units)))

    @property
    def totes(self):
        return self._m("totes", lambda: stage(O.fallback_tote_count(
            self.prior_counts, None if self.kept_days is not None else self.t.container_history, self.t.customers,
            self.as_of, self.kept_days)))

    @property
    def tote_log(self):
        return O.tote_expectations(self.totes, self.t.customers, self.as_of)

    @property
    def container_rows(self):
        return O.container_shipments(self.lines, self.t.containers, self.as_of)

    @property
    def days_kept(self):
        """The kept table after this run."""
        return O.merge_latest_days(self.kept_days, self.container_rows)

    @property
    def po(self):
        return self._m("po", lambda: stage(O.backhaul_pos(
            self.pending, self.stops, self.t.pos, self.t.po_lines, self.t.receipts,
            self.t.backhauls)))

    @property
    def gtins(self):
        return O.order_gtins(self.lines, self.order_detail, self.t.orders, self.t.customers,
                             self.t.upcs, self.t.items)

    @property
    def totals(self):
        s = self.t.shipments.join(self.pending.select("wh_id", "load_id"), ["wh_id", "load_id"],
                                  "left_semi")
        return self._m("totals", lambda: O.counted_product_totals(s))

    @property
    def gs1_lines(self):
        return O.gs1_order_lines(self.lines, self.order_detail, self.t.items, self.t.upcs)

    @property
    def standard_lines(self):
        return O.standard_order_lines(self.lines, self.order_detail, self.t.items, self.t.upcs)

    @property
    def order_lines(self):
        return self._m("olines", lambda: O.order_lines(self.lines, self.order_detail, self.t.items, self.t.upcs))

    @property
    def headers(self):
        return self._m("headers", lambda: O.order_properties(O.order_headers(
            self.lines, self.t.orders, self.t.customers, self.totes, self.totals)))

    @property
    def po_lines_msg(self):
        return O.po_lines_message(self.po, self.t.po_lines, self.t.items, self.t.upcs)

    @property
    def pallet_heads(self):
        return self._m("pheads", lambda: stage(O.pallet_purpose(O.pallet_heads(self.lines, self.t.upcs))))

    @property
    def pallets(self):
        return O.non_gs1_pallets(self.pallet_heads)

    @property
    def pallet_items(self):
        return O.pallet_items(self.lines)

    @property
    def po_state(self):
        return O.po_state_update(self.t.pos, self.t.backhauls, self.po)

    @property
    def queue_done(self):
        return O.complete_loads(self.t.queue, self.pending, self.as_of)

    # ----------------------------------------------------------------- returns

    @property
    def returns(self):
        # read by the order messages (alert), the ids and the return messages
        return self._m("returns", lambda: stage(RT.open_returns(
            self.t.rmas, self.t.rma_lines, self.t.rma_routes, self.lines, self.pending)))

    @property
    def return_lines(self):
        upcs = RT.return_upcs(self.t.rma_lines, self.t.upcs)
        gtins = RT.return_gtins(self.t.rmas, self.t.customers, self.t.rma_lines, self.t.upcs)
        return RT.return_lines(self.t.rma_lines, self.t.items, self.t.uoms, upcs, gtins)

    # ---------------------------------------------------------------- messages

    @property
    def message_ids(self):
        def build():
            keys = M.message_keys(self.pending, self.lines, self.po, self.pallets,
                                  RT.return_message_keys(self.returns))
            return M.assign_message_ids(keys, self.t.message_queue)
        return self._m("ids", build)

    @property
    def order_messages(self):
        return M.order_messages(self.headers, self.order_lines, self.message_ids, self.pending,
                                self.t.whse, self.system_name, returns=self.returns, as_of=self.as_of)

    @property
    def po_messages(self):
        return M.po_messages(self.po, self.po_lines_msg, self.t.pos, self.t.vendors,
                             self.message_ids, self.pending, self.t.whse, self.system_name,
                             as_of=self.as_of)

    @property
    def po_reopen_messages(self):
        return M.po_reopen_messages(self.po, self.message_ids, self.pending, self.t.whse,
                                    self.system_name, as_of=self.as_of)

    @property
    def pallet_messages(self):
        return M.pallet_messages(self.pallets, self.pallet_items, self.message_ids,
                                 self.pallet_system_name, as_of=self.as_of)

    @property
    def return_messages(self):
        return RT.return_messages(self.returns, self.t.rmas, self.t.customers, self.return_lines,
                                  self.message_ids, self.pending, self.t.whse, self.system_name, as_of=self.as_of)

    @property
    def queue_rows(self):
        return M.message_queue_rows(self.order_messages, self.po_reopen_messages,
                                    self.po_messages, self.pallet_messages, self.return_messages)
