"""Ship-confirm chain for all requested loads in one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from dockyard.functions.keys import stage
from dockyard.operators import confirm as C


@dataclass
class ConfirmInputs:
    requests: DataFrame      # wh_id, load_id, username, seal, trailer
    orders: DataFrame
    picks: DataFrame         # pick detail
    pick_masters: DataFrame
    hus: DataFrame           # live handling units
    items: DataFrame         # live stored items
    loads: DataFrame
    shipments: DataFrame
    wh_control: DataFrame
    queue: DataFrame         # load queue
    employees: DataFrame
    item_master: DataFrame
    uoms: DataFrame
    customers: DataFrame

    @classmethod
    def from_fixtures(cls, fx) -> "ConfirmInputs":
        return cls(requests=fx.f_confirm_request, orders=fx.f_order, picks=fx.f_pick,
                   pick_masters=fx.f_pick_master, hus=fx.f_hu, items=fx.f_stored_shipped,
                   loads=fx.f_load, shipments=fx.f_shipment, wh_control=fx.f_wh_control,
                   queue=fx.f_load_queue, employees=fx.f_employee, item_master=fx.f_item,
                   uoms=fx.f_item_uom, customers=fx.f_customer)


class ConfirmRun:
    """Lazily evaluated steps of one confirm job. Every attribute is a
    DataFrame; nothing runs until a sink or an action asks for it, except the
    staged intermediates that several later steps read (accepted loads, units
    after the will-call move, archived units, orders after the cross-load
    close), which are written once to the shared checkpoint folder."""

    def __init__(self, t: ConfirmInputs, as_of=None):
        self.t = t
        self.as_of = as_of
        self._memo: dict[str, DataFrame] = {}

    def _m(self, k, f):
        if k not in self._memo:
            self._memo[k] = f()
        return self._memo[k]

    @property
    def carriers(self):
        # checks read only the requested loads' orders and picks
        return self._m("carriers", lambda: C.load_carrier_class(self.t.orders, self.t.requests))

    @property
    def not_loaded(self):
        return self._m("nfl", lambda: C.not_fully_loaded(self._req_picks, self.t.hus, self.carriers))

    @property
    def shipped(self):
        return self._m("shp", lambda: C.already_shipped(self._req_picks))

    @property
    def _req_picks(self):
        return self.t.picks.join(self.t.requests.select(*C.LOAD).distinct(), C.LOAD, "left_semi")

    @staticmethod
    def _stage_first(pair):
        # accepted loads feed every later step: staged once; rejections are
        # read by one output only
        return stage(pair[0]), pair[1]

    def _split(self):
        return self._m("split", lambda: self._stage_first(C.reject_loads(
            self.t.requests, self.not_loaded, self.shipped)))

    @property
    def accepted(self):
        return self._split()[0]

    @property
    def rejected(self):
        return self._split()[1]

    @property
    def shipments(self):
        return self._m("shipments", lambda: C.assign_shipments(
            self.t.loads, self.t.shipments, self.accepted, self.as_of))

    @property
    def doors(self):
        wc = self.carriers.join(self.accepted.select(*C.LOAD), C.LOAD, "left_semi")
        return self._m("doors", lambda: C.will_call_door(self.t.loads, self.t.wh_control, wc))

    @property
    def hus_wc(self):
        return self._m("hus_wc", lambda: stage(C.will_call_hu_update(self.t.hus, self.doors)))

    @property
    def items_wc(self):
        return self._m("items_wc", lambda: C.will_call_item_update(self.t.items, self.t.hus, self.doors))

    @property
    def hus_archived(self):
        return self._m("hus_arch", lambda: stage(C.archive_handling_units(
            self.hus_wc.join(self.accepted.select(*C.LOAD), C.LOAD, "left_semi"), self.shipments)))

    @property
    def items_archived(self):
        return self._m("items_arch", lambda: C.archive_stored_items(self.items_wc, self.hus_archived))

    @property
    def loads_closed(self):
        return self._m("loads1", lambda: C.close_load_rows(self.t.loads, self.accepted, "seal", self.as_of))

    @property
    def picks_closed(self):
        return self._m("picks1", lambda: C.close_pick_rows(self.t.picks, self.accepted))

    @property
    def pick_masters_closed(self):
        return self._m("pkm1", lambda: C.close_pick_rows(self.t.pick_masters, self.accepted))

    @property
    def orders_closed(self):
        return self._m("orders1", lambda: C.close_order_rows(self.t.orders, self.accepted, self.as_of))

    @property
    def orders_cross(self):
        return self._m("orders2", lambda: stage(C.close_cross_load_orders(
            self.orders_closed, self.hus_wc, self.loads_closed, self.accepted)))

    @property
    def loads_cross(self):
        return self._m("loads2", lambda: C.close_cross_load_loads(
            self.loads_closed, self.orders_cross, self.hus_wc, self.accepted))

    def _purge(self):
        return self._m("purge", lambda: C.purge_shipped(self.items_wc, self.hus_wc, self.hus_archived))

    @property
    def items_left(self):
        return self._purge()[0]

    @property
    def hus_left(self):
        return self._purge()[1]

    @property
    def audit(self):
        return self._m("audit", lambda: C.ship_audit_log(
            self.accepted, self.shipments, self.t.employees, self.as_of))

    @property
    def orders_toted(self):
        ranked = C.order_stop_rank(self.orders_cross, self.accepted)
        return self._m("orders3", lambda: C.tote_flag_update(self.orders_cross, ranked))

    @property
    def enqueue_wc(self):
        return self._m("q_wc", lambda: C.enqueue_will_call(
            self.t.orders, self.t.wh_control, self.t.queue, self.accepted))

    @property
    def enqueue_std(self):
        return self._m("q_std", lambda: C.enqueue_standard(
            self.t.orders, self.t.queue, self.accepted, self.enqueue_wc))

    @property
    def counted(self):
        return self._m("counted", lambda: C.counted_product_shipments(
            self.t.picks, self.t.item_master, self.t.uoms, self.t.orders, self.t.customers,
            self.accepted, self.as_of))
