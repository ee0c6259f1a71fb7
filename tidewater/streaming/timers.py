"""T3 / R8: exception flags with keyed state and named event-time timers over the silver event stream.

State of a shipment, in the RocksDB state store:

* ``milestones``  map, per milestone its latest row (times, vessel, event id);
* ``facts``       the last milestone, the latest last-mile row's e-way expiry, the vessel's hours at anchor, open flags;
* ``deadlines``   map, per timer name the instant it is set for.

Timers: ``silence`` (last milestone + its normal gap), ``customs`` (arrival +
48 h without release), ``eway`` (expiry of the e-way bill before delivery) and
``expiry`` (a delivered shipment's state goes).  Each fires when the watermark
passes it, without any new event of the shipment.  A stalled vessel needs no
timer: its hours at anchor come as rows of their own.

The output is a change log: a row each time a flag opens or closes, stamped
with the watermark it was evaluated at.  Flags open at watermark W equal the
five batch rules at ``asof = W``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewater import config
from tidewater.session import use_rocksdb

FLAG_TYPES = config.EXCEPTION_TYPES
TIMERS = ("silence", "customs", "eway", "expiry")
OUTPUT_SCHEMA = ("shipment_id string, exception_type string, is_open boolean, evaluated_at timestamp, "
                 "seq long, carrier string")
_MILESTONE = "actual_s long, planned_s long, event_id string, vessel_mmsi string"
_FACTS = ("ms_idx long, actual_s long, event_id string, event_type string, carrier string, lm_order string, "
          "eway_ms long, anchor_hours double, open_flags long, seq long")
_FACT_NAMES = [f.split()[0] for f in _FACTS.split(", ")]
_KEPT = ("vessel_departed", "vessel_arrived", "customs_release", "delivered")
_GAP_S = {m: (g * 3600 if g is not None else None) for m, g in config.MAX_GAP_H.items()}
_CUSTOMS_S = config.CUSTOMS_DWELL_H * 3600


def _text(value) -> str | None:
    return value if isinstance(value, str) else None


class ShipmentFlags(StatefulProcessor):
    """Keeps a shipment's facts, evaluates the rules at the watermark and arms the next timers."""

    def __init__(self, grace_s: int | None):
        self.grace_s = grace_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.milestones = handle.getMapState("milestones", "event_type string", _MILESTONE)
        self.facts = handle.getValueState("facts", _FACTS)
        self.deadlines = handle.getMapState("deadlines", "timer string", "at_ms long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        facts = self._facts()
        latest = self._milestones()
        seen = dict(latest)
        for pdf in rows:
            for r in pdf.itertuples(index=False):
                self._take(facts, latest, r)
        for name, row in latest.items():
            if seen.get(name) != row:
                self.milestones.updateValue((name,), row)
        yield from self._evaluate(key[0], facts, latest, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.facts.exists():  # an earlier timer of this watermark was the last one
            return
        now_ms = timerValues.getCurrentWatermarkInMs()
        due = self.deadlines.getValue(("expiry",)) if self.deadlines.containsKey(("expiry",)) else None
        yield from self._evaluate(key[0], self._facts(), self._milestones(), now_ms)
        if due is not None and due[0] <= now_ms:
            self.milestones.clear()
            self.facts.clear()
            self.deadlines.clear()

    def _facts(self) -> dict:
        held = self.facts.get() if self.facts.exists() else None
        return dict(zip(_FACT_NAMES, held, strict=True)) if held is not None else dict.fromkeys(_FACT_NAMES) | {
            "open_flags": 0, "seq": 0}

    def _milestones(self) -> dict:
        return {name[0]: tuple(row) for name, row in self.milestones.iterator()}

    @staticmethod
    def _take(facts: dict, latest: dict, r) -> None:
        if r.kind == "anchor":   # hours at anchor only grow
            facts["anchor_hours"] = max(facts["anchor_hours"] or 0.0, float(r.anchor_hours))
            return
        actual, event = int(r.actual_s), r.event_id
        if facts["ms_idx"] is None or (int(r.ms_idx), actual, event) > (facts["ms_idx"], facts["actual_s"], facts["event_id"]):
            facts.update(ms_idx=int(r.ms_idx), actual_s=actual, event_id=event, event_type=r.event_type, carrier=_text(r.carrier))
        if r.event_type in _KEPT and (r.event_type not in latest
                                      or (actual, event) > (latest[r.event_type][0], latest[r.event_type][2])):
            latest[r.event_type] = (actual, None if pd.isna(r.planned_s) else int(r.planned_s), event, _text(r.vessel_mmsi))
        order = _text(r.lm_order)
        if order is not None and (facts["lm_order"] is None or order > facts["lm_order"]):
            facts.update(lm_order=order, eway_ms=None if pd.isna(r.eway_ms) else int(r.eway_ms))

    def _evaluate(self, shipment: str, facts: dict, latest: dict, now_ms: int) -> Iterator[pd.DataFrame]:
        now = now_ms // 1000
        dep, arr = latest.get("vessel_departed"), latest.get("vessel_arrived")
        delivered = "delivered" in latest
        gap = _GAP_S.get(facts["event_type"])
        due = {}
        if gap is not None:
            due["silence"] = (facts["actual_s"] + gap + 1) * 1000
        if arr is not None and "customs_release" not in latest:
            due["customs"] = (arr[0] + _CUSTOMS_S + 1) * 1000
        if facts["eway_ms"] is not None and not delivered:
            due["eway"] = facts["eway_ms"] + 1
        late = dep is not None and dep[1] is not None and dep[0] - dep[1] > config.LATE_DEPARTURE_H * 3600
        stalled = (dep is not None and arr is None and bool(dep[3])
                   and (facts["anchor_hours"] or 0.0) > config.VESSEL_STALLED_H)
        is_open = ("silence" in due and now_ms >= due["silence"], late, "customs" in due and now_ms >= due["customs"],
                   stalled, "eway" in due and now_ms >= due["eway"])
        flags = sum(1 << i for i, on in enumerate(is_open) if on)
        changed = flags ^ facts["open_flags"]
        facts.update(open_flags=flags, seq=facts["seq"] + 1)
        self.facts.update(tuple(facts[n] for n in _FACT_NAMES))
        if self.grace_s is not None and delivered:
            due["expiry"] = (facts["actual_s"] + self.grace_s) * 1000
        self._arm({name: at for name, at in due.items() if at > now_ms or name == "expiry"}, now_ms)
        found = [(shipment, t, is_open[i], pd.Timestamp(now, unit="s"), facts["seq"], facts["carrier"])
                 for i, t in enumerate(FLAG_TYPES) if changed & (1 << i)]
        if found:
            yield pd.DataFrame(found, columns=[f.split()[0] for f in OUTPUT_SCHEMA.split(", ")])

    def _arm(self, due: dict, now_ms: int) -> None:
        """Set the named timers; an instant that two names share is one timer, and goes with the last of them."""
        held = {name[0]: at[0] for name, at in self.deadlines.iterator()}
        if held == due:
            return
        for name in held.keys() - due.keys():
            self.deadlines.removeKey((name,))
        for name, at in due.items():
            if held.get(name) != at:
                self.deadlines.updateValue((name,), (at,))
        for at in set(held.values()) - set(due.values()):
            if at > now_ms:
                self.handle.deleteTimer(at)
        for at in set(due.values()) - set(held.values()):
            self.handle.registerTimer(max(at, now_ms + 1))


def exception_flags(silver_stream: DataFrame, delay: str = "1 day", expire_delivered_after_h: float | None = None,
                    anchor_stream: DataFrame | None = None, last_mile_order: Column | None = None) -> DataFrame:
    """Change log of the five exception flags from a stream of silver events.

    ``silver_stream``: ``event_id, shipment_id, carrier, event_type,
    planned_ts, actual_ts, ms_idx`` and, for the vessel and e-way rules,
    ``vessel_mmsi``, ``delivery_address`` and ``eway_ts``; a missing one leaves
    its rule silent.  ``last_mile_order`` is a text that sorts last-mile rows by
    ingest order (default: by event time, then id).  ``anchor_stream``:
    ``shipment_id, anchor_hours, at``, the hours at anchor of the vessel a
    shipment departed on, as they grow (``voyage_anchor_hours``).

    Events older than the watermark delay are dropped by Spark.
    ``expire_delivered_after_h`` bounds the state: a delivered shipment's state
    goes once the watermark is that far past its last milestone (its flags stay
    as last logged; a later event starts anew).
    """
    use_rocksdb(silver_stream.sparkSession)
    has = set(silver_stream.columns)
    given = lambda name, kind: F.col(name).cast(kind) if name in has else F.lit(None).cast(kind)
    order = last_mile_order if last_mile_order is not None else F.concat(
        F.date_format("actual_ts", "yyyyMMddHHmmss"), F.lit(" "), F.col("event_id"))
    rows = silver_stream.select(
        "shipment_id", F.lit("event").alias("kind"), "event_id", "carrier", "event_type",
        F.col("ms_idx").cast("long").alias("ms_idx"), F.unix_seconds("actual_ts").alias("actual_s"),
        F.unix_seconds("planned_ts").alias("planned_s"), given("vessel_mmsi", "string").alias("vessel_mmsi"),
        F.when(F.length(given("delivery_address", "string")) > 0, order).alias("lm_order"),
        F.unix_millis(given("eway_ts", "timestamp")).alias("eway_ms"), F.lit(None).cast("double").alias("anchor_hours"),
        F.col("actual_ts").alias("at"))
    if anchor_stream is not None:
        rows = rows.unionByName(anchor_stream.select(
            "shipment_id", F.lit("anchor").alias("kind"), F.col("anchor_hours").cast("double").alias("anchor_hours"), "at"),
            allowMissingColumns=True)
    grace = int(expire_delivered_after_h * 3600) if expire_delivered_after_h is not None else None
    return rows.withWatermark("at", delay).groupBy("shipment_id").transformWithStateInPandas(
        ShipmentFlags(grace), OUTPUT_SCHEMA, "Append", "EventTime")


def voyage_anchor_hours(departed: DataFrame, dwell_totals: DataFrame, at: Column) -> DataFrame:
    """Rows for ``anchor_stream``: the anchor hours of each departed shipment's vessel.

    ``departed``: ``shipment_id, vessel_mmsi``; ``dwell_totals``: ``mmsi,
    anchor_hours`` (a micro-batch of vessels whose total grew, or all)."""
    totals = dwell_totals.select(F.col("mmsi").alias("vessel_mmsi"), "anchor_hours")
    return departed.select("shipment_id", "vessel_mmsi").join(totals, "vessel_mmsi").select(
        "shipment_id", F.col("anchor_hours").cast("double").alias("anchor_hours"), at.alias("at"))


def open_flags(change_log: DataFrame) -> DataFrame:
    """Flags open after the last evaluation of each (shipment, type)."""
    last = change_log.groupBy("shipment_id", "exception_type").agg(
        F.max_by("is_open", "seq").alias("is_open"))
    return last.where("is_open").select("shipment_id", "exception_type")
