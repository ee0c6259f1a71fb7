"""The carrier/AIS lake as one lazily built set of DataFrames.

``Lake(spark, sf_dir, asof)`` derives the raw feeds from the benchmark tables
and exposes every silver and gold table as a property.  Nothing is executed
until an action runs; properties are memoised so a table used twice in one
plan is the same logical subtree (Spark reuses the exchange when it can).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.timefmt import asof_literal, to_datetime
from tidewater.operators import ais, enrich, gold, normalize, rules, state
from tidewater.session import ensure_conf
from tidewater.sources import feeds

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_LAKES: dict = {}


@dataclass
class Lake:
    spark: SparkSession
    sf_dir: str
    asof: str | datetime = feeds.DEFAULT_ASOF
    _cache: dict = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        ensure_conf(self.spark)
        self.asof = to_datetime(self.asof)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, asof: str | datetime = feeds.DEFAULT_ASOF) -> "Lake":
        """The lake for these inputs, built once per session: its DataFrames
        (plans, not data) are reused by every query over the same tables and
        instant.  Physical planning still happens at each action, under the
        session's current settings."""
        key = (id(spark), sf_dir.rstrip("/"), to_datetime(asof))
        lake = _LAKES.get(key)
        if lake is None or lake.spark is not spark:
            lake = _LAKES[key] = cls(spark, sf_dir, asof)
        ensure_conf(spark)
        return lake

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def at(self, asof: str | datetime) -> "Lake":
        """The same lake evaluated at another instant."""
        return Lake.of(self.spark, self.sf_dir, asof)

    def shifted(self, hours: float) -> "Lake":
        return self.at(self.asof + timedelta(hours=hours))

    # ---- carrier feed -> silver -----------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        return feeds.carrier_feed(self.table("lineitem"), self.table("orders"))

    @cached_property
    def classified(self) -> DataFrame:
        return normalize.classify(self.raw)

    @cached_property
    def deduped(self) -> DataFrame:
        return normalize.dedupe_classified(self.classified)

    @cached_property
    def silver(self) -> DataFrame:
        return normalize.silver_events(self.deduped)

    @cached_property
    def silver_asof(self) -> DataFrame:
        """The silver events that had happened by ``asof``."""
        return self.silver.where(F.col("actual_ts") <= asof_literal(self.asof))

    @cached_property
    def last_mile(self) -> DataFrame:
        return normalize.last_mile(self.deduped)

    @cached_property
    def quarantine(self) -> DataFrame:
        return normalize.quarantine_rows(self.classified)

    @cached_property
    def counters(self) -> DataFrame:
        return normalize.run_counters(self.classified)

    @cached_property
    def state(self) -> DataFrame:
        # milestones and the latest last-mile row in one per-shipment aggregate
        return state.shipment_state(normalize.silver_with_last_mile(self.deduped))

    @cached_property
    def state_asof(self) -> DataFrame:
        """Shipment state at ``asof``: the cut comes after de-duplication, so
        every instant reads the same de-duplicated events."""
        known = self.deduped.where(F.col("actual_ts") <= asof_literal(self.asof))
        return state.shipment_state(normalize.silver_with_last_mile(known))

    @cached_property
    def legs(self) -> DataFrame:
        return state.shipment_legs(self.state)

    @cached_property
    def last_mile_latest(self) -> DataFrame:
        return state.latest_last_mile(self.last_mile)

    # ---- AIS -------------------------------------------------------------
    @cached_property
    def positions(self) -> DataFrame:
        return feeds.ais_positions(self.table("events"))

    @cached_property
    def vessel_dwell(self) -> DataFrame:
        return ais.vessel_dwell(self.positions)

    @cached_property
    def port_congestion(self) -> DataFrame:
        return ais.port_congestion(self.vessel_dwell)

    @cached_property
    def dwell_totals(self) -> DataFrame:
        return ais.dwell_totals(self.vessel_dwell)

    @cached_property
    def dim_vessel_silver(self) -> DataFrame:
        return ais.vessel_static(feeds.ais_static(self.table("events")))

    # ---- conditions and causes --------------------------------------------
    @cached_property
    def port_conditions(self) -> DataFrame:
        return enrich.conditions_from_observations(feeds.supplier_conditions(self.table("supplier")))

    @cached_property
    def port_causes(self) -> DataFrame:
        return rules.port_causes(ais.latest_by(self.port_conditions, "port"),
                                 ais.latest_by(self.port_congestion, "port"), self.spark)

    # ---- exceptions ------------------------------------------------------
    @cached_property
    def exception_queue(self) -> DataFrame:
        return rules.detect_exceptions(self.state_asof, self.asof, self.dwell_totals, None, self.port_causes)

    # ---- gold ------------------------------------------------------------
    @cached_property
    def fct_events(self) -> DataFrame:
        return gold.fct_shipment_events(self.silver)

    @cached_property
    def scorecard(self) -> DataFrame:
        # Dark shipments are MISSED_MILESTONE rows, a rule of the shipment state
        # alone: the queue without vessel, last-mile and cause inputs has the
        # same ones and skips the AIS and conditions work.
        return gold.carrier_scorecard(self.fct_events, rules.detect_exceptions(self.state_asof, self.asof))

    @cached_property
    def eta_baseline(self) -> DataFrame:
        return gold.eta_baseline(self.fct_events)
