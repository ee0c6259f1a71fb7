"""Registered queries: one callable per operator family, ``(spark, sf_dir) -> DataFrame``.

Each query builds the lake over the given tables (whole tables, the default
``asof``) and returns one table with stable column names.  Instants are
rendered as ISO-8601 UTC text and dates as ``yyyy-MM-dd`` so results compare
byte-for-byte across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions.timefmt import asof_literal, iso
from tidewater.operators import ais, alerts, enrich, eta, gold, metrics, quality
from tidewater.plans.lake import Lake
from tidewater.sinks import tables as sinks
from tidewater.sources import feeds

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _iso_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[iso(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def _date_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.date_format(F.col(c), "yyyy-MM-dd").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ---- normalize -------------------------------------------------------------

@query
def quarantine_counts(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return lk.quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def normalized_events(spark, sf_dir):
    s = Lake.of(spark, sf_dir).silver.drop("ms_idx", "_ingest")
    return _iso_cols(s, "planned_ts", "actual_ts")


@query
def dedup_first_wins(spark, sf_dir):
    """Events that arrived more than once: copies and the kept (first) copy."""
    lk = Lake.of(spark, sf_dir)
    valid = lk.classified.where(F.col("reason").isNull())
    copies = valid.groupBy("event_id").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    kept = lk.silver.select("event_id", "shipment_id", "event_type", "actual_ts",
                            F.col("_ingest.l_orderkey").alias("kept_orderkey"),
                            F.col("_ingest.l_linenumber").alias("kept_linenumber"),
                            F.col("_ingest.l_partkey").alias("kept_partkey"),
                            F.col("_ingest.l_suppkey").alias("kept_suppkey"))
    return _iso_cols(copies.join(kept, "event_id"), "actual_ts")


@query
def run_counters(spark, sf_dir):
    return Lake.of(spark, sf_dir).counters


@query
def shipment_state(spark, sf_dir):
    st = Lake.of(spark, sf_dir).state
    out = st.select(
        "shipment_id", "n_events",
        F.col("last.event_type").alias("last_event_type"),
        F.col("last.carrier").alias("carrier"),
        F.col("last.actual_ts").alias("last_actual_ts"),
        F.col("first_planned_ts"),
        F.col("latest_dest"),
        F.col("vessel_departed.actual_ts").alias("departed_ts"),
        F.col("vessel_departed.vessel_mmsi").alias("departed_mmsi"),
        F.col("vessel_arrived.actual_ts").alias("arrived_ts"),
        F.col("customs_release").isNotNull().alias("has_customs_release"),
        F.col("delivered.actual_ts").alias("delivered_ts"),
    )
    return _iso_cols(out, "last_actual_ts", "first_planned_ts", "departed_ts", "arrived_ts",
                     "delivered_ts")


def _queue(spark, sf_dir, exception_type=None):
    q = Lake.of(spark, sf_dir).exception_queue
    if exception_type:
        q = q.where(F.col("exception_type") == exception_type)
    return _iso_cols(q, "detected_at")


@query
def exc_missed_milestone(spark, sf_dir):
    return _queue(spark, sf_dir, "MISSED_MILESTONE")


@query
def exc_late_departure(spark, sf_dir):
    return _queue(spark, sf_dir, "LATE_DEPARTURE")


@query
def exc_customs_dwell(spark, sf_dir):
    return _queue(spark, sf_dir, "CUSTOMS_DWELL")


@query
def exc_vessel_stalled(spark, sf_dir):
    return _queue(spark, sf_dir, "VESSEL_STALLED")


@query
def exc_eway_expired(spark, sf_dir):
    return _queue(spark, sf_dir, "EWAY_BILL_EXPIRED")


@query
def exception_queue(spark, sf_dir):
    return _queue(spark, sf_dir)


@query
def probable_cause(spark, sf_dir):
    q = Lake.of(spark, sf_dir).exception_queue
    return q.groupBy("exception_type", "probable_cause").agg(F.count(F.lit(1)).alias("exceptions"))


@query
def shipment_legs(spark, sf_dir):
    return Lake.of(spark, sf_dir).legs


@query
def last_mile_pins(spark, sf_dir):
    lm = Lake.of(spark, sf_dir).last_mile.drop("_ingest")
    return _iso_cols(lm, "eway_valid_until")


# ---- AIS and conditions ----------------------------------------------------

@query
def anchor_hours(spark, sf_dir):
    return _date_cols(Lake.of(spark, sf_dir).vessel_dwell, "date")


@query
def port_congestion(spark, sf_dir):
    return _date_cols(Lake.of(spark, sf_dir).port_congestion, "date")


@query
def vessel_static(spark, sf_dir):
    return _iso_cols(Lake.of(spark, sf_dir).dim_vessel_silver, "observed_at")


@query
def dim_vessel_full_outer(spark, sf_dir):
    return _iso_cols(gold.dim_vessel(Lake.of(spark, sf_dir).dim_vessel_silver), "observed_at")


@query
def port_conditions(spark, sf_dir):
    return _date_cols(Lake.of(spark, sf_dir).port_conditions, "date")


# ---- gold ------------------------------------------------------------------

@query
def fct_shipment_events(spark, sf_dir):
    f = Lake.of(spark, sf_dir).fct_events.drop("delay_min")
    return _iso_cols(f, "planned_ts", "actual_ts")


@query
def fct_shipment_legs(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return gold.fct_shipment_legs(lk.legs, gold.dim_vessel(lk.dim_vessel_silver))


@query
def carrier_scorecard(spark, sf_dir):
    return Lake.of(spark, sf_dir).scorecard


@query
def eta_baseline(spark, sf_dir):
    return Lake.of(spark, sf_dir).eta_baseline


@query
def exception_mart(spark, sf_dir):
    return gold.exception_mart(Lake.of(spark, sf_dir).exception_queue)


# ---- ETA -------------------------------------------------------------------

def _mart_offsets(lk: Lake) -> DataFrame:
    return lk.eta_baseline.where(F.col("event_type") == "delivered").select("carrier", "lane", "median_offset_h")


@query
def shipment_eta(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return eta.format_eta(eta.shipment_eta(lk.state_asof, lk.exception_queue, _mart_offsets(lk)))


@query
def eta_mae(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return eta.evaluate(lk.silver, lk.state, lk.exception_queue)


# ---- alerts ----------------------------------------------------------------

PRIOR_STATE_HOURS = -72  # prior alert state: the queue three days before asof


def _decisions(lk: Lake) -> tuple[DataFrame, DataFrame]:
    prior = lk.shifted(PRIOR_STATE_HOURS)
    state = alerts.state_from_queue(prior.exception_queue, prior.asof)
    return alerts.decide(lk.exception_queue, state), state


@query
def alert_decisions(spark, sf_dir):
    return _decisions(Lake.of(spark, sf_dir))[0]


@query
def alert_state_next(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    decisions, state = _decisions(lk)
    return _iso_cols(alerts.next_state(state, decisions, lk.asof), "alerted_at")


@query
def quarantine_spike(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    state = alerts.state_from_queue(lk.exception_queue, lk.asof)
    share = alerts.quarantine_share(lk.counters)
    fired = alerts.quarantine_spike(lk.counters, state, lk.asof).select("exception_id", "message")
    # both sides have at most one row; joined on a constant key
    return share.withColumn("_k", F.lit(1)).join(fired.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")


# ---- quality ---------------------------------------------------------------

@query
def quality_checks(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    fct, q = lk.fct_events, lk.exception_queue
    legs = gold.fct_shipment_legs(lk.legs, gold.dim_vessel(lk.dim_vessel_silver))
    # one pass a table
    checks = [
        quality.table_checks(fct, [
            ("unique", "event_id", "unique_fct_shipment_events_event_id"),
            ("not_null", "event_id", "not_null_fct_shipment_events_event_id"),
            ("accepted", "event_type", config.MILESTONES, "accepted_values_fct_shipment_events_event_type"),
            ("rows", lk.silver, "fct_events_reconcile_silver")]),
        quality.table_checks(q, [
            ("unique", "exception_id", "unique_stg_exception_queue_exception_id"),
            ("not_null", "exception_id", "not_null_stg_exception_queue_exception_id"),
            ("accepted", "probable_cause", config.PROBABLE_CAUSES, "accepted_values_stg_exception_queue_probable_cause")]),
        quality.table_checks(legs, [
            ("unique", "shipment_id", "unique_fct_shipment_legs_shipment_id"),
            ("not_null", "shipment_id", "not_null_fct_shipment_legs_shipment_id")]),
        quality.not_null(lk.scorecard, "carrier", "not_null_carrier_scorecard_carrier"),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


# ---- metrics and questions --------------------------------------------------

@query
def run_metrics(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return metrics.run_metrics(lk.counters, lk.exception_queue)


@query
def slo_freshness(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return metrics.slo_freshness(lk.silver_asof, lk.asof)


def _marts(lk: Lake) -> dict[str, DataFrame]:
    return {"carrier_scorecard": lk.scorecard, "eta_baseline": lk.eta_baseline}


@query
def governed_metric(spark, sf_dir):
    return metrics.governed_values(_marts(Lake.of(spark, sf_dir)))


def _questions(lk: Lake) -> DataFrame:
    return lk.table("conversations").where(F.col("role") == "user").select(
        F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("question_id"),
        F.col("text").alias("question"))


@query
def question_table(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return metrics.answer_questions(_questions(lk), _marts(lk))


@query
def question_answers(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return metrics.answer_questions(_questions(lk), _marts(lk), cite=True)


# ---- keyed upsert and snapshots ---------------------------------------------

UPSERT_SPLIT = "2024-01-15 00:00:00"


@query
def upsert_by_key(spark, sf_dir):
    """dim_vessel (silver) kept from the first half of the AIS days, then the
    second half's statics upserted by MMSI."""
    lk = Lake.of(spark, sf_dir)
    ev = lk.table("events")
    split = F.lit(UPSERT_SPLIT).cast("timestamp_ntz")
    old = ais.vessel_static(feeds.ais_static(ev.where(F.col("ts") < split)))
    new = ais.vessel_static(feeds.ais_static(ev.where(F.col("ts") >= split)))
    return _iso_cols(sinks.upsert_by_key(old, new, ["mmsi"]), "observed_at")


SNAPSHOT_HOURS = (-48, -24, 0)
SNAPSHOT_READ_HOURS = -12


@query
def snapshot_asof(spark, sf_dir):
    """The exception queue as it was 12 h before asof, read from queue
    snapshots taken at asof - 48 h, - 24 h and asof."""
    lk = Lake.of(spark, sf_dir)
    snaps = None
    for h in SNAPSHOT_HOURS:
        at = lk.shifted(h)
        s = at.exception_queue.withColumn("snapshot_ts", asof_literal(at.asof))
        snaps = s if snaps is None else snaps.unionByName(s)
    read_at = lk.shifted(SNAPSHOT_READ_HOURS).asof
    return _iso_cols(sinks.snapshot_as_of(snaps, read_at, computed=True), "detected_at", "snapshot_ts")


# ---- more operator families ---------------------------------------------------

@query
def vessel_dwell_totals(spark, sf_dir):
    return Lake.of(spark, sf_dir).dwell_totals


@query
def box_counts(spark, sf_dir):
    return _date_cols(ais.box_counts(Lake.of(spark, sf_dir).vessel_dwell), "date")


@query
def port_causes(spark, sf_dir):
    return Lake.of(spark, sf_dir).port_causes


@query
def metric_exposition(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return metrics.exposition(metrics.run_metrics(lk.counters, lk.exception_queue))


@query
def ais_run_summary(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return ais.run_summary(lk.positions, feeds.ais_static(lk.table("events")))


@query
def eta_run_summary(spark, sf_dir):
    lk = Lake.of(spark, sf_dir)
    return eta.run_summary(lk.state, _mart_offsets(lk))


@query
def document_port_mentions(spark, sf_dir):
    """The headline containment join at scale: every document text, whole,
    against the configured port names; every port is reported (0 when no
    text names it)."""
    docs = Lake.of(spark, sf_dir).table("documents").select("text")
    counts = enrich.headline_counts(docs, text_col="text", date_col=None)
    ports = F.broadcast(config.locations_df(spark).select(F.col("unlocode").alias("port")))
    return ports.join(counts, "port", "left").select(
        "port", F.coalesce(F.col("disruption_news"), F.lit(0)).cast("bigint").alias("disruption_news"))
