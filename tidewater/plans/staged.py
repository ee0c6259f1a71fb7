"""Production batch jobs: each stage writes its tables and the next stage
reads them back, so lineage is cut at every table (a lost executor only
re-runs the current stage) and nothing is recomputed across stages.

    silver  = normalize(raw)            -> classified (staging), deduped (staging), shipment_events,
                                           last_mile, quarantine, run_summary
    ais     = dwell(positions, statics) -> vessel_dwell (by date), port_congestion (by date), dim_vessel
    rules   = exceptions(silver, ais)   -> shipment_state, shipment_legs, exception_queue (+ snapshot)
    gold    = marts(silver, queue)      -> fct_shipment_events, carrier_scorecard, eta_baseline,
                                           exception_mart, shipment_eta
    export  = csv(gold)                 -> export/carrier_scorecard, export/eta_baseline
    alerts  = decide(queue, state)      -> alert_decisions, alert_failures, next alert state version

normalize and ais also log their runs (run_log), which run metrics and freshness read.

All writes are whole-table or whole-partition overwrites (or new versions), so
re-running a stage after a failure gives the same tables.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.timefmt import asof_literal, to_datetime
from tidewater.operators import ais, alerts, enrich, eta, gold, normalize, rules, state
from tidewater.session import ensure_conf
from tidewater.sinks import tables


class Tables:
    """Table locations under one root (a shared folder on a cluster)."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


#: Tables of other jobs that the rules read; one that is not there yet is empty.
DWELL = "mmsi string, date date, box string, anchor_hours bigint"
CONGESTION = "port string, date date, vessels_at_anchor bigint, avg_dwell_h double"
CONDITIONS = ("port string, date date, weather_alerts bigint, weather_code string, wind_max_kmh double, "
              "precip_mm double, disruption_news bigint")


def _log_run(spark: SparkSession, t: Tables, job: str, asof: str, began: float, rows: int) -> None:
    """One row for each job and instant; a repeated run replaces its own."""
    spark.range(1).select(F.lit(job).alias("job"), F.lit(asof).alias("run"), F.current_timestamp().alias("finished_at"),
                          F.lit(time.monotonic() - began).alias("seconds"), F.lit(rows).cast("bigint").alias("rows")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("job", "run").parquet(t.run_log)


def normalize_stage(spark: SparkSession, raw: DataFrame, t: Tables, asof: str | datetime) -> dict:
    """One pass over the raw feed: classified rows are written once (split by
    validity), quarantine and counters read that table, de-duplication reads
    its valid half once, and silver / last-mile are projections of the
    de-duplicated table."""
    ensure_conf(spark)
    began = time.monotonic()
    cls = normalize.classify(raw).withColumn("valid", F.col("reason").isNull())
    cls.write.mode("overwrite").partitionBy("valid").parquet(t.classified)
    staged = spark.read.parquet(t.classified).withColumn("valid", F.col("valid").cast("boolean"))
    bad = staged.where(~F.col("valid")).drop("valid", "_ingest", "_malformed", "event_type", "actual_ts",
                                            "planned_ts", "ms_idx", "eway_ts")
    if "date" in bad.columns:
        tables.overwrite_partitions(bad, t.quarantine, "date", scope=staged)
    dd = normalize.dedupe(staged.where(F.col("valid")).drop("valid"))
    dd.write.mode("overwrite").parquet(t.deduped)
    dd = spark.read.parquet(t.deduped)
    tables.write_sorted(normalize.silver_events(dd).drop("_ingest"), t.shipment_events,
                        ["shipment_id", "actual_ts", "event_id"])
    tables.write_sorted(normalize.last_mile(dd), t.last_mile, ["shipment_id"])
    counters = normalize.run_counters(staged).withColumn("asof", asof_literal(asof)) \
        .withColumn("run_ts", F.current_timestamp())
    # one row for each instant: a repeated run replaces its own
    counters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("asof").parquet(t.run_summary)
    summary = spark.read.parquet(t.run_summary).orderBy(F.desc("run_ts")).first().asDict()  # one row
    _log_run(spark, t, "normalize", to_datetime(asof).isoformat(), began, summary["events_read"])
    return summary


def ais_stage(spark: SparkSession, positions: DataFrame, statics: DataFrame, t: Tables) -> None:
    ensure_conf(spark)
    began = time.monotonic()
    # dates without an anchored vessel in this run lose the rows that an earlier run gave them
    dates = positions.select(F.to_date("received_at").alias("date")).where("date IS NOT NULL")
    tables.overwrite_partitions(ais.vessel_dwell(positions), t.vessel_dwell, "date", scope=dates)
    # congestion only for the dates this run wrote (partition pruning on the dwell table)
    lo, hi, reports = positions.agg(F.min(F.to_date("received_at")), F.max(F.to_date("received_at")),
                                    F.count(F.lit(1))).first()
    if lo is not None:
        written = tables.read_or_empty(spark, t.vessel_dwell, DWELL).where(F.col("date").between(F.lit(lo), F.lit(hi)))
        tables.overwrite_partitions(ais.port_congestion(written), t.port_congestion, "date", scope=dates)
    current = tables.read_current(spark, t.dim_vessel)
    new = ais.vessel_static(statics)
    merged = new if current is None else tables.upsert_by_key(current, new, ["mmsi"])
    tables.write_version(merged, t.dim_vessel)
    _log_run(spark, t, "ais", str(hi), began, reports)


def conditions_stage(spark: SparkSession, observations: DataFrame, t: Tables) -> None:
    tables.overwrite_partitions(enrich.conditions_from_observations(observations), t.port_conditions, "date")


def rules_stage(spark: SparkSession, t: Tables, asof: str | datetime) -> None:
    """Shipment state (milestones and the latest last-mile row, one aggregate)
    at ``asof`` is written as a table; legs and the exception queue are read
    from it."""
    ensure_conf(spark)
    dd = spark.read.parquet(t.deduped).where(F.col("actual_ts") <= asof_literal(asof))
    state.shipment_state(normalize.silver_with_last_mile(dd)).write.mode("overwrite").parquet(t.shipment_state)
    st = spark.read.parquet(t.shipment_state)
    tables.write_sorted(state.shipment_legs(st), t.shipment_legs, ["shipment_id"])
    dwell = tables.read_or_empty(spark, t.vessel_dwell, DWELL)
    cond = tables.read_or_empty(spark, t.port_conditions, CONDITIONS)
    cong = tables.read_or_empty(spark, t.port_congestion, CONGESTION)
    causes = rules.port_causes(ais.latest_by(cond, "port"), ais.latest_by(cong, "port"), spark)
    q = rules.detect_exceptions(st, asof, ais.dwell_totals(dwell), None, causes)
    tables.write_sorted(q, t.exception_queue, ["exception_id"])
    tables.append_snapshot(spark.read.parquet(t.exception_queue), t.exception_queue_snapshots, asof)


def gold_stage(spark: SparkSession, t: Tables) -> None:
    ensure_conf(spark)
    silver = spark.read.parquet(t.shipment_events)
    queue = spark.read.parquet(t.exception_queue)
    fct = gold.fct_shipment_events(silver)
    fct.write.mode("overwrite").parquet(t.fct_shipment_events)
    fct = spark.read.parquet(t.fct_shipment_events)
    tables.write_sorted(gold.carrier_scorecard(fct, queue), t.carrier_scorecard, ["carrier", "lane"])
    tables.write_sorted(gold.eta_baseline(fct), t.eta_baseline, ["carrier", "lane", "event_type"])
    gold.exception_mart(queue).write.mode("overwrite").parquet(t.exception_mart)
    offsets = spark.read.parquet(t.eta_baseline).where("event_type = 'delivered'") \
        .select("carrier", "lane", "median_offset_h")
    eta.shipment_eta(spark.read.parquet(t.shipment_state), queue, offsets) \
        .write.mode("overwrite").parquet(t.shipment_eta)


def export_stage(spark: SparkSession, t: Tables) -> None:
    """Gold marts as sorted CSV with a header."""
    for name, keys in (("carrier_scorecard", ["carrier", "lane"]), ("eta_baseline", ["carrier", "lane", "event_type"])):
        tables.write_sorted(spark.read.parquet(f"{t.root}/{name}"), f"{t.export}/{name}", keys, fmt="csv")


def alert_stage(spark: SparkSession, t: Tables, now: str | datetime, delivered: DataFrame | None = None) -> DataFrame:
    """Alert decisions of one instant and the next state; a repeated run of the instant starts from the state before
    it and replaces its decisions.  The quarantine spike is decided and remembered in the same state.
    ``delivered`` (``exception_id, ok``) are the results of sending: a failed alert goes to the failure ledger with
    its exception, stays out of the state and so is decided again by the next run."""
    ensure_conf(spark)
    queue = spark.read.parquet(t.exception_queue)
    run = to_datetime(now).isoformat()
    st = tables.read_before(spark, t.alert_state, run)
    if st is None:
        st = spark.createDataFrame([], "exception_id string, type string, band int, alerted_at timestamp")
    at = asof_literal(now)
    write = lambda df, path: df.withColumn("decided_at", at).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("decided_at").parquet(path)
    write(alerts.decide(queue, st), t.alert_decisions)
    written = spark.read.parquet(t.alert_decisions).where(F.col("decided_at") == at).drop("decided_at")
    counters = spark.read.parquet(t.run_summary).where(F.col("asof") == at)
    ops = alerts.quarantine_spike(counters, st, now)
    write(ops, t.ops_alerts)
    if delivered is not None:
        write(alerts.failures(written, delivered, now, queue), t.alert_failures)
    tables.write_version(alerts.next_state(st, written, now, delivered, ops), t.alert_state, run)
    return written


def run_all(spark: SparkSession, raw: DataFrame, positions: DataFrame, statics: DataFrame,
            observations: DataFrame, root: str, asof: str | datetime) -> dict:
    """Every stage in order; returns the normalize run summary."""
    t = Tables(root)
    asof = to_datetime(asof)
    summary = normalize_stage(spark, raw, t, asof)
    ais_stage(spark, positions, statics, t)
    conditions_stage(spark, observations, t)
    rules_stage(spark, t, asof)
    gold_stage(spark, t)
    export_stage(spark, t)
    alert_stage(spark, t, asof)
    return summary

