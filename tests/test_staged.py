"""The staged batch job writes the same tables the lazy queries compute."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF001
from tidewater.operators import metrics
from tidewater.plans import staged
from tidewater.plans.lake import Lake
from tidewater.sources import feeds


def test_staged_job_matches_queries_and_reruns(spark, tmpdir_path):
    lk = Lake(spark, SF001)
    ev = lk.table("events")
    args = (lk.raw, feeds.ais_positions(ev), feeds.ais_static(ev), feeds.supplier_conditions(lk.table("supplier")))
    root = os.path.join(tmpdir_path, "lake")
    summary = staged.run_all(spark, *args, root, lk.asof)
    assert summary["events_read"] == lk.raw.count()
    t = staged.Tables(root)
    cols = ["exception_id", "exception_type", "age_hours", "detail", "probable_cause"]
    written = spark.read.parquet(t.exception_queue).select(*cols)
    assert written.exceptAll(lk.exception_queue.select(*cols)).count() == 0
    n = written.count()
    assert n == lk.exception_queue.count()
    decided = spark.read.parquet(t.alert_decisions)
    assert decided.where("decision = 'new'").count() == n
    # rerun: tables are overwritten, not appended; the alerts of the instant are the same
    staged.run_all(spark, *args, root, lk.asof)
    assert spark.read.parquet(t.exception_queue).count() == n
    assert spark.read.parquet(t.shipment_events).count() == lk.silver.count()
    last = spark.read.parquet(t.alert_decisions).groupBy("decision").count().collect()
    assert {r.decision: r["count"] for r in last} == {"new": n}
    # an hour later nothing is new
    later = lk.asof + timedelta(hours=1) if isinstance(lk.asof, datetime) else "1998-07-01T01:00:00Z"
    assert {r.decision for r in staged.alert_stage(spark, t, later).select("decision").distinct().collect()} == {"suppressed"}
    # marts are exported in order, empty fields for nulls
    out = spark.read.option("header", True).csv(f"{t.export}/eta_baseline")
    assert out.count() == spark.read.parquet(t.eta_baseline).count() > 0
    # every run is logged once, and freshness counts from its end
    runs = spark.read.parquet(t.run_log)
    assert {r.job for r in runs.collect()} == {"normalize", "ais"} and runs.count() == 2
    end = {r.job: r.finished_at for r in runs.collect()}
    fresh = {r.slo: r for r in metrics.run_freshness(runs, end["normalize"] + timedelta(seconds=4499)).collect()}
    assert fresh["normalize_freshness"].ok and 4498 <= fresh["normalize_freshness"].lag_s <= 4500
    assert not fresh["ais_staleness"].ok
    values = {(r.metric, r.label): r.value for r in metrics.job_metrics(runs).collect()}
    assert values["rows_read", 'job="normalize"'] == summary["events_read"]
    assert values["run_seconds", 'job="ais"'] >= 1
    # failed alerts are kept with their exception and decided again
    spare = staged.Tables(os.path.join(tmpdir_path, "spare"))
    for name in ("exception_queue", "run_summary"):
        spark.read.parquet(f"{t.root}/{name}").write.parquet(f"{spare.root}/{name}")
    queue = spark.read.parquet(spare.exception_queue)
    bad = queue.select("exception_id", (F.col("exception_type") != "CUSTOMS_DWELL").alias("ok"))
    staged.alert_stage(spark, spare, lk.asof, bad)
    held = queue.where("exception_type = 'CUSTOMS_DWELL'").count()
    kept = spark.read.parquet(spare.alert_failures)
    assert held and kept.count() == kept.where("exception.exception_type = 'CUSTOMS_DWELL'").count() == held
    again = {r.decision: r["count"] for r in staged.alert_stage(spark, spare, later).groupBy("decision").count().collect()}
    assert again == {"new": held, "suppressed": n - held}


def test_ais_rerun_clears_dates_and_rules_stand_without_other_jobs(spark, tmpdir_path):
    lk = Lake(spark, SF001)
    ev = lk.table("events")
    positions, statics = feeds.ais_positions(ev), feeds.ais_static(ev)
    t = staged.Tables(os.path.join(tmpdir_path, "lake"))
    staged.ais_stage(spark, positions, statics, t)
    day = spark.read.parquet(t.vessel_dwell).agg(F.min("date")).first()[0]
    on_day = F.to_date("received_at") == F.lit(day)
    adrift = positions.where(on_day).withColumns({c: F.lit(0.0) for c in ("lat", "lon")})
    staged.ais_stage(spark, adrift, statics, t)
    for name in (t.vessel_dwell, t.port_congestion):
        assert spark.read.parquet(name).where(F.col("date") == F.lit(day)).count() == 0
        assert spark.read.parquet(name).count() > 0
    alone = staged.Tables(os.path.join(tmpdir_path, "alone"))
    staged.normalize_stage(spark, lk.raw, alone, lk.asof)
    staged.rules_stage(spark, alone, lk.asof)
    kinds = {r.exception_type for r in spark.read.parquet(alone.exception_queue).select("exception_type").distinct().collect()}
    assert kinds and "VESSEL_STALLED" not in kinds
