"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query's full plan is executed into the ``noop`` sink (every row is
produced, nothing is collected), twice: the first (cold) run includes JIT
warm-up of the generated code, the second is the steady state reported as the
headline.  Both are printed in one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tempfile  # noqa: E402

from tidewater.plans import queries as Q  # noqa: E402
from tidewater.plans import staged  # noqa: E402
from tidewater.plans.lake import Lake  # noqa: E402
from tidewater.session import build_session  # noqa: E402
from tidewater.sources import feeds  # noqa: E402

HEADLINE = ["normalized_events", "exception_queue", "fct_shipment_events", "carrier_scorecard",
            "eta_baseline", "exception_mart", "shipment_eta", "anchor_hours", "alert_decisions",
            "governed_metric"]


def staged_times(spark, sf_dir: str) -> dict:
    """The staged job (each stage writes tables the next reads) into a fresh
    scratch folder ($BENCH_SCRATCH or a new temp dir); seconds per stage."""
    root = tempfile.mkdtemp(prefix="tidewater-bench-", dir=os.environ.get("BENCH_SCRATCH"))
    lk = Lake(spark, sf_dir)
    ev = lk.table("events")
    t = staged.Tables(root)
    steps = [
        ("normalize", lambda: staged.normalize_stage(spark, lk.raw, t, lk.asof)),
        ("ais", lambda: staged.ais_stage(spark, feeds.ais_positions(ev), feeds.ais_static(ev), t)),
        ("conditions", lambda: staged.conditions_stage(spark, feeds.supplier_conditions(lk.table("supplier")), t)),
        ("rules", lambda: staged.rules_stage(spark, t, lk.asof)),
        ("gold", lambda: staged.gold_stage(spark, t)),
        ("alerts", lambda: staged.alert_stage(spark, t, lk.asof)),
    ]
    out = {}
    for name, fn in steps:
        t0 = time.perf_counter()
        fn()
        out[name] = round(time.perf_counter() - t0, 3)
    out["total"] = round(sum(out.values()), 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", app="tidewater-bench", shuffle_partitions=int(cpus) * 2)
    # warm-up: JVM, parquet footers, codegen caches
    Q.REGISTRY["run_counters"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    cold, warm = {}, {}
    for name in names:
        for runs in (cold, warm):
            t0 = time.perf_counter()
            df = Q.REGISTRY[name](spark, sf_dir)   # plan built each time (includes analysis)
            df.write.format("noop").mode("overwrite").save()
            runs[name] = round(time.perf_counter() - t0, 3)
    stages = staged_times(spark, sf_dir)
    raw = Q.REGISTRY["run_counters"](spark, sf_dir).first()
    total = round(sum(warm.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": warm,
                      "cold_queries": cold, "cold_total": round(sum(cold.values()), 3),
                      "staged_job": stages,
                      "sf": sf, "cpus": int(cpus), "raw_events": raw.events_read,
                      "events_per_sec_normalize": round(raw.events_read / warm["normalized_events"])
                      if "normalized_events" in warm else None}))


if __name__ == "__main__":
    main()
