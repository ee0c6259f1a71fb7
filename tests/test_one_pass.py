"""Steps that several queries share read and parse their rows once."""

from pyspark.sql import functions as F

from conftest import SF001
from tidewater.operators import metrics, normalize, quality, state
from tidewater.plans import queries as Q
from tidewater.plans.lake import Lake
from tidewater.sinks import tables as sinks


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_feed_is_parsed_once(spark):
    plan = _plan(Lake(spark, SF001).deduped)
    # the three times of a record, in two text formats each
    assert plan.count("gettimestamp(") == 6
    assert all("RLIKE" not in line for line in plan.splitlines() if "Join" in line)


def test_dedupe_passes_over_bad_rows(spark):
    kept = [c for c in normalize.KEPT_COLUMNS if c not in ("ref", "actual_ts")]
    rows = spark.createDataFrame(
        [("a", "bad first", 1, "unknown_status"), ("a", "second", 2, None), ("a", "third", 3, None),
         ("b", "only bad", 4, "unmapped_ref"), (None, "no id", 5, "malformed_record"), ("c", None, 6, None)],
        "event_id string, ref string, _ingest int, reason string").select(
            "*", F.lit(None).cast("timestamp").alias("actual_ts"), *[F.lit(None).cast("string").alias(c) for c in kept])
    got = normalize.dedupe_classified(rows)
    assert sorted((r.event_id, r.ref, r._ingest) for r in got.collect()) == [("a", "second", 2), ("c", None, 6)]
    want = normalize.dedupe(normalize.valid_rows(rows))
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_checks_of_a_table_in_one_pass(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "z", 1), (None, None, 1), ("b", "z", None)],
                               "id string, kind string, n int")
    checks = [("unique", "id", "u"), ("not_null", "id", "n"), ("accepted", "kind", ["x"], "v"), ("unique", "n", "un"),
              ("not_null", "n", "nn"), ("rows", df.limit(3), "r"), ("rows", df, "same"), ("accepted", "n", [2], "vn")]
    got = {r.test_name: r.failures for r in quality.table_checks(df, checks).collect()}
    assert got == {"u": 1, "n": 2, "v": 2, "un": 1, "nn": 1, "r": 1, "same": 0, "vn": 1}
    none = {r.test_name: r.failures for r in quality.table_checks(df.limit(0), checks).collect()}
    assert none == {"u": 0, "n": 0, "v": 0, "un": 0, "nn": 0, "r": 1, "same": 1, "vn": 0}


def test_quality_checks_read_a_table_once(spark):
    # facts, their count against silver, the scorecard
    assert _plan(Q.quality_checks(spark, SF001)).count("Aggregate [event_id") <= 6


def test_run_metrics_count_the_queue_once(spark):
    counters = spark.createDataFrame([(3, 2, 1, 0, 0, 0, 0)], ["events_read", "events_processed", "duplicates"] + [
        f"quarantined_{r}" for r in ("malformed_record", "unmapped_ref", "unknown_status", "unparseable_time")])
    queue = spark.createDataFrame([("L",), ("L",), ("M",), (None,)], "exception_type string")
    got = {(r.metric, r.label): r.value for r in metrics.run_metrics(counters, queue).where("metric like 'exc%'").collect()}
    assert got == {("exceptions_by_type", 'type="L"'): 2, ("exceptions_by_type", 'type="M"'): 1,
                   ("exceptions_by_type", None): 1, ("exceptions", ""): 4}
    empty = metrics.run_metrics(counters, queue.limit(0)).where("metric like 'exc%'").collect()
    assert [(r.metric, r.label, r.value) for r in empty] == [("exceptions", "", 0)]
    assert _plan(metrics.run_metrics(counters, queue.repartition(2))).count("Repartition") == 1


def test_snapshots_are_computed_once(spark):
    snaps = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("v"), F.max("id").alias("w")) \
        .select("*", F.timestamp_seconds(F.col("k") * 3600).alias("snapshot_ts"))
    df = sinks.snapshot_as_of(snaps, "1970-01-01T03:30:00Z", computed=True)
    assert [(r.k, r.v) for r in df.collect()] == [(3, sum(range(3, 100, 7)))]
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
    assert sinks.snapshot_as_of(snaps, "1969-01-01T00:00:00Z", computed=True).count() == 0


def _silver(spark, rows):
    cols = ("event_id string, shipment_id string, carrier string, event_type string, ms_idx int, at long, vessel_mmsi string, "
            "dest string, delivery_address string, eway_bill_no string, _ingest int")
    return spark.createDataFrame(rows, cols).select(
        "*", F.timestamp_seconds("at").alias("actual_ts"), F.timestamp_seconds(F.col("at") * 10).alias("planned_ts"),
        F.timestamp_seconds("_ingest").alias("eway_ts"), F.lit("O").alias("origin")).drop("at")


def test_state_keeps_each_pick_once(spark):
    silver = _silver(spark, [
        ("e1", "S", "C", "vessel_departed", 4, 50, "7", "D1", None, None, 1),
        ("e2", "S", "C", "vessel_departed", 4, 50, "8", "D2", "", "no address", 9),  # a tie in time: the larger id is later
        ("e0", "S", "C", "gate_in", 2, 90, None, "D3", "road", "bill", 3),
        ("e4", "S", "C", "gate_in", 2, None, "9", None, "road", "unplaced", None),   # no time is before any
        ("e5", None, "C", None, None, 5, None, None, None, None, 5)])
    st = state.shipment_state(silver)
    rows = {r.shipment_id: r for r in st.collect()}
    s, none = rows["S"], rows[None]
    assert len(rows) == 2 and s.n_events == 4 and none.n_events == 1
    secs = lambda t: t and int(t.timestamp())
    assert (s["last"].event_type, s["last"].dest, secs(s["last"].planned_ts)) == ("vessel_departed", "D2", 500)
    assert s.first_planned_ts is None and s.latest_dest == "D3" and s.first_vessel.vessel_mmsi == "9"
    assert secs(s.first_departed_planned_ts) == 500 and s.vessel_departed.vessel_mmsi == "8"
    assert s.vessel_arrived is None and s.delivered is None and s.last_mile.eway_bill_no == "bill"
    assert none["last"].event_type is None and none.first_vessel is None and none.last_mile is None
    assert st.schema["last"].dataType.names == ["event_type", "ms_idx", "carrier", "planned_ts", "actual_ts", "origin", "dest"]
    # one value a pick, not the ordering fields beside it, and no sort by references that begin alike
    plan = _plan(st)
    assert "max_by" not in plan and "min_by" not in plan and "xxhash64(shipment_id" in plan


def test_dedupe_keeps_the_order_once(spark):
    assert "min_by" not in _plan(Lake(spark, SF001).deduped)
    kept = [c for c in normalize.KEPT_COLUMNS if c != "ref"]
    rows = spark.createDataFrame([("a", "unplaced", None), ("a", "first", 2), ("a", "later", 3), ("b", "unplaced", None)],
                                 "event_id string, ref string, _ingest int") \
        .select("*", *[F.lit(None).cast("string").alias(c) for c in kept])
    assert [(r.event_id, r.ref, r._ingest) for r in normalize.dedupe(rows).collect()] == [("a", "first", 2)]
