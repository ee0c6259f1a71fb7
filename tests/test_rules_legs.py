"""Legs and VESSEL_STALLED boundaries, e-way expiry, last-mile order, causes."""

from datetime import datetime

from pyspark.sql import types as T

from tidewater.operators import rules, state

ASOF = "2026-07-21T00:00:00Z"
SCHEMA = T.StructType([T.StructField(c, t) for c, t in [
    ("event_id", T.StringType()), ("shipment_id", T.StringType()), ("carrier", T.StringType()),
    ("event_type", T.StringType()), ("planned_ts", T.TimestampType()), ("actual_ts", T.TimestampType()),
    ("origin", T.StringType()), ("dest", T.StringType()), ("vessel_mmsi", T.StringType()),
    ("ms_idx", T.IntegerType())]])
IDX = {"booking_confirmed": 1, "vessel_departed": 4, "vessel_arrived": 5, "delivered": 8}


def ts(s):
    return datetime.fromisoformat(s)


def silver(spark, rows):
    return spark.createDataFrame([(e, s, "MAEU", t, ts(p), ts(a), "CNSHA", "USLAX", m, IDX[t])
                                  for e, s, t, p, a, m in rows], SCHEMA)


ROWS = [
    ("s1a", "S1", "booking_confirmed", "2026-07-10 00:00:00", "2026-07-10 00:00:00", None),
    ("s1b", "S1", "vessel_departed", "2026-07-12 00:00:00", "2026-07-12 00:00:00", "111"),
    ("s2a", "S2", "booking_confirmed", "2026-07-10 00:00:00", "2026-07-10 00:00:00", None),
]


def dwell(spark, hours):
    return spark.createDataFrame([("111", float(hours))], "mmsi string, anchor_hours double")


def test_one_leg_per_vessel_shipment(spark):
    legs = state.shipment_legs(state.shipment_state(silver(spark, ROWS))).collect()
    assert [(r.shipment_id, r.leg_seq, r.mode, r.vessel_mmsi) for r in legs] == [("S1", 1, "ocean", "111")]


def stalled(spark, rows, hours):
    q = rules.detect_exceptions(state.shipment_state(silver(spark, rows)), ASOF, dwell(spark, hours))
    return [r for r in q.collect() if r.exception_type == "VESSEL_STALLED"]


def test_stalled_fires_above_threshold(spark):
    got = stalled(spark, ROWS, 100)
    assert len(got) == 1 and got[0].age_hours == 28.0
    assert got[0].detail == "vessel 111 at anchor 100h mid-voyage"


def test_stalled_boundaries(spark):
    assert stalled(spark, ROWS, 10) == []
    assert stalled(spark, ROWS, 72) == []  # strictly greater
    arrived = ROWS + [("s1c", "S1", "vessel_arrived", "2026-07-20 00:00:00", "2026-07-20 00:00:00", None)]
    assert stalled(spark, arrived, 100) == []


def test_gap_exactly_at_threshold_does_not_fire(spark):
    rows = [("g1", "G", "booking_confirmed", "2026-07-18 12:00:00", "2026-07-18 12:00:00", None)]  # 60 h
    q = rules.detect_exceptions(state.shipment_state(silver(spark, rows)), ASOF)
    assert q.count() == 0
    q2 = rules.detect_exceptions(state.shipment_state(silver(spark, rows)), "2026-07-21T00:00:01Z")
    assert [r.exception_type for r in q2.collect()] == ["MISSED_MILESTONE"]


def test_eway_expired_and_last_arrival_wins(spark):
    rows = [("e1", "E", "booking_confirmed", "2026-07-18 00:00:00", "2026-07-20 12:00:00", None)]
    lm = spark.createDataFrame(
        [("E", "EWB1", ts("2026-07-30 00:00:00"), 1), ("E", "EWB2", ts("2026-07-20 00:00:00"), 2)],
        "shipment_id string, eway_bill_no string, eway_valid_until timestamp, _ingest long")
    q = rules.detect_exceptions(state.shipment_state(silver(spark, rows)), ASOF, None,
                                state.latest_last_mile(lm))
    got = [r for r in q.collect() if r.exception_type == "EWAY_BILL_EXPIRED"]
    assert len(got) == 1 and got[0].age_hours == 24.0 and got[0].detail == "e-way bill EWB2 expired 24h ago"


def test_same_milestone_twice_latest_wins(spark):
    rows = [("d1", "D", "vessel_departed", "2026-07-10 00:00:00", "2026-07-10 01:00:00", "1"),
            ("d2", "D", "vessel_departed", "2026-07-10 00:00:00", "2026-07-12 00:00:00", "2")]
    st = state.shipment_state(silver(spark, rows)).first()
    assert st.vessel_departed.vessel_mmsi == "2" and st.first_vessel.vessel_mmsi == "1"


def test_cause_precedence(spark):
    cond = spark.createDataFrame(
        [("USLAX", 1, "10", 0), ("NLRTM", 0, "abc", 1), ("SGSIN", 0, "72.5", 0), ("CNSHA", 0, "", 0)],
        "port string, weather_alerts int, wind_max_kmh string, disruption_news int")
    cong = spark.createDataFrame([("india_west", 9), ("la_long_beach", 2)], "port string, vessels_at_anchor long")
    got = {r.port: r.probable_cause for r in rules.port_causes(cond, cong).collect()}
    assert got["USLAX"] == "weather" and got["NLRTM"] == "disruption" and got["SGSIN"] == "weather"
    assert got["INNSA"] == "congestion" and got["CNSHA"] == "unknown" and got["USLGB"] == "unknown"
