"""Hand-computed values for the scorecard, eta_baseline and an ETA prediction."""

from datetime import datetime, timedelta

from tidewater.operators import eta, gold, state

SILVER = ("event_id string, shipment_id string, carrier string, event_type string, planned_ts timestamp, "
          "actual_ts timestamp, origin string, dest string, vessel_mmsi string, ms_idx int")
IDX = {"booking_confirmed": 1, "vessel_departed": 4, "vessel_arrived": 5, "customs_release": 6, "delivered": 8}


def t(s):
    return datetime.fromisoformat(s)


def silver(spark, rows):
    return spark.createDataFrame([(e, s, c, m, t(p), t(a), o, d, None, IDX[m]) for e, s, c, m, p, a, o, d in rows],
                                 SILVER)


def test_scorecard_values(spark):
    rows = [
        # S1: delivered 20 h late (on time), customs 30 h after arrival
        ("1a", "S1", "MAEU", "vessel_arrived", "2026-07-01 00:00:00", "2026-07-01 00:00:00", "CNSHA", "USLAX"),
        ("1b", "S1", "MAEU", "customs_release", "2026-07-02 00:00:00", "2026-07-02 06:00:00", "CNSHA", "USLAX"),
        ("1c", "S1", "MAEU", "delivered", "2026-07-03 00:00:00", "2026-07-03 20:00:00", "CNSHA", "USLAX"),
        # S2: delivered 30 h late (not on time), no customs pair
        ("2a", "S2", "MAEU", "delivered", "2026-07-03 00:00:00", "2026-07-04 06:00:00", "CNSHA", "USLAX"),
        # S3: not delivered, gone dark
        ("3a", "S3", "MAEU", "booking_confirmed", "2026-07-01 00:00:00", "2026-07-01 00:00:00", "CNSHA", "USLAX"),
        # S4: NULL lane: counted, but never matches the per-shipment lookups
        ("4a", "S4", "MAEU", "delivered", "2026-07-03 00:00:00", "2026-07-03 00:00:00", None, "USLAX"),
    ]
    fct = gold.fct_shipment_events(silver(spark, rows))
    dark = spark.createDataFrame([("S3", "MISSED_MILESTONE")], "shipment_id string, exception_type string")
    got = {(r.carrier, r.lane): r for r in gold.carrier_scorecard(fct, dark).collect()}
    r = got[("MAEU", "CNSHA-USLAX")]
    assert (r.shipments, r.on_time_pct, r.mis_scan_rate, r.avg_customs_dwell_h) == (3, 50.0, 33.3, 30.0)
    n = got[("MAEU", None)]
    assert (n.shipments, n.on_time_pct, n.mis_scan_rate, n.avg_customs_dwell_h) == (1, None, 0.0, None)
    base = {(r.lane, r.event_type): (r.observations, r.median_offset_h) for r in gold.eta_baseline(fct).collect()}
    assert base[("CNSHA-USLAX", "delivered")] == (2, 25.0)       # median of 20 h and 30 h


def test_eta_prediction_by_hand(spark):
    # two completed shipments on the lane, schedule booking -> departed 84 h -> delivered 492 h,
    # delivered 10 h and 14 h after plan
    rows = []
    for sid, delivered in [("C0", "2026-06-21 22:00:00"), ("C1", "2026-06-22 02:00:00")]:
        rows += [(f"{sid}a", sid, "MAEU", "booking_confirmed", "2026-06-01 00:00:00", "2026-06-01 00:00:00",
                  "CNSHA", "USLAX"),
                 (f"{sid}b", sid, "MAEU", "vessel_departed", "2026-06-04 12:00:00", "2026-06-04 12:00:00",
                  "CNSHA", "USLAX"),
                 (f"{sid}c", sid, "MAEU", "delivered", "2026-06-21 12:00:00", delivered, "CNSHA", "USLAX")]
    # in flight: booked 2026-07-01, departed 3 h late
    rows += [("Fa", "F", "MAEU", "booking_confirmed", "2026-07-01 00:00:00", "2026-07-01 00:00:00", "CNSHA", "USLAX"),
             ("Fb", "F", "MAEU", "vessel_departed", "2026-07-04 12:00:00", "2026-07-04 15:00:00", "CNSHA", "USLAX")]
    st = state.shipment_state(silver(spark, rows))
    empty = spark.createDataFrame([], "shipment_id string, exception_id string, exception_type string, "
                                      "probable_cause string")
    p = eta.shipment_eta(st, empty).first()
    # span = 84 h x (492/84) = 492 h; offset = median(10, 14) = 12 h; adjustment = 3 h departure delay
    assert p.shipment_id == "F" and p.span_source == "planned_ratio(x5.86)"
    assert (p.planned_span_h, p.median_offset_h, p.live_adjustment_h) == (492.0, 12.0, 3.0)
    assert p.offset_source == "lane_median(CNSHA-USLAX)"
    assert p.adjustment_reason == "observed_departure_delay(+3.0h)"
    assert p.predicted_delivery_ts == datetime(2026, 7, 1) + timedelta(hours=492 + 12 + 3)


def test_dim_vessel_full_outer_with_overlap(spark):
    observed = spark.createDataFrame(
        [("353136000", "9811000", "", "71", t("2026-07-21 09:00:00")),          # configured, blank name
         ("111", "1", "LOCAL", "70", t("2026-07-21 09:00:00"))],               # not configured
        "mmsi string, imo string, name string, type string, observed_at timestamp")
    got = {r.mmsi: r for r in gold.dim_vessel(observed).collect()}
    assert len(got) == 9                                                      # 8 configured + 1 observed-only
    assert got["353136000"].vessel_name == "EVER GIVEN" and got["353136000"].imo == "9811000"
    assert got["111"].vessel_name == "LOCAL"
    assert got["636092932"].observed_at is None and got["636092932"].vessel_name == "MSC GULSUN"
