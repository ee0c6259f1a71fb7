"""Alert decisions and state transitions; quarantine spike; feed silence."""

from datetime import datetime

from tidewater.operators import alerts

NOW = "2026-07-21T00:00:00Z"
Q_SCHEMA = ("exception_id string, shipment_id string, carrier string, exception_type string, "
            "age_hours double, detail string, probable_cause string")


def queue(spark, ages):
    return spark.createDataFrame([(f"e{i}", f"S{i}", "MAEU", "MISSED_MILESTONE", a, "d", "unknown")
                                  for i, a in enumerate(ages)], Q_SCHEMA)


def empty_state(spark):
    return spark.createDataFrame([], "exception_id string, type string, band int, alerted_at timestamp")


def test_alert_once_then_suppress(spark):
    q = queue(spark, [10.0, 20.0])
    d1 = alerts.decide(q, empty_state(spark))
    assert sorted(r.decision for r in d1.collect()) == ["new", "new"]
    s1 = alerts.next_state(empty_state(spark), d1, NOW)
    d2 = alerts.decide(q, s1)
    assert sorted(r.decision for r in d2.collect()) == ["suppressed", "suppressed"]


def test_escalates_once_per_band(spark):
    s1 = alerts.next_state(empty_state(spark), alerts.decide(queue(spark, [10.0]), empty_state(spark)), NOW)
    d2 = alerts.decide(queue(spark, [60.0]), s1)
    assert [r.decision for r in d2.collect()] == ["escalated"]
    assert d2.first().message.startswith(":rotating_light: ESCALATION [MISSED_MILESTONE] shipment S0 (MAEU)")
    s2 = alerts.next_state(s1, d2, NOW)
    assert [r.decision for r in alerts.decide(queue(spark, [70.0]), s2).collect()] == ["suppressed"]


def test_failed_delivery_is_retried(spark):
    d = alerts.decide(queue(spark, [10.0, 20.0]), empty_state(spark))
    failed = spark.createDataFrame([("e0", False), ("e1", False)], "exception_id string, ok boolean")
    assert alerts.next_state(empty_state(spark), d, NOW, failed).count() == 0
    assert alerts.failures(d, failed, NOW).count() == 2


def test_band_edges(spark):
    bands = [r.band for r in alerts.decide(queue(spark, [47.9, 48.0, 95.9, 96.0]), empty_state(spark))
             .orderBy("exception_id").collect()]
    assert bands == [0, 1, 1, 2]


def counters(spark, read, quarantined):
    return spark.createDataFrame([(read, quarantined)], "events_read long, quarantined_total long")


def test_quarantine_spike_once_per_day(spark):
    st = empty_state(spark)
    fired = alerts.quarantine_spike(counters(spark, 1000, 111), st, NOW).collect()
    assert len(fired) == 1 and "(11.1%)" in fired[0].message
    st2 = spark.createDataFrame([(fired[0].exception_id, "ops", 0, datetime(2026, 7, 21))],
                                "exception_id string, type string, band int, alerted_at timestamp")
    assert alerts.quarantine_spike(counters(spark, 1000, 111), st2, NOW).count() == 0
    assert alerts.quarantine_spike(counters(spark, 1000, 111), st2, "2026-07-22T00:00:00Z").count() == 1
    assert alerts.quarantine_spike(counters(spark, 1000, 10), st, NOW).count() == 0


def test_feed_silence(spark):
    landed = spark.createDataFrame([(datetime(2026, 7, 20, 19, 0, 0),)], "ts timestamp")
    v = alerts.feed_silence(landed, 0, NOW).first()
    assert 4.9 <= v.feed_silence_hours <= 5.1 and v.silent
    none = alerts.feed_silence(spark.createDataFrame([], "ts timestamp"), 0, NOW).first()
    assert none.feed_silence_hours is None and none.silent


def test_slo_rows(spark):
    from tidewater.operators import metrics
    silver = spark.createDataFrame([(datetime(2026, 7, 20, 23, 0),)], "actual_ts timestamp")
    pos = spark.createDataFrame([(datetime(2026, 7, 20, 23, 55),)], "received_at timestamp")
    got = {r.slo: (r.lag_s, r.ok) for r in metrics.slo_freshness(silver, NOW, pos).collect()}
    assert got == {"normalize_freshness": (3600, True), "feed_silence": (3600, True), "ais_staleness": (300, True)}
