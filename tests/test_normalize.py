"""Carrier scans of our own: formats, quarantine, de-dup, three rules, stable ids."""

import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from conftest import write_ndjson
from tidewater.operators import normalize, rules, state
from tidewater.sources.bronze import read_carrier_bronze

ASOF = "2025-03-10T12:00:00Z"


def scan(eid, ref, status, when, planned=None, **more):
    return {"event_id": eid, "carrier": ref[:4], "ref": ref, "status": status, "timestamp": when,
            "planned": planned or when, "origin": "DEHAM", "dest": "INMUN"} | more


def millis(*when):
    return str(int(datetime(*when, tzinfo=timezone.utc).timestamp()) * 1000)


DONE, LATE, HELD, QUIET = "ONEYKTY0042117", "HLCU204B318890", "MSCU4410093", "CMDUXK5550123"
ROWS = [
    scan("book", DONE, "BOOKING CONFIRMED", "2025-02-01T09:00:00Z"),
    scan("sail", DONE, "VESSEL DEPARTURE", "2025-02-06T04:00:00Z", "2025-02-06T00:00:00Z"),
    scan("drop", DONE, "DELIVERED", "2025-03-02T15:00:00Z", "2025-03-02T12:00:00Z"),
    scan("drop", DONE, "DELIVERED", "2025-03-02T15:00:00Z", "2025-03-02T12:00:00Z"),
    # 33.5 h after plan, 188.5 h ago
    scan("late", LATE, "VESSEL DEPARTURE", "02/03/2025 15:30", "01/03/2025 06:00"),
    # 64 h at the port without a release
    scan("held", HELD, "VESSEL ARRIVAL", millis(2025, 3, 7, 20), millis(2025, 3, 7, 8)),
    # silent for 37 h, 24 h are normal
    scan("load", QUIET, "LOAD ON VESSEL", "2025-03-08T23:00:00Z"),
    scan("bad-ref", "HLCU20B4318890", "DELIVERED", "05/03/2025 08:00"),
    scan("bad-status", HELD, "CONTAINER WASHED", millis(2025, 3, 8)),
    scan("bad-time", DONE, "OUT FOR DELIVERY", "yesterday noon", "2025-03-01T00:00:00Z"),
    scan("no-such-day", LATE, "LOAD ON VESSEL", "31/02/2025 10:00", "28/02/2025 10:00"),
]


def build(spark, root, asof=ASOF):
    raw = read_carrier_bronze(spark, root)
    cls = normalize.classify(raw)
    dd = normalize.dedupe(normalize.valid_rows(cls))
    silver = normalize.silver_events(dd)
    st = state.shipment_state(silver)
    q = rules.detect_exceptions(st, asof, None, state.latest_last_mile(normalize.last_mile(dd)), None)
    return cls, silver, st, q


def lake(tmp):
    write_ndjson(os.path.join(tmp, "2025-03-09", "events_0.ndjson"), ROWS)
    return tmp


def test_counts_and_quarantine(spark, tmpdir_path):
    cls, _, _, _ = build(spark, lake(tmpdir_path))
    c = normalize.run_counters(cls).first()
    assert (c.events_read, c.events_processed, c.duplicates, c.quarantined_total) == (11, 6, 1, 4)
    bad = normalize.quarantine_rows(cls)
    assert {r.event_id: r.reason for r in bad.collect()} == {
        "bad-ref": "unmapped_ref", "bad-status": "unknown_status", "bad-time": "unparseable_time",
        "no-such-day": "unparseable_time"}
    # the payload is kept with the reason
    assert bad.where("event_id = 'bad-time'").first().timestamp == "yesterday noon"


def test_formats(spark, tmpdir_path):
    _, silver, _, _ = build(spark, lake(tmpdir_path))
    got = {r.event_id: r.ts for r in silver.select(
        "event_id", F.date_format("actual_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts")).collect()}
    assert (got["held"], got["late"], got["load"]) == (
        "2025-03-07T20:00:00Z", "2025-03-02T15:30:00Z", "2025-03-08T23:00:00Z")


def test_rules(spark, tmpdir_path):
    _, _, _, q = build(spark, lake(tmpdir_path))
    got = {(r.shipment_id, r.exception_type): (r.age_hours, r.detail, r.probable_cause) for r in q.collect()}
    assert got == {
        (LATE, "LATE_DEPARTURE"): (188.5, "departed 34h after plan", "unknown"),
        (HELD, "CUSTOMS_DWELL"): (16.0, "in customs 64h with no release", "unknown"),
        (QUIET, "MISSED_MILESTONE"): (13.0, "no event for 37h after loaded_on_vessel (max normal 24h)", "unknown"),
    }


def test_ids_stable_over_runs(spark, tmpdir_path):
    root = lake(tmpdir_path)
    first, later = ({r.exception_id for r in build(spark, root, asof)[3].collect()}
                    for asof in (ASOF, "2025-03-10T15:00:00Z"))
    assert first == later and len(first) == 3


def test_departure_delay_text_prints_the_double(spark):
    from tidewater.functions.timefmt import hours_text1
    whole = [h * 3600 + m * 60 for h in range(1, 60) for m in range(60)]
    df = spark.createDataFrame([(s,) for s in whole], "s long").select("s", hours_text1(F.col("s")).alias("t"))
    assert {r.s: r.t for r in df.collect()} == {s: f"{s / 3600:.1f}" for s in whole}


def test_feed_keeps_every_line_and_addresses_without_a_pin(spark):
    from conftest import SF001
    from tidewater.plans.lake import Lake
    lk = Lake(spark, SF001)
    assert lk.raw.count() == lk.table("lineitem").count()
    pins = lk.last_mile.select(F.count_if(F.col("pincode").isNull()).alias("none"), F.count("pincode").alias("some"))
    assert all(pins.first())


def test_first_valid_copy_wins(spark, tmpdir_path):
    rows = [dict(ROWS[0], event_id="z1", origin="AAAAA"),
            dict(ROWS[0], event_id="z1", ref="XXXX0", origin="BBBBB"),   # bad copy never enters
            dict(ROWS[0], event_id="z1", origin="CCCCC")]
    write_ndjson(os.path.join(tmpdir_path, "2026-07-19", "a.ndjson"), [rows[1]])
    write_ndjson(os.path.join(tmpdir_path, "2026-07-20", "b.ndjson"), [rows[0], rows[2]])
    _, silver, _, _ = build(spark, tmpdir_path)
    assert [r.origin for r in silver.collect()] == ["AAAAA"]


def test_malformed_lines_are_quarantined(spark, tmpdir_path):
    write_ndjson(os.path.join(tmpdir_path, "2026-07-20", "x.ndjson"),
                 [ROWS[0], "[1, 2]", '{"event_id": "t1"} trailing', "42"])
    cls, _, _, _ = build(spark, tmpdir_path)
    reasons = [r.reason for r in cls.collect()]
    assert reasons.count("malformed_record") == 3 and reasons.count(None) == 1


def test_empty_input(spark, tmpdir_path):
    write_ndjson(os.path.join(tmpdir_path, "2026-07-20", "e.ndjson"), [])
    cls, silver, st, q = build(spark, tmpdir_path)
    assert q.count() == 0 and silver.count() == 0


def test_first_wins_survives_many_file_splits(spark, tmpdir_path):
    """One bronze file read as many splits: the (file, block, row) key still
    orders lines as a sequential reader would, so the same copies win."""
    rows = []
    for i in range(3000):
        base = dict(ROWS[0], event_id=f"e{i % 700}")   # each id repeated ~4 times
        base["origin"] = f"O{i:05d}"                     # payload differs per copy
        rows.append(base)
    write_ndjson(os.path.join(tmpdir_path, "2026-07-20", "big.ndjson"), rows)
    want = {f"e{j}": f"O{j:05d}" for j in range(700)}   # the first line of each id
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("4096", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            raw = read_carrier_bronze(spark, tmpdir_path)
            if split == "4096":
                assert raw.rdd.getNumPartitions() > 10
            _, silver, _, _ = build(spark, tmpdir_path)
            assert {r.event_id: r.origin for r in silver.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
