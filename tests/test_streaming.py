"""Stream jobs against their batch forms."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import SF001, write_ndjson
from test_ais import COASTER, DAY, FEEDER, MESSAGES
from tidewater import config
from tidewater.operators import ais, gold, normalize
from tidewater.plans.lake import Lake
from tidewater.sinks import tables
from tidewater.sources.bronze import ais_messages, read_ais_day, read_carrier_bronze
from tidewater.sources.bronze import CARRIER_FIELDS
from tidewater.streaming import jobs


def _feed_files(spark, root, n_files=6):
    """The sf0.001 derived feed written as ndjson bronze files, in ingest order."""
    raw = Lake(spark, SF001).raw
    rows = raw.orderBy("_ingest").select(*CARRIER_FIELDS).collect()   # test setup only (~3k rows)
    per = (len(rows) + n_files - 1) // n_files
    for i in range(n_files):
        chunk = [{k: v for k, v in r.asDict().items() if v is not None} for r in rows[i * per:(i + 1) * per]]
        write_ndjson(os.path.join(root, f"2026-07-{10 + i:02d}", f"part-{i:03d}.ndjson"), chunk)
        t = 1_700_000_000 + i * 60
        os.utime(os.path.join(root, f"2026-07-{10 + i:02d}", f"part-{i:03d}.ndjson"), (t, t))
    return len(rows)


def test_normalize_stream_equals_batch(spark, tmpdir_path):
    bronze, out = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "silver")
    n = _feed_files(spark, bronze)
    q = jobs.start_normalize(spark, bronze, out, checkpoint=os.path.join(tmpdir_path, "ckpt"), max_files=2)
    q.awaitTermination()
    streamed = spark.read.parquet(f"{out}/shipment_events").drop("event_date")
    batch_cls = normalize.classify(read_carrier_bronze(spark, bronze))
    batch = normalize.silver_events(normalize.dedupe(normalize.valid_rows(batch_cls))).drop("_ingest")
    cols = ["event_id", "shipment_id", "event_type", "actual_ts", "origin", "dest"]
    assert streamed.count() == batch.count() > 0
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    quarantined = spark.read.parquet(f"{out}/quarantine").count()
    assert quarantined == normalize.quarantine_rows(batch_cls).count()
    assert quarantined + batch_cls.where("reason is null").count() == n
    # re-running finds no new files and changes nothing
    jobs.start_normalize(spark, bronze, out, checkpoint=os.path.join(tmpdir_path, "ckpt")).awaitTermination()
    assert spark.read.parquet(f"{out}/shipment_events").count() == batch.count()


def test_normalize_stream_drops_copies_seen_in_earlier_batches(spark, tmpdir_path):
    from test_normalize import ROWS
    bronze, out = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "silver")
    write_ndjson(os.path.join(bronze, "2025-03-08", "a.ndjson"), ROWS[:5])
    ck = os.path.join(tmpdir_path, "ckpt")
    jobs.start_normalize(spark, bronze, out, checkpoint=ck).awaitTermination()
    later = [dict(ROWS[1], origin="ZZZZZ"), ROWS[6]]        # "sail" again (different payload) + a new event
    write_ndjson(os.path.join(bronze, "2025-03-09", "b.ndjson"), later)
    jobs.start_normalize(spark, bronze, out, checkpoint=ck).awaitTermination()
    got = {r.event_id: r.origin for r in spark.read.parquet(f"{out}/shipment_events").collect()}
    assert got["sail"] == "DEHAM" and set(got) == {"book", "sail", "drop", "late", "load"}


def test_normalize_batch_that_failed_between_writes_gives_the_same_tables(spark, tmpdir_path, monkeypatch):
    from test_normalize import ROWS
    bronze = os.path.join(tmpdir_path, "bronze")
    home = {"delivery_address": "Shed 12, Kandla 370230"}
    write_ndjson(os.path.join(bronze, "2025-03-08", "a.ndjson"), [r | home for r in ROWS])
    write = jobs._write_batch

    def failing(df, path, *rest):
        if path.endswith("shipment_events"):
            raise OSError("lost")
        write(df, path, *rest)

    def run(out, ck):
        jobs.start_normalize(spark, bronze, os.path.join(tmpdir_path, out),
                             checkpoint=os.path.join(tmpdir_path, ck)).awaitTermination()
        return {t: spark.read.parquet(os.path.join(tmpdir_path, out, t)).count()
                for t in ("shipment_events", "last_mile", "quarantine")}

    monkeypatch.setattr(jobs, "_write_batch", failing)
    with pytest.raises(Exception):
        run("retried", "ck1")
    monkeypatch.setattr(jobs, "_write_batch", write)
    assert run("retried", "ck1") == run("plain", "ck2") == {"shipment_events": 6, "last_mile": 6, "quarantine": 4}


def test_anchor_hours_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "ais")
    write_ndjson(os.path.join(src, DAY, "a.ndjson"), MESSAGES[:3])
    write_ndjson(os.path.join(src, DAY, "b.ndjson"), MESSAGES[3:])
    # a report the next day moves the watermark past the end of the day
    write_ndjson(os.path.join(src, "2025-02-12", "c.ndjson"), [MESSAGES[0] | {"received_at": "2025-02-12T06:00:00Z"}])
    dwell_path = os.path.join(tmpdir_path, "dwell")
    jobs.start_anchor_hours(spark, src, dwell_path, checkpoint=os.path.join(tmpdir_path, "ck"),
                            max_files=1).awaitTermination()
    got = {(r.mmsi, r.box): r.anchor_hours for r in
           spark.read.parquet(dwell_path).where(F.col("date") == DAY).collect()}
    positions, _ = ais_messages(read_ais_day(spark, src, DAY))
    want = {(r.mmsi, r.box): r.anchor_hours for r in ais.vessel_dwell(positions).collect()}
    assert got == want == {(str(COASTER), "india_west"): 3, (str(FEEDER), "singapore_strait"): 1}


def test_vessel_stream_keeps_newest(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "ais")
    write_ndjson(os.path.join(src, DAY, "a.ndjson"), MESSAGES[-1:])   # 17:20 report
    root = os.path.join(tmpdir_path, "dim")
    ck = os.path.join(tmpdir_path, "ck")
    jobs.start_vessels(spark, src, root, checkpoint=ck).awaitTermination()
    write_ndjson(os.path.join(src, "2025-02-12", "b.ndjson"), MESSAGES[-2:-1])  # replayed 04:00 report
    jobs.start_vessels(spark, src, root, checkpoint=ck).awaitTermination()
    v = tables.read_current(spark, root).collect()
    assert len(v) == 1 and v[0].observed_at.hour == 17


def _queue(spark, ages):
    return spark.createDataFrame(
        [(f"e{i}", f"S{i}", "MAEU", "MISSED_MILESTONE", a, "d", "unknown") for i, a in enumerate(ages)],
        "exception_id string, shipment_id string, carrier string, exception_type string, age_hours double, "
        "detail string, probable_cause string")


def test_mart_and_alert_streams(spark, tmpdir_path):
    snaps = os.path.join(tmpdir_path, "snaps")
    q1 = _queue(spark, [10.0, 100.0])
    tables.append_snapshot(q1, snaps, "2026-07-20T00:00:00Z")
    schema = spark.read.parquet(snaps).schema
    mart = os.path.join(tmpdir_path, "mart")
    jobs.start_exception_mart(spark, snaps, schema, mart, checkpoint=os.path.join(tmpdir_path, "ckm")) \
        .awaitTermination()
    got = spark.read.parquet(mart).collect()
    want = gold.exception_mart(q1).collect()
    assert [r.asDict() for r in got] == [r.asDict() for r in want]

    state_root, dec = os.path.join(tmpdir_path, "state"), os.path.join(tmpdir_path, "decisions")
    ck = os.path.join(tmpdir_path, "cka")

    def run(now):
        w = jobs.queue_stream(spark, snaps, schema).writeStream \
            .foreachBatch(lambda df, n: jobs.alert_batch(df, state_root, dec, now, str(n))) \
            .option("checkpointLocation", ck).trigger(availableNow=True)
        w.start().awaitTermination()

    run("2026-07-20T00:00:00Z")
    assert sorted(r.decision for r in spark.read.parquet(dec).collect()) == ["new", "new"]
    tables.append_snapshot(_queue(spark, [60.0, 101.0]), snaps, "2026-07-21T00:00:00Z")
    run("2026-07-21T00:00:00Z")
    second = spark.read.parquet(dec).where("age_hours in (60.0, 101.0)").collect()
    assert sorted(r.decision for r in second) == ["escalated", "suppressed"]


def test_landing_stream_rejects_whole_file(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    write_ndjson(os.path.join(landing, "good.ndjson"), [{"event_id": "a"}, {"event_id": "b"}])
    write_ndjson(os.path.join(landing, "bad.ndjson"), [{"event_id": "c"}, "{oops"])
    bronze, rej = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "rejected")
    jobs.start_landing(spark, landing, bronze, rej, "2026-07-21",
                       checkpoint=os.path.join(tmpdir_path, "ck")).awaitTermination()
    assert spark.read.text(os.path.join(bronze, "2026-07-21")).count() == 2
    assert [os.path.basename(r.file_path) for r in spark.read.parquet(rej).collect()] == ["bad.ndjson"]


def test_ais_bronze_stamp_and_filter(spark, tmpdir_path):
    import json
    landing = os.path.join(tmpdir_path, "landing")
    in_meta = {"MessageType": "PositionReport", "MetaData": {"MMSI": 7, "latitude": 22.61, "longitude": 69.88},
               "Message": {"PositionReport": {"Sog": 0.1}}}
    msgs = MESSAGES + [{"MessageType": "Other"}, in_meta]
    write_ndjson(os.path.join(landing, "m.ndjson"), msgs)
    out = os.path.join(tmpdir_path, "bronze")
    jobs.start_ais_bronze(spark, landing, out, checkpoint=os.path.join(tmpdir_path, "ck")).awaitTermination()
    day = os.listdir(out)[0]
    got = read_ais_day(spark, out, day)
    # one report is outside every box, "Other" is not subscribed
    assert got.count() == len(MESSAGES)
    positions, statics = ais_messages(got)
    assert positions.where("received_at is null").count() == 0 and statics.count() == 2
    assert positions.where(F.to_date("received_at") == day).count() == positions.count() == 7


def _time_ordered_files(rows, by, path, n):
    """Test set-up only: a global ntile cuts the small fixture into time-ordered files."""
    cut = rows.withColumn("b", F.ntile(n).over(Window.orderBy(by)))
    for b in range(1, n + 1):
        cut.where(F.col("b") == b).drop("b").coalesce(1).write.mode("overwrite").parquet(f"{path}/b={b:02d}")


def test_exception_timers_equal_all_batch_rules_at_watermark(spark, tmpdir_path, two_partitions):
    from tidewater.operators import rules, state
    from tidewater.streaming import timers
    lk = Lake(spark, SF001)
    order = F.concat_ws("-", *[F.lpad(F.col(f"_ingest.{f}").cast("string"), 12, "0")
                               for f in lk.deduped.select("_ingest.*").columns])
    rows = normalize.silver_with_last_mile(lk.deduped).withColumn("lm_order", order)
    # some vessels never arrive, and all have been at anchor for long
    rows = rows.where("not (event_type = 'vessel_arrived' and crc32(encode(shipment_id, 'UTF-8')) % 3 = 0)")
    silver = rows.drop("_ingest")
    src, flags = os.path.join(tmpdir_path, "silver"), os.path.join(tmpdir_path, "flags")
    totals = ais.dwell_totals(lk.vessel_dwell).withColumn("anchor_hours", F.col("anchor_hours") + 70)
    st = state.shipment_state(rows)
    departed = st.where("vessel_departed is not null").select("shipment_id", "vessel_departed.vessel_mmsi")
    hours = timers.voyage_anchor_hours(departed, totals, F.lit(silver.agg(F.min("actual_ts")).first()[0]))
    hours.write.parquet(os.path.join(tmpdir_path, "anchor"))
    _time_ordered_files(silver, "actual_ts", src, 4)
    moved = os.path.join(tmpdir_path, "half")   # the first half arrives, the query stops, the rest follows
    os.makedirs(moved)

    def run():
        stream = spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", 1).parquet(f"{moved}/*")
        anchors = spark.readStream.schema(hours.schema).parquet(os.path.join(tmpdir_path, "anchor"))
        q = timers.exception_flags(stream, "120 days", 24 * 30, anchors, F.col("lm_order")).writeStream.format("parquet") \
            .option("path", flags).option("checkpointLocation", os.path.join(tmpdir_path, "ck")) \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        return q.lastProgress["eventTime"]["watermark"]

    for part in (range(1, 3), range(3, 5)):
        for b in part:
            shutil.copytree(f"{src}/b={b:02d}", f"{moved}/b{b:02d}")
        wm = run()
    got = {tuple(r) for r in timers.open_flags(spark.read.parquet(flags)).collect()}
    batch = rules.detect_exceptions(st, wm, totals).select("shipment_id", "exception_type")
    want = {tuple(r) for r in batch.collect()}
    assert got == want
    assert {t for _, t in want} == set(timers.FLAG_TYPES)


def test_exception_timers_fire_without_new_events(spark, tmpdir_path, two_partitions):
    """One shipment goes silent; another one's events move the watermark past each of its deadlines."""
    from datetime import datetime, timedelta
    from tidewater.streaming import timers
    t0 = datetime(2025, 1, 1)
    schema = ("event_id string, shipment_id string, carrier string, event_type string, planned_ts timestamp, "
              "actual_ts timestamp, ms_idx int, vessel_mmsi string, delivery_address string, eway_ts timestamp")
    src = os.path.join(tmpdir_path, "in")

    def put(n, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/{n}")

    def step():
        stream = spark.readStream.schema(schema).parquet(f"{src}/*")
        timers.exception_flags(stream, "0 seconds").writeStream.format("parquet").option("path", f"{src}-out") \
            .option("checkpointLocation", f"{src}-ck").trigger(availableNow=True).start().awaitTermination()
        return {r.exception_type for r in timers.open_flags(spark.read.parquet(f"{src}-out")).where("shipment_id = 'A'").collect()}

    arrived = config.MILESTONE_INDEX["vessel_arrived"]
    put(1, ("a1", "A", "MAEU", "vessel_arrived", t0, t0, arrived, "1", "Shed 12", t0 + timedelta(hours=30)))
    assert step() == set()
    tick = lambda n, h: put(n, (f"b{n}", "B", "MAEU", "booked", None, t0 + timedelta(hours=h), 0, None, None, None))
    tick(2, 31)
    assert step() == {"EWAY_BILL_EXPIRED"}
    gap = config.MAX_GAP_H["vessel_arrived"]
    tick(3, max(gap, config.CUSTOMS_DWELL_H) + 1)
    assert step() == {"EWAY_BILL_EXPIRED", "CUSTOMS_DWELL", "MISSED_MILESTONE"}
