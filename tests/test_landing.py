"""Landing: a bad line rejects the whole file; identical content lands once."""

import os

from conftest import write_ndjson
from tidewater.sources.bronze import ingest_counters, landing_plan, landing_validation


def test_landing_validation_and_hash(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    good = [{"event_id": "a", "carrier": "MAEU"}, {"event_id": "b", "carrier": "MSCU"}]
    write_ndjson(os.path.join(landing, "f1.ndjson"), good)
    write_ndjson(os.path.join(landing, "f2.ndjson"), good)                       # same bytes as f1
    write_ndjson(os.path.join(landing, "f3.ndjson"), [good[0], "not json"])      # corrupt line
    write_ndjson(os.path.join(landing, "f4.ndjson"), [good[0], ""])              # blank line
    write_ndjson(os.path.join(landing, "f5.ndjson"), ['{"a": 1} trailing'])      # trailing text
    checks = {os.path.basename(r.file_path): r.ok for r in landing_validation(spark, landing).collect()}
    assert checks == {"f1.ndjson": True, "f2.ndjson": True, "f3.ndjson": False, "f4.ndjson": False,
                      "f5.ndjson": False}
    plan = landing_plan(spark, landing, "2026-07-21")
    rows = {os.path.basename(r.file_path): r for r in plan.collect()}
    assert rows["f1.ndjson"].digest == rows["f2.ndjson"].digest and len(rows["f1.ndjson"].digest) == 12
    c = ingest_counters(plan).first()
    assert (c.files_landed, c.files_rejected, c.events) == (2, 3, 4)
    registry = plan.where("ok").select("date", "digest")
    again = landing_plan(spark, landing, "2026-07-21", registry)
    assert all(r.already_landed for r in again.where("ok").collect())
    other_day = landing_plan(spark, landing, "2026-07-22", registry)
    assert not any(r.already_landed for r in other_day.collect())
    assert all(r.landed_other_date for r in other_day.where("ok").collect())


def test_feed_silence_from_bronze_files(spark, tmpdir_path):
    from datetime import datetime, timezone
    from tidewater.operators.alerts import feed_silence
    from tidewater.sources.bronze import bronze_file_times
    root = os.path.join(tmpdir_path, "bronze")
    path = os.path.join(root, "2026-07-20", "events_abc.ndjson")
    write_ndjson(path, [{"event_id": "a"}])
    landed = datetime(2026, 7, 20, 19, 0, tzinfo=timezone.utc).timestamp()
    os.utime(path, (landed, landed))
    v = feed_silence(bronze_file_times(spark, root), 0, "2026-07-21T00:00:00Z").first()
    assert 4.9 <= v.feed_silence_hours <= 5.1 and v.silent
    quiet = feed_silence(bronze_file_times(spark, root), 0, "2026-07-20T19:11:00Z").first()
    assert quiet.feed_silence_hours < 3 and not quiet.silent


def test_empty_files_and_odd_names_land(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    write_ndjson(os.path.join(landing, "empty.ndjson"), [])
    write_ndjson(os.path.join(landing, "two words+50%.ndjson"), [{"event_id": "a"}])
    rows = {os.path.basename(r.file_path): r for r in landing_plan(spark, landing, "2026-07-21").collect()}
    assert {k: (r.ok, r.lines) for k, r in rows.items()} == {"empty.ndjson": (True, 0),
                                                             "two words+50%.ndjson": (True, 1)}


def test_absent_weather_sources_are_empty(spark, tmpdir_path):
    from tidewater.sources.bronze import read_weather
    assert [df.count() for df in read_weather(spark, tmpdir_path)] == [0, 0, 0]
