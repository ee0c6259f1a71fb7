"""Hand-picked edge cases (FIXTURES B4): wire formats, NULLs, MMSI fallbacks."""

import os

from conftest import write_ndjson
from tidewater.operators import normalize
from tidewater.sources.bronze import ais_messages, read_ais_day, read_carrier_bronze


def ev(eid, carrier, ref, ts, planned):
    d = {"event_id": eid, "carrier": carrier, "ref": ref, "status": "GATE-IN FULL", "timestamp": ts,
         "origin": "CNSHA", "dest": "USLAX"}
    if planned is not None:
        d["planned"] = planned
    return d


def test_wire_format_edges(spark, tmpdir_path):
    rows = [
        ev("h1", "HLCU", "HLCU123A456789", "8/7/2026 3:05", "8/7/2026 1:00"),         # single digits accepted
        ev("h2", "HLCU", "HLCU123A456789", "30/02/2026 10:00", "01/02/2026 10:00"),   # 30 February
        ev("m1", "MSCU", "MSCU1234567", "1_784_556_000_000", "1741309200000"),        # underscore epoch
        ev("m2", "MSCU", "MSCU1234567", " 1741395600000 ", "1741309200000"),          # padded epoch
        ev("i1", "MAEU", "MAEU204816327", "2026-7-8T3:05:00Z", "2026-07-08T03:05:00Z"),  # single-digit ISO
        ev("p1", "MAEU", "MAEU204816327", "2026-07-08T03:05:00Z", None),              # planned missing
    ]
    path = os.path.join(tmpdir_path, "2026-07-20", "e.ndjson")
    write_ndjson(path, rows)
    with open(path, "a") as f:
        f.write("\n")                                                                 # blank line
    got = {r.event_id: (r.reason, r.actual_ts) for r in normalize.classify(read_carrier_bronze(spark, tmpdir_path))
           .select("event_id", "reason", "actual_ts").collect()}
    assert got["h1"][0] is None and (got["h1"][1].day, got["h1"][1].month, got["h1"][1].hour) == (8, 7, 3)
    assert got["h2"][0] == "unparseable_time"
    assert got["m1"][0] == "unparseable_time"
    assert got["m2"][0] is None
    assert got["i1"][0] is None and got["i1"][1].minute == 5
    assert got["p1"][0] == "unparseable_time"
    assert got[None][0] == "malformed_record"                                          # the blank line


def test_mmsi_zero_falls_back_to_user_id(spark, tmpdir_path):
    msgs = [{"MessageType": "PositionReport", "MetaData": {"MMSI": 0, "latitude": 33.7, "longitude": -118.2},
             "Message": {"PositionReport": {"UserID": 555, "Sog": 0.1}}, "received_at": "2026-07-21T01:00:00Z"},
            {"MessageType": "PositionReport", "Metadata": {"MMSI": 777},
             "Message": {"PositionReport": {"Latitude": 1.2, "Longitude": 103.8, "Sog": 0.0}},
             "received_at": "2026-07-21T01:00:00Z"},
            {"MessageType": "PositionReport", "MetaData": {"MMSI": 0},
             "Message": {"PositionReport": {"UserID": 0, "Latitude": 1.2, "Longitude": 103.8, "Sog": 0.0}},
             "received_at": "2026-07-21T01:00:00Z"}]
    write_ndjson(os.path.join(tmpdir_path, "2026-07-21", "p.ndjson"), msgs)
    positions, _ = ais_messages(read_ais_day(spark, tmpdir_path, "2026-07-21"))
    got = sorted(((r.mmsi or ""), r.lat) for r in positions.collect())
    # 555 takes coordinates from metadata; 777 uses the other metadata spelling; no id at all -> NULL
    assert got == [("", 1.2), ("555", 33.7), ("777", 1.2)]
