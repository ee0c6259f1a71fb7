"""AIS: anchor-hours, congestion, vessel last-write-wins, missing day."""

import os

from conftest import write_ndjson
from tidewater.operators import ais
from tidewater.sources.bronze import ais_messages, read_ais_day

DAY = "2025-02-11"
MUNDRA_ROADS, SINGAPORE_ROADS, MID_ATLANTIC = (22.61, 69.88), (1.11, 103.72), (10.0, -30.0)
COASTER, FEEDER, TRAMP = 419000777, 563011200, 244660111


def report(mmsi, clock, place, knots):
    lat, lon = place
    body = {"Latitude": lat, "Longitude": lon, "Sog": knots}
    return _message("PositionReport", mmsi, clock, body, {"latitude": lat, "longitude": lon})


def particulars(mmsi, clock, **body):
    return _message("ShipStaticData", mmsi, clock, body, {})


def _message(kind, mmsi, clock, body, meta):
    return {"MessageType": kind, "received_at": f"{DAY}T{clock}Z", "MetaData": {"MMSI": mmsi} | meta,
            "Message": {kind: body}}


MESSAGES = [
    report(COASTER, "06:05:00", MUNDRA_ROADS, 0.3), report(COASTER, "06:50:00", MUNDRA_ROADS, 0.1),   # one hour
    report(COASTER, "08:10:00", MUNDRA_ROADS, 0.0), report(COASTER, "22:00:00", MUNDRA_ROADS, 0.2),
    report(FEEDER, "13:30:00", SINGAPORE_ROADS, 0.49), report(FEEDER, "14:00:00", SINGAPORE_ROADS, 0.5),  # under way
    report(TRAMP, "09:00:00", MID_ATLANTIC, 0.0),
    particulars(COASTER, "04:00:00", Name="KUTCH BELLE", ImoNumber=9300121, Type=79),
    particulars(COASTER, "17:20:00", Name="  KUTCH PEARL   ", ImoNumber=9300121, Type=79),
]


def load(spark, root):
    write_ndjson(os.path.join(root, DAY, "positions.ndjson"), MESSAGES)
    return ais_messages(read_ais_day(spark, root, DAY))


def test_anchor_hours_and_congestion(spark, tmpdir_path):
    positions, _ = load(spark, tmpdir_path)
    dwell = ais.vessel_dwell(positions)
    assert {(r.mmsi, r.box, r.anchor_hours) for r in dwell.collect()} == {
        (str(COASTER), "india_west", 3), (str(FEEDER), "singapore_strait", 1)}
    assert {(r.port, r.vessels_at_anchor, r.avg_dwell_h) for r in ais.port_congestion(dwell).collect()} == {
        ("india_west", 1, 3.0), ("singapore_strait", 1, 1.0)}
    assert {r.box: r.vessels for r in ais.box_counts(dwell).collect()} == {
        "la_long_beach": 0, "singapore_strait": 1, "india_west": 1}


def test_newest_particulars_win_and_names_are_trimmed(spark, tmpdir_path):
    _, statics = load(spark, tmpdir_path)
    (vessel,) = ais.vessel_static(statics).collect()
    assert (vessel.mmsi, vessel.name, vessel.observed_at.hour) == (str(COASTER), "KUTCH PEARL", 17)


def test_missing_day_is_empty(spark, tmpdir_path):
    positions, statics = ais_messages(read_ais_day(spark, tmpdir_path, "2020-01-01"))
    assert positions.count() == 0 and ais.vessel_dwell(positions).count() == 0


def test_box_edges_and_sog_threshold(spark):
    rows = [("1", "2026-07-21 01:00:00", 33.53, -118.43, 0.4), ("2", "2026-07-21 01:00:00", 33.79, -118.05, 0.49),
            ("3", "2026-07-21 01:00:00", 33.60, -118.20, 0.5), ("", "2026-07-21 01:00:00", 33.60, -118.20, 0.1)]
    df = spark.createDataFrame(rows, "mmsi string, received_at string, lat double, lon double, sog double") \
        .selectExpr("mmsi", "cast(received_at as timestamp) received_at", "lat", "lon", "sog")
    got = sorted(r.mmsi for r in ais.vessel_dwell(df).collect())
    assert got == ["1", "2"]
