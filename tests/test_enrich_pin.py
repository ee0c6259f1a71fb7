"""Port conditions from landed payloads; PIN extraction cases."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidewater.functions.text import pincode
from tidewater.operators import enrich, rules
from tidewater.sources.bronze import read_weather, source_errors


def land(root, date, name, payload):
    os.makedirs(os.path.join(root, date), exist_ok=True)
    with open(os.path.join(root, date, f"{name}.json"), "w") as f:
        json.dump(payload, f, indent=2)


def test_conditions_and_causes(spark, tmpdir_path):
    day = "2025-02-11"
    daily = lambda code, wind, rain: {"daily": {"weather_code": [code], "wind_speed_10m_max": [wind],
                                                "precipitation_sum": [rain]}}
    land(tmpdir_path, day, "nws", {"results": {"USLGB": {"features": [{"id": "fog"}, {"id": "surf"}]}}, "errors": {}})
    land(tmpdir_path, day, "open_meteo", {"results": {"INMUN": daily(95, 81.0, 40.25), "CNSHA": daily(2, 59.9, 0.0)},
                                          "errors": {"SGSIN": "503", "DEHAM": "503"}})
    land(tmpdir_path, day, "gdelt", {"articles": [{"title": "Crane drivers walk out, HAMBURG quays idle"},
                                                  {"title": "Hamburg talks resume"}, {"title": None}]})
    cond = enrich.conditions_from_payloads(*read_weather(spark, tmpdir_path))
    rows = {r.port: r for r in cond.collect()}
    assert set(rows) == {"USLAX", "USLGB", "SGSIN", "INNSA", "INMUN", "CNSHA", "NLRTM", "DEHAM"}
    assert (rows["USLGB"].weather_alerts, rows["USLAX"].weather_alerts) == (2, 0)
    assert float(rows["INMUN"].wind_max_kmh) == 81.0 and rows["INMUN"].precip_mm == 40.25
    assert rows["DEHAM"].disruption_news == 2 and rows["NLRTM"].disruption_news == 0
    queue = spark.createDataFrame([("singapore_strait", 5), ("la_long_beach", 4)], "port string, vessels_at_anchor long")
    causes = {r.port: r.probable_cause for r in rules.port_causes(cond, queue).collect()}
    assert {p: causes[p] for p in ("USLGB", "INMUN", "DEHAM", "SGSIN", "USLAX", "CNSHA")} == {
        "USLGB": "weather", "INMUN": "weather", "DEHAM": "disruption", "SGSIN": "congestion",
        "USLAX": "unknown", "CNSHA": "unknown"}
    down = source_errors(spark, tmpdir_path, "open_meteo").first()
    assert (down.ok, down.errors, down.down) == (2, 2, False)


@pytest.mark.parametrize("address,pin", [
    ("Shed 12, Kandla Free Trade Zone 370230", "370230"),
    ("Godown 7 Bhiwandi 421-302", "421302"),
    ("Chennai - 600 058", "600058"),
    ("Kochi PIN:682OO3", "682003"),
    ("Plot l2, Hosur 635lO9", "635109"),
    ("Hub 110037, relocated to 122 051", "122051"),             # the last one
    ("Depot 560048 phone 9845012345", "560048"),               # a longer number is none
    ("Box 012345 Jaipur", None),                               # no PIN begins with 0
    ("Tower 56, Block 9 Delhi", None),
    (None, None),
])
def test_pincode(spark, address, pin):
    df = spark.createDataFrame([(address,)], "address string")
    assert df.select(pincode(F.col("address")).alias("pin")).first().pin == pin
