"""Exact medians, content-addressed landing, keyed first copies, alert state that survives a replay."""

import json
import os
import random
import shutil
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import write_ndjson
from test_alerts import counters
from test_normalize import ROWS
from test_streaming import _feed_files, _queue
from tidewater.operators import normalize
from tidewater.operators.selection import medians
from tidewater.sinks import tables
from tidewater.sources.bronze import read_carrier_bronze
from tidewater.streaming import jobs


# ---- medians --------------------------------------------------------------------

@pytest.mark.parametrize("accuracy", [200, 10_000])
def test_medians_equal_the_sorted_middle(spark, accuracy):
    rng = random.Random(8)
    rows = [("hot", None, rng.choice([rng.gauss(0, 50), 7.0, -3.5])) for _ in range(25_001)]
    rows += [("hot", "x", float(rng.randrange(9))) for _ in range(4_000)]
    rows += [(None, "x", v) for v in (1.0, 5.0)] + [("one", "y", 4.25), ("none", "y", None)]
    rows += [("pair", "y", 1e300), ("pair", "y", -1e300), ("tied", "y", 2.0), ("tied", "y", 2.0), ("tied", "y", 9.0)]
    rows += [("many", "z", float(i)) for i in range(101)] + [("edge", "z", float(i)) for i in range(102)]
    df = spark.createDataFrame(rows, "a string, b string, v double").repartition(7)
    want = {}
    for a, b, v in rows:
        if v is not None:
            want.setdefault((a, b), []).append(v)
    got = {(r.a, r.b): (r.n, r.median) for r in medians(df, ["a", "b"], "v", accuracy).collect()}
    assert got == {k: (len(v), statistics.median(v)) for k, v in want.items()}
    whole = medians(df, [], "v", accuracy).first()
    values = [r[2] for r in rows if r[2] is not None]
    assert (whole.n, whole.median) == (len(values), statistics.median(values))
    assert medians(df.where("a = 'none'"), [], "v").count() == 0


def test_median_window_holds_only_the_middle(spark):
    """Nearly all of a group's distinct values are counted below or left out above the range, never listed."""
    df = spark.range(200_000).select(F.rand(3).alias("v"))
    plan_input = medians(df, [], "v")._jdf.queryExecution().toString()
    assert "Window" in plan_input
    ends = df.select(F.percentile_approx("v", [0.4998, 0.5002], 10_000).alias("e")).first().e
    assert df.where(F.col("v").between(*ends)).count() < 200


# ---- landing --------------------------------------------------------------------

def lines_of(folder):
    return {f: open(os.path.join(folder, f)).read().splitlines() for f in sorted(os.listdir(folder)) if f.endswith(".ndjson")}


def land(spark, base, date="2025-03-08", ck="ck"):
    jobs.start_landing(spark, f"{base}/landing", f"{base}/bronze", f"{base}/rejected", date,
                       checkpoint=f"{base}/{ck}").awaitTermination()


def test_landed_files_are_read_back_in_order_and_replays_land_nothing(spark, tmpdir_path):
    base = tmpdir_path
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")     # several splits a file
    try:
        big = [dict(ROWS[0], event_id=f"e{i:04d}") for i in range(120)]
        write_ndjson(f"{base}/landing/big.ndjson", big)
        write_ndjson(f"{base}/landing/two words+50%.ndjson", ROWS[:3])
        write_ndjson(f"{base}/landing/same.ndjson", ROWS[:3])          # the same content twice
        write_ndjson(f"{base}/landing/turned.ndjson", ROWS[:3][::-1])  # the same lines in another order
        write_ndjson(f"{base}/landing/bad.ndjson", [ROWS[0], "{oops"])
        land(spark, base)
        got = read_carrier_bronze(spark, f"{base}/bronze").orderBy("_ingest").collect()
        assert len(got) == 120 + 3 + 3 and {r.date for r in got} == {"2025-03-08"}
        assert [r.event_id for r in got if r.event_id.startswith("e0")] == [r["event_id"] for r in big]
        ledger = {os.path.basename(r.file_path): r.outcome for r in spark.read.parquet(f"{base}/bronze/_ledger/*").collect()}
        assert ledger["bad.ndjson"] == "rejected" and sorted(ledger.values()) == ["landed"] * 3 + ["rejected", "repeat"]
        files = lines_of(f"{base}/bronze/2025-03-08")
        digests = {r.digest for r in spark.read.parquet(f"{base}/bronze/_ledger/*").where("outcome = 'landed'").collect()}
        assert {f.split("_")[1].split("-")[0] for f in files} == digests
        # a new run over the same files, as if its checkpoint were lost, lands nothing; another date does
        land(spark, base, ck="ck2")
        assert lines_of(f"{base}/bronze/2025-03-08") == files
        land(spark, base, date="2025-03-09", ck="ck3")
        assert sum(map(len, lines_of(f"{base}/bronze/2025-03-09").values())) == 126
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_digest_does_not_depend_on_splits(spark, tmpdir_path):
    write_ndjson(f"{tmpdir_path}/a.ndjson", [{"event_id": str(i)} for i in range(400)])

    def digest(split):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        lines = spark.read.text(f"{tmpdir_path}/*.ndjson").select(
            "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
            F.lit(True).alias("ok"))
        r = jobs.content_digests(jobs.number_lines(lines)).first()
        return r.digest, r.lines

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        assert digest("1k") == digest("3k") == digest("128m") == (digest("700b")[0], 400)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_landing_that_failed_half_way_follows_its_first_ledger(spark, tmpdir_path, monkeypatch):
    base = tmpdir_path
    write_ndjson(f"{base}/landing/a.ndjson", ROWS[:4])
    write_ndjson(f"{base}/landing/b.ndjson", ROWS[4:6])
    move = jobs._move_parts

    def failing(spark, staging, target):
        move(spark, staging, target)
        raise OSError("lost after the move")

    monkeypatch.setattr(jobs, "_move_parts", failing)
    with pytest.raises(Exception):
        land(spark, base)
    monkeypatch.setattr(jobs, "_move_parts", move)
    land(spark, base)
    assert read_carrier_bronze(spark, f"{base}/bronze").count() == 6
    assert {r.outcome for r in spark.read.parquet(f"{base}/bronze/_ledger/*").collect()} == {"landed"}


# ---- first copies with keyed state --------------------------------------------------

def keyed(spark, bronze, out, ck, **more):
    silver, quarantine = jobs.start_normalize_keyed(spark, bronze, out, checkpoint=ck, **more)
    silver.awaitTermination()
    quarantine.awaitTermination()
    return silver


def test_keyed_normalize_equals_batch(spark, tmpdir_path):
    bronze, out, ck = (os.path.join(tmpdir_path, x) for x in ("bronze", "silver", "ck"))
    n = _feed_files(spark, bronze, 4)
    keyed(spark, bronze, out, ck, max_files=2)
    cls = normalize.classify(read_carrier_bronze(spark, bronze))
    want = normalize.silver_events(normalize.dedupe(normalize.valid_rows(cls))).drop("_ingest")
    got = spark.read.parquet(f"{out}/shipment_events")
    cols = ["event_id", "shipment_id", "event_type", "actual_ts", "origin", "dest"]
    assert got.count() == want.count() > 0 and got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    bad = spark.read.parquet(f"{out}/quarantine").count()
    assert bad == normalize.quarantine_rows(cls).count() and bad + cls.where("reason is null").count() == n


def test_first_copy_wins_over_batches_and_only_the_batch_is_looked_up(spark, tmpdir_path):
    bronze, out, ck = (os.path.join(tmpdir_path, x) for x in ("bronze", "silver", "ck"))
    many = [dict(ROWS[0], event_id=f"old{i}") for i in range(300)]
    write_ndjson(f"{bronze}/2025-03-08/a.ndjson", many + ROWS[:5] + [dict(ROWS[0], origin="LATER")])
    keyed(spark, bronze, out, ck)
    write_ndjson(f"{bronze}/2025-03-09/b.ndjson", [dict(ROWS[1], origin="ZZZZZ"), ROWS[6], dict(many[7], origin="ZZZZZ")])
    q = keyed(spark, bronze, out, ck)
    got = {r.event_id: r.origin for r in spark.read.parquet(f"{out}/shipment_events").collect()}
    assert got["sail"] == "DEHAM" and got["old7"] == many[7]["origin"] and got["book"] != "LATER"
    assert spark.read.parquet(f"{out}/shipment_events").groupBy("event_id").count().where("count > 1").count() == 0
    touched = [json.loads(p.json)["stateOperators"][0] for p in q.recentProgress if p.numInputRows]
    assert [t["numRowsUpdated"] for t in touched] == [3] and touched[0]["numRowsTotal"] > 300


# ---- alerts --------------------------------------------------------------------------

def test_replay_after_the_state_switch_gives_the_first_decisions(spark, tmpdir_path):
    snaps, state, out = (os.path.join(tmpdir_path, x) for x in ("snaps", "state", "decisions"))
    run = lambda day, tag, c=None: jobs.alert_batch(
        spark.read.parquet(snaps).where(F.to_date("snapshot_ts") == day), state, out, f"{day}T00:00:00Z", tag, c)
    decided = lambda tag: sorted((r.exception_id, r.decision) for r in spark.read.parquet(f"{out}/batch={tag}").collect())
    held = lambda: sorted((r.exception_id, r.type, r.band) for r in tables.read_current(spark, state).collect())
    fired = lambda tag: [r.exception_id for r in spark.read.parquet(f"{out}_ops/batch={tag}").collect()]
    spike = counters(spark, 1000, 111)
    tables.append_snapshot(_queue(spark, [10.0, 100.0]), snaps, "2026-07-20T00:00:00Z")
    tables.append_snapshot(_queue(spark, [60.0, 101.0, 5.0]), snaps, "2026-07-21T00:00:00Z")
    for _ in range(2):                                   # the second time after its own switch
        run("2026-07-20", "q-0", spike)
        assert decided("q-0") == [("e0", "new"), ("e1", "new")] and fired("q-0") == ["ops:quarantine_spike:2026-07-20"]
        first = held()
    assert ("ops:quarantine_spike:2026-07-20", "ops", 0) in first and len(first) == 3
    run("2026-07-20", "q-1", spike)                      # another run of the day: nothing is sent again
    assert {d for _, d in decided("q-1")} == {"suppressed"} and fired("q-1") == [] and held() == first
    for _ in range(3):
        run("2026-07-21", "q-2", spike)
        assert decided("q-2") == [("e0", "escalated"), ("e1", "suppressed"), ("e2", "new")]
        assert fired("q-2") == ["ops:quarantine_spike:2026-07-21"]
    assert len(held()) == 5
    shutil.rmtree(out)
    run("2026-07-21", "q-2", spike)                      # also with its decisions lost
    assert decided("q-2") == [("e0", "escalated"), ("e1", "suppressed"), ("e2", "new")]
