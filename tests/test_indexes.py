"""Phrase matching, the cell index, table fingerprints, the maintained mart, vessel order over micro-batches."""

import os
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import write_ndjson
from test_ais import DAY, MESSAGES
from test_streaming import _queue
from tidewater import config
from tidewater.functions import phrases
from tidewater.operators import ais, boxes, gold, metrics, quality
from tidewater.sinks import tables
from tidewater.sources.bronze import ais_messages, read_ais_day
from tidewater.streaming import jobs, mart


# ---- phrases ------------------------------------------------------------------

def test_trie_pattern_takes_the_longest():
    words = ["los", "los angeles", "la", "l.a.", "lo", "osaka", "s", "日本", "日本海", "a+b", "a b"]
    pattern = re.compile(phrases.trie_pattern(words))
    for w in words:
        assert pattern.fullmatch(w)
    assert pattern.match("los angeles!")[0] == "los angeles" and pattern.match("los ange")[0] == "los"
    assert not pattern.match("lxa.") and not pattern.match("a")


def test_found_phrases_equal_containment(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abc ", k=rng.randrange(1, 6))) for _ in range(60)} | {"a.b", "(c", "日本", "ß"})
    texts = ["".join(rng.choices("abc  .(日本ß", k=rng.randrange(30))) for _ in range(300)] + ["", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r.id: r.f for r in df.select("id", phrases.found(F.col("t"), words).alias("f")).collect()}
    for i, t in enumerate(texts):
        assert got[i] is None if t is None else sorted(got[i]) == [w for w in words if w in t]


@pytest.mark.parametrize("mode", ["substring", "token"])
def test_questions_need_no_nested_loop(spark, mode):
    q = spark.createDataFrame([(1, "Which carrier has the best on time rate at Singapore?")], "question_id int, question string")
    plan = metrics.resolve_questions(q, mode)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


# ---- boxes --------------------------------------------------------------------

def test_cell_index_equals_the_case_chain(spark):
    rng = random.Random(2)
    pts = [(i, rng.uniform(-2, 36), rng.choice([rng.uniform(60, 110), rng.uniform(-120, -117)])) for i in range(2_000)]
    for _, _, lo, hi in config.AIS_BOXES:
        pts += [(9000, *lo), (9001, *hi), (9002, lo[0], hi[1]), (9003, lo[0] - 1e-9, lo[1])]
    pts += [(9004, None, 3.0), (9005, 3.0, None)]
    df = spark.createDataFrame(pts, "id int, lat double, lon double").withColumn("boxes", F.lit("mine"))
    for degrees in (0.25, 1.0, 30.0):
        got = boxes.assign_boxes(df, config.boxes_df(spark), degrees).select("id", "lat", "lon", "box")
        want = df.select("id", "lat", "lon", ais.box_of(F.col("lat"), F.col("lon")).alias("box"))
        assert quality.identical(got, want).first().failures == 0


def test_many_boxes_first_one_wins(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3_000):
        lat, lon = rng.uniform(-89, 88), rng.uniform(-179, 178)
        rows.append((f"b{i}", rng.randrange(10**6), lat, lon, lat + rng.uniform(-.2, 2), lon + rng.uniform(-.2, 2)))
    known = spark.createDataFrame(rows, "box string, ord int, lat0 double, lon0 double, lat1 double, lon1 double")
    pts = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(500)]
    points = spark.createDataFrame(pts, "id int, lat double, lon double")
    joined = boxes.assign_boxes(points, known)
    got = {r.id: r.box for r in joined.collect()}
    for i, lat, lon in pts:
        inside = [(o, b) for b, o, a0, o0, a1, o1 in rows if a0 <= lat <= a1 and o0 <= lon <= o1]
        assert got[i] == (min(inside)[1] if inside else None)
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


# ---- row identity ---------------------------------------------------------------

def test_identity_counts_duplicates_nulls_and_order(spark):
    rows = [(i % 50, None if i % 7 else "x", float(i % 3)) for i in range(400)]
    schema = "a int, b string, c double"
    one = spark.createDataFrame(rows, schema)
    same = spark.createDataFrame(rows[::-1], schema).repartition(5).select("c", "a", "b")
    assert quality.unequal_buckets(one, same.select("a", "b", "c")).count() == 0
    assert quality.identical(one, same).first().failures == 0
    both_ways = lambda x, y: x.exceptAll(y).count() + y.exceptAll(x).count()
    for other in (rows[1:], rows + rows[:3], [(0, "x", 9.0)] + rows[1:], [], [(None, "x", 1.0), (1, None, None)]):
        df = spark.createDataFrame(other, schema)
        assert quality.identical(one, df).first().failures == both_ways(one, df) > 0
    swapped = spark.createDataFrame([(None, "1"), ("1", None)], "a string, b string")
    assert quality.identical(swapped, spark.createDataFrame([("1", None), ("1", None)], "a string, b string")).first().failures == 2


# ---- maintained mart --------------------------------------------------------------

def _snapshot(spark, rng, held):
    for i in range(40):
        roll = rng.random()
        if roll < .35:
            held.pop(f"e{i}", None)
        elif roll < .8:
            held[f"e{i}"] = (rng.choice(["A", "B"]), rng.choice(["weather", "unknown"]), rng.choice(["C1", "C2"]), rng.randrange(1200) / 10)
    rows = [(k, "S", c, t, age, "d", p) for k, (t, p, c, age) in held.items()]
    return spark.createDataFrame(rows, _queue(spark, [1.0]).schema)


def test_maintained_mart_equals_the_batch_mart_after_every_snapshot(spark, tmpdir_path, two_partitions):
    rng, held = random.Random(5), {}
    snaps, root, ck = (os.path.join(tmpdir_path, x) for x in ("snaps", "mart", "ck"))
    at = datetime(2026, 7, 20)
    key = lambda r: tuple(r[c] for c in ("exception_type", "probable_cause", "carrier", "open_exceptions", "avg_age_h",
                                         "max_age_h", "band2_escalations"))

    def step():
        schema = spark.read.parquet(snaps).schema
        mart.start_incremental_mart(spark, snaps, schema, root, checkpoint=ck).awaitTermination()
        return sorted(map(key, mart.read_mart(spark, root).collect()))

    for n in range(4):
        for _ in range(1 + n % 2):      # sometimes two snapshots in one micro-batch
            at += timedelta(hours=1)
            queue = _snapshot(spark, rng, held)
            tables.append_snapshot(queue, snaps, at)
        want = sorted(map(key, gold.exception_mart(queue).collect()))
        assert step() == want
    tables.append_snapshot(queue.limit(1), snaps, datetime(2026, 7, 19))   # a late, older one
    assert step() == want


def test_changes_touch_their_buckets_and_a_replay_changes_nothing(spark, tmpdir_path, two_partitions):
    root = os.path.join(tmpdir_path, "mart")
    q1 = _queue(spark, [10.0, 100.0, 30.0])
    q2 = q1.withColumn("carrier", F.when(F.col("exception_id") == "e1", "ZZZZ").otherwise(F.col("carrier")))
    read = lambda: sorted(map(tuple, mart.read_mart(spark, root).collect()))
    assert read() == []
    first = mart.apply_changes(mart.queue_changes(None, q1), root, 0)
    for _ in range(2):                                    # again after its own result
        changed = mart.apply_changes(mart.queue_changes(q1, q2), root, 1)
        assert read() == sorted(map(tuple, gold.exception_mart(q2).select(*mart.read_mart(spark, root).columns).collect()))
    assert len(first) == 1 and len(changed) == 2
    assert mart.apply_changes(mart.queue_changes(q2, q2), root, 2) == []
    mart.apply_changes(mart.queue_changes(q2, q2.where("exception_id = 'e0'")), root, 3)
    assert [r[3:] for r in read()] == [(1, 10.0, 10.0, 0)]
    mart.apply_changes(mart.queue_changes(q2.where("exception_id = 'e0'"), q2.limit(0)), root, 4)
    assert read() == []


# ---- vessels ------------------------------------------------------------------------

@pytest.mark.parametrize("split", [1, 2, 5])
def test_equal_reports_resolve_as_in_batch_for_any_split(spark, tmpdir_path, split):
    static = next(m for m in MESSAGES if m["MessageType"] == "ShipStaticData")
    rows = []
    for i in range(5):     # five reports of one instant with different names
        m = {**static, "Message": {"ShipStaticData": {**static["Message"]["ShipStaticData"], "Name": f"NAME {i}"}}}
        rows.append(m)
    src, whole, root, ck = (os.path.join(tmpdir_path, x) for x in ("ais", "whole", "dim", "ck"))
    for i in range(0, 5, split):
        write_ndjson(os.path.join(src, DAY, f"{i}.ndjson"), rows[i:i + split])
        write_ndjson(os.path.join(whole, DAY, f"{i}.ndjson"), rows[i:i + split])
        jobs.start_vessels(spark, src, root, checkpoint=ck).awaitTermination()
    want = ais.vessel_static(ais_messages(read_ais_day(spark, whole, DAY))[1]).first()
    got = tables.read_current(spark, root).first()
    assert (got.name, got.observed_at) == (want.name, want.observed_at) and got.name == "NAME 0"
