"""Structured Streaming forms of the batch jobs.

Every job reads files incrementally with a checkpointed file source (a file is
processed once, never split across micro-batches) and either runs stateless
row work plus ``foreachBatch`` sinks, or keeps watermarked state.  Each
``foreachBatch`` body is the batch operator applied to the micro-batch, so the
streams are tested against the batch results.

Checkpoints default to ``<spark.checkpoint.dir>/<job>`` (a shared folder on a
cluster); pass an explicit location to override.
"""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewater.functions.timefmt import iso
from tidewater.operators import ais, alerts, gold, normalize
from tidewater.session import checkpoint_dir, use_rocksdb
from tidewater.sinks import tables
from tidewater.sources.bronze import CARRIER_FIELDS, CARRIER_SCHEMA, _any_file, ais_messages, is_json_object_line, \
    parse_ais, path_exists


def _ckpt(spark: SparkSession, name: str, given: str | None) -> str:
    return given or f"{checkpoint_dir(spark).rstrip('/')}/{name}"


def _batch_tag(spark: SparkSession, batch_id: int) -> str:
    """Names a micro-batch for good: the query's id (kept in its checkpoint) and the batch number."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def _write_batch(df: DataFrame, path: str, tag: str, *partition_cols: str) -> None:
    """Write a micro-batch's rows under ``batch=<tag>``; a retry of the batch replaces them."""
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(f"{path.rstrip('/')}/batch={tag}")


def _trigger(writer, available_now: bool, interval: str | None):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


# ---- T2: normalize stream --------------------------------------------------

def carrier_stream(spark: SparkSession, bronze_root: str, max_files: int | None = None) -> DataFrame:
    """Streaming bronze carrier rows (same columns as ``read_carrier_bronze``)."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(f"{bronze_root.rstrip('/')}/*/")
    parsed = F.from_json(F.col("value"), CARRIER_SCHEMA)
    return lines.select(
        parsed.alias("j"), "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1).alias("date"),
        (~is_json_object_line(F.col("value"))).alias("_malformed"),
    ).select(*[F.col(f"j.{f}").alias(f) for f in CARRIER_FIELDS], "date", "value", "_malformed",
             "_file", "_block")


def with_ingest_order(batch: DataFrame) -> DataFrame:
    """Add the ingest-order key inside a micro-batch (a static DataFrame), where
    the row position within a file split is available."""
    return batch.withColumn("_ingest", F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                                                F.monotonically_increasing_id().alias("row"))) \
        .drop("_file", "_block")


def normalize_batch(batch: DataFrame, silver_path: str, quarantine_path: str, lastmile_path: str,
                    tag: str, horizon_days: int | None = None) -> None:
    """One micro-batch: classify, first-valid-copy per event id inside the
    batch, drop ids that other batches stored, write quarantine, last-mile and
    silver.

    Each table keeps a batch's rows in a folder of its own (``batch=<tag>``),
    which a retry replaces, and the id check leaves that folder out: a batch
    that failed between its writes gives the same tables when run again.  Every stored id is checked.  With ``horizon_days`` the check reads only the
    dates of this batch widened by the horizon (silver is partitioned by event
    date), and a copy whose event date is further away than that from the
    stored one is not recognised."""
    spark = batch.sparkSession
    cls = normalize.classify(with_ingest_order(batch)).persist()
    try:
        bad = normalize.quarantine_rows(cls).drop("_ingest", "_malformed")
        _write_batch(bad, quarantine_path, tag, "date")
        dd = normalize.dedupe(normalize.valid_rows(cls))
        dd = dd.withColumn("event_date", F.to_date("actual_ts"))
        if path_exists(spark, silver_path):
            stored = spark.read.schema("event_id string, event_date date, batch string").parquet(silver_path) \
                .where(F.col("batch") != tag)
            if horizon_days is not None:
                lo, hi = dd.agg(F.min("event_date"), F.max("event_date")).first()  # one row
                if lo is not None:
                    stored = stored.where(F.col("event_date").between(F.date_sub(F.lit(lo), horizon_days),
                                                                      F.date_add(F.lit(hi), horizon_days)))
            dd = dd.join(stored.select("event_id"), "event_id", "left_anti")
        dd = dd.persist()
        _write_batch(normalize.last_mile(dd).select(
            *normalize.LASTMILE_COLUMNS, F.col("_ingest.file").alias("_file"), F.col("_ingest.row").alias("_row")),
            lastmile_path, tag)
        _write_batch(normalize.silver_events(dd).withColumn("event_date", F.to_date("actual_ts")).drop("_ingest"),
                     silver_path, tag, "event_date")
        dd.unpersist()
    finally:
        cls.unpersist()


def start_normalize(spark: SparkSession, bronze_root: str, out_root: str, checkpoint: str | None = None,
                    available_now: bool = True, interval: str = "1 hour",
                    max_files: int | None = None, horizon_days: int | None = None) -> StreamingQuery:
    out = out_root.rstrip("/")
    w = carrier_stream(spark, bronze_root, max_files).writeStream.foreachBatch(
        lambda df, batch_id: normalize_batch(df, f"{out}/shipment_events", f"{out}/quarantine", f"{out}/last_mile",
                                             _batch_tag(df.sparkSession, batch_id), horizon_days))
    w = w.option("checkpointLocation", _ckpt(spark, "normalize", checkpoint))
    return _trigger(w, available_now, interval).start()


# ---- T2 with keyed state ----------------------------------------------------

def number_rows(batches):
    """Row numbers inside a partition (``mapInArrow``): lines of a file split come in order."""
    start = 0
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(range(start, start + batch.num_rows), pa.int64())],
                                         names=[*batch.schema.names, "_row"])
        start += batch.num_rows


def ordered_carrier_stream(spark: SparkSession, bronze_root: str, max_files: int | None = None) -> DataFrame:
    """``carrier_stream`` with the ingest order of each row, as streams can have it."""
    rows = carrier_stream(spark, bronze_root, max_files)
    schema = T.StructType([*rows.schema.fields, T.StructField("_row", T.LongType())])
    return rows.mapInArrow(number_rows, schema).withColumn("_ingest", F.struct(
        F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"))).drop("_file", "_block", "_row")


def first_copies(valid: DataFrame) -> DataFrame:
    """The first copy of each event id over the whole stream, given out in the micro-batch that brings it.

    State is one entry per id in RocksDB, and a micro-batch looks up its own
    ids only: what it reads does not grow with the history, and no horizon is
    needed.  The batch's time, fixed in the checkpoint, is the first part of the
    order, so a retry gives the same rows, and an id whose first copy is older
    is not given out again."""
    cols = [c for c in normalize.KEPT_COLUMNS if c in valid.columns]
    seen = valid.withColumn("_seen", F.current_timestamp())
    kept = seen.groupBy("event_id").agg(
        F.min_by(F.struct(*cols, "_ingest"), F.struct("_seen", "_ingest")).alias("r"), F.min("_seen").alias("_first"))
    return kept.where(F.col("_first") == F.current_timestamp()).select("event_id", "r.*")


def start_normalize_keyed(spark: SparkSession, bronze_root: str, out_root: str, checkpoint: str | None = None,
                          available_now: bool = True, interval: str = "1 hour",
                          max_files: int | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """``start_normalize`` with the seen ids in keyed state: (silver query, quarantine query).

    The quarantine needs no state and is a stream of its own over the same files."""
    use_rocksdb(spark)
    out = out_root.rstrip("/")
    rows = normalize.valid_rows(normalize.classify(ordered_carrier_stream(spark, bronze_root, max_files)))

    def write_silver(dd: DataFrame, batch_id: int) -> None:
        tag = _batch_tag(dd.sparkSession, batch_id)
        dd = dd.persist()
        try:
            _write_batch(normalize.last_mile(dd).select(*normalize.LASTMILE_COLUMNS, F.col("_ingest.file").alias("_file"),
                                                        F.col("_ingest.row").alias("_row")), f"{out}/last_mile", tag)
            _write_batch(normalize.silver_events(dd).withColumn("event_date", F.to_date("actual_ts")).drop("_ingest"),
                         f"{out}/shipment_events", tag, "event_date")
        finally:
            dd.unpersist()

    def write_quarantine(batch: DataFrame, batch_id: int) -> None:
        bad = normalize.quarantine_rows(normalize.classify(with_ingest_order(batch))).drop("_ingest", "_malformed")
        _write_batch(bad, f"{out}/quarantine", _batch_tag(batch.sparkSession, batch_id), "date")

    base = _ckpt(spark, "normalize_keyed", checkpoint)
    silver = first_copies(rows).writeStream.outputMode("update").foreachBatch(write_silver) \
        .option("checkpointLocation", f"{base}/silver")
    quarantine = carrier_stream(spark, bronze_root, max_files).writeStream.foreachBatch(write_quarantine) \
        .option("checkpointLocation", f"{base}/quarantine")
    return _trigger(silver, available_now, interval).start(), _trigger(quarantine, available_now, interval).start()


# ---- T4: AIS anchor presence --------------------------------------------------

def ais_stream(spark: SparkSession, root: str, max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.load(f"{root.rstrip('/')}/*/").select(
        parse_ais(F.col("value")).alias("m"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"))
    return ais_messages(raw.withColumn("_ingest", F.lit(0).cast("bigint")))


def raw_ais_stream(spark: SparkSession, root: str) -> DataFrame:
    """Envelope maps with file coordinates (ingest order is added per batch)."""
    return spark.readStream.format("text").load(f"{root.rstrip('/')}/*/").select(
        parse_ais(F.col("value")).alias("m"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"))


def anchor_hours_stream(positions: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Anchor-hours per (day, vessel, box) from a position stream.

    A repeat report in the same (vessel, box, hour) is dropped while it is
    within the watermark delay (which must be at least one hour); state for a
    day is evicted once the watermark passes the end of the day."""
    a = ais.anchored_positions(positions).withWatermark("received_at", delay)
    hours = a.dropDuplicatesWithinWatermark(["mmsi", "box", "hour"])
    g = hours.groupBy(F.window("received_at", "1 day").alias("day"), "mmsi", "box") \
        .agg(F.count(F.lit(1)).alias("anchor_hours"))
    return g.select("mmsi", F.to_date(F.col("day.start")).alias("date"), "box", "anchor_hours")


def start_anchor_hours(spark: SparkSession, ais_root: str, dwell_path: str, checkpoint: str | None = None,
                       available_now: bool = True, interval: str = "10 minutes",
                       max_files: int | None = None, delay: str = "2 hours") -> StreamingQuery:
    """Append each day's final anchor-hours once the watermark has passed the
    end of the day: no table rewrite, state bounded by open days."""
    positions, _ = ais_stream(spark, ais_root, max_files)
    w = anchor_hours_stream(positions, delay).writeStream.outputMode("append").format("parquet") \
        .partitionBy("date").option("path", dwell_path) \
        .option("checkpointLocation", _ckpt(spark, "anchor_hours", checkpoint))
    return _trigger(w, available_now, interval).start()


# ---- T5: vessel dimension, last write wins ---------------------------------------

def vessel_batch(batch: DataFrame, dim_root: str) -> None:
    """Upsert statics by MMSI: the newest report stays, and of equally new ones the first in ingest order.

    ``ingest`` (file, block, row inside the file) is kept with the row.  It does
    not change with a shuffle or with the way a file's rows come in several
    micro-batches, so the choice is the batch operator's; a replayed old day
    cannot regress the dimension."""
    spark = batch.sparkSession
    lines = number_lines(batch.select("m", F.col("_file").alias("file_path"), F.col("_block").alias("block")))
    _, statics = ais_messages(lines.withColumn("_ingest", F.struct(F.col("file_path").alias("file"), F.col("line"))))
    known = statics.where(F.col("mmsi").isNotNull() & (F.col("mmsi") != ""))
    new = known.select("mmsi", F.col("imo").cast("string").alias("imo"), F.trim("name").alias("name"),
                       F.col("type").cast("string").alias("type"), F.col("received_at").alias("observed_at"),
                       F.col("_ingest").alias("ingest"))
    current = tables.read_current(spark, dim_root)
    if current is not None:
        new = new.unionByName(current.select(*new.columns))
    # the smallest of (newest first, ingest order): times are negated, so the first copy wins
    order = F.struct((-F.unix_micros("observed_at")).alias("t"), "ingest")
    undated = F.col("observed_at").isNull()
    best = new.groupBy("mmsi").agg(F.min_by(F.struct("imo", "name", "type", "observed_at", "ingest"),
                                            F.struct(undated.alias("u"), order.alias("o"))).alias("v"))
    tables.write_version(best.select("mmsi", "v.*"), dim_root)


def start_vessels(spark: SparkSession, ais_root: str, dim_root: str, checkpoint: str | None = None,
                  available_now: bool = True, interval: str = "1 hour") -> StreamingQuery:
    w = raw_ais_stream(spark, ais_root).writeStream.foreachBatch(lambda df, _id: vessel_batch(df, dim_root)) \
        .option("checkpointLocation", _ckpt(spark, "vessels", checkpoint))
    return _trigger(w, available_now, interval).start()


# ---- T6 / T7: queue-driven jobs ---------------------------------------------------

def queue_stream(spark: SparkSession, snapshots_root: str, schema) -> DataFrame:
    """New exception-queue snapshots (``snapshot_ts=`` partitions) as a stream."""
    return spark.readStream.schema(schema).parquet(snapshots_root)


def _newest_snapshot(batch: DataFrame) -> DataFrame:
    return tables.snapshot_as_of(batch, datetime(9999, 1, 1)).drop("snapshot_ts")


def mart_batch(batch: DataFrame, mart_path: str) -> None:
    """Rebuild the exception mart from the newest queue snapshot in the batch."""
    gold.exception_mart(_newest_snapshot(batch)).write.mode("overwrite").parquet(mart_path)


def start_exception_mart(spark: SparkSession, snapshots_root: str, schema, mart_path: str,
                         checkpoint: str | None = None, available_now: bool = True,
                         interval: str = "15 minutes") -> StreamingQuery:
    w = queue_stream(spark, snapshots_root, schema).writeStream \
        .foreachBatch(lambda df, _id: mart_batch(df, mart_path)) \
        .option("checkpointLocation", _ckpt(spark, "exception_mart", checkpoint))
    return _trigger(w, available_now, interval).start()


def alert_batch(batch: DataFrame, state_root: str, decisions_path: str, now: str | datetime,
                tag: str, counters: DataFrame | None = None) -> None:
    """Decide on the newest queue snapshot against the state before this batch,
    write the decisions under ``batch=<tag>`` and switch to the next state
    version, named by the tag.

    A batch replayed at any point, also after the switch, starts from the same
    state and replaces its decisions by equal ones.  ``counters`` (a run's
    ``events_read, quarantined_total``) adds the ops alert for a quarantine
    spike, whose key of the day enters the same state."""
    spark = batch.sparkSession
    queue = _newest_snapshot(batch)
    state = tables.read_before(spark, state_root, tag)
    if state is None:
        state = spark.createDataFrame([], "exception_id string, type string, band int, alerted_at timestamp")
    decided = alerts.decide(queue, state)
    ops = None
    if counters is not None:
        ops = alerts.quarantine_spike(counters, state, now)
        _write_batch(ops, f"{decisions_path.rstrip('/')}_ops", tag)
        ops = spark.read.parquet(f"{decisions_path.rstrip('/')}_ops/batch={tag}")
    _write_batch(decided, decisions_path, tag)
    written = spark.read.schema(decided.schema).parquet(f"{decisions_path.rstrip('/')}/batch={tag}")
    tables.write_version(alerts.next_state(state, written, now, ops=ops), state_root, tag)


# ---- T1: landing validation ---------------------------------------------------------

def landing_batch(batch: DataFrame, bronze_root: str, rejected_path: str, date: str, tag: str) -> None:
    """Land the accepted files of a micro-batch of lines (``value, file_path, block, ok``).

    A file whose every line is one JSON object lands under its content's digest
    as ``<bronze>/<date>/events_<digest>-<part>.ndjson``, lines in order, where
    ``read_carrier_bronze`` finds it.  A (date, digest) that has landed before
    does not land again.  The ledger ``<bronze>/_ledger/batch=<tag>`` lists every
    file with its digest and outcome (landed, repeat, rejected) before anything
    is moved in; a retry follows the ledger of its first attempt, and parts
    already in place stay."""
    spark = batch.sparkSession
    root = bronze_root.rstrip("/")
    ledger, staging = f"{root}/_ledger/batch={tag}", f"{root}/_staging/{tag}"
    if not path_exists(spark, f"{ledger}/_SUCCESS"):
        numbered = number_lines(batch)
        plan = content_digests(numbered).withColumn("date", F.lit(date))
        known = spark.read.schema(_LEDGER).parquet(f"{root}/_ledger/*").where("outcome = 'landed'") \
            if _any_file(spark, f"{root}/_ledger/*/_SUCCESS") else spark.createDataFrame([], _LEDGER)
        known = known.select("date", "digest").distinct().withColumn("known", F.lit(True))
        first = plan.where("ok").groupBy("date", "digest").agg(F.min("file_path").alias("first"))
        plan = plan.join(first, ["date", "digest"], "left").join(known, ["date", "digest"], "left")
        outcome = (F.when(~F.col("ok"), "rejected").when(F.col("known") | (F.col("first") != F.col("file_path")), "repeat")
                   .otherwise("landed"))
        plan.select("file_path", "date", "digest", "lines", outcome.alias("outcome")).write.mode("overwrite").parquet(ledger)
    plan = spark.read.schema(_LEDGER).parquet(ledger)
    _write_batch(plan.where("outcome = 'rejected'").select("file_path", "lines"), rejected_path, tag)
    fresh = plan.where("outcome = 'landed'").select("file_path", "digest")
    lines = number_lines(batch).join(fresh, "file_path").select("digest", "line", "value")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines.repartitionByRange(width, "digest", "line").sortWithinPartitions("digest", "line").select("digest", "value") \
        .write.mode("overwrite").partitionBy("digest").text(staging)
    _move_parts(spark, staging, f"{root}/{date}")


_LEDGER = "file_path string, date string, digest string, lines bigint, outcome string"


def number_lines(batch: DataFrame) -> DataFrame:
    """``line``: a line's number in its file, however the file was split (a split is read by one task, in order)."""
    rows = batch.withColumn("_row", F.monotonically_increasing_id())
    blocks = rows.groupBy("file_path", "block").agg(F.min("_row").alias("_start"), F.count(F.lit(1)).alias("_lines"))
    before = F.sum("_lines").over(Window.partitionBy("file_path").orderBy("block")) - F.col("_lines")
    blocks = blocks.select("file_path", "block", "_start", before.alias("_before"))
    return rows.join(blocks, ["file_path", "block"]).withColumn(
        "line", F.col("_before") + F.col("_row") - F.col("_start")).drop("_row", "_start", "_before")


def content_digests(lines: DataFrame) -> DataFrame:
    """``file_path, lines, ok, digest`` of numbered lines.

    The digest is taken over the hashes of (line number, line), which any task
    may sum for its block: files of any size, the same digest however they are
    split, another one if lines change places."""
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "line", "value"))
    g = lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("lines"), F.every("ok").alias("ok"),
                                       mark(1).alias("x"), mark(2).alias("y"))
    return g.select("file_path", "lines", "ok", F.substring(F.sha1(F.concat_ws(":", "lines", "x", "y")), 1, 12).alias("digest"))


def _move_parts(spark: SparkSession, staging: str, target: str) -> None:
    """Rename staged parts to their content's name; one that is there already is left as it is."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(target))
    for folder in fs.globStatus(path(f"{staging}/digest=*")) or []:
        digest = folder.getPath().getName().removeprefix("digest=")
        parts = sorted(f.getPath().toString() for f in fs.globStatus(path(f"{folder.getPath().toString()}/part-*")))
        for i, part in enumerate(parts):
            to = path(f"{target}/events_{digest}-{i:05d}.ndjson")
            if not fs.exists(to):
                fs.rename(path(part), to)
    fs.delete(path(staging), True)


def start_landing(spark: SparkSession, landing: str, bronze_root: str, rejected_path: str, date: str,
                  checkpoint: str | None = None, available_now: bool = True,
                  interval: str = "5 minutes", max_files: int = 1000) -> StreamingQuery:
    """Land new files of ``landing``; a micro-batch takes at most ``max_files`` (the driver renames so many)."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(landing).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        is_json_object_line(F.col("value")).alias("ok"))
    w = lines.writeStream.foreachBatch(lambda df, batch_id: landing_batch(
        df, bronze_root, rejected_path, date, _batch_tag(df.sparkSession, batch_id))) \
        .option("checkpointLocation", _ckpt(spark, "landing", checkpoint))
    return _trigger(w, available_now, interval).start()


# ---- K12: AIS bronze append ------------------------------------------------------------

def stamp_and_filter(messages: DataFrame, message_types=("PositionReport", "ShipStaticData")) -> DataFrame:
    """Stamp each raw message with its receipt time and keep subscribed types;
    position reports must fall inside a configured box (statics always pass).
    ``messages`` holds the raw JSON text in ``value``."""
    m = parse_ais(F.col("value"))
    mt = m["mt"]
    a, b, pos = m["meta_a"], m["meta_b"], m["msg"]["pos"]      # coordinates may be in the metadata only
    in_box = ais.box_of(F.coalesce(pos["lat"], a["lat_lc"], b["lat_lc"], a["lat_uc"], b["lat_uc"]),
                        F.coalesce(pos["lon"], a["lon_lc"], b["lon_lc"], a["lon_uc"], b["lon_uc"])).isNotNull()
    stamped = messages.select("value", F.current_timestamp().alias("received_at"), mt.alias("_mt"),
                              in_box.alias("_in_box"))
    return stamped.where(F.col("_mt").isin(*message_types)
                         & ((F.col("_mt") != "PositionReport") | F.col("_in_box"))) \
        .select(_with_received_at(F.col("value"), F.col("received_at")).alias("value"),
                F.date_format("received_at", "yyyy-MM-dd").alias("date"))


def _with_received_at(message: Column, at: Column) -> Column:
    """The message's JSON text with ``received_at`` inside it as its last field (an earlier one yields to it)."""
    body = F.regexp_replace(F.btrim(message), r"\s*\}$", "")
    comma = F.when(F.endswith(F.btrim(body), F.lit("{")), F.lit("")).otherwise(F.lit(","))
    return F.concat(body, comma, F.lit('"received_at":"'), iso(at), F.lit('"}'))


def ais_bronze_batch(batch: DataFrame, bronze_root: str, tag: str) -> None:
    """Write a micro-batch's messages, original text with the receipt time, by receipt date.

    The text of one date goes to ``<date>/batch-<tag>.ndjson/``; the receipt
    time is the batch's, so there are one or two dates a batch."""
    kept = stamp_and_filter(batch).persist()
    try:
        for row in kept.select("date").distinct().collect():
            kept.where(F.col("date") == row.date).select("value").write.mode("overwrite").text(
                f"{bronze_root.rstrip('/')}/{row.date}/batch-{tag}.ndjson")
    finally:
        kept.unpersist()


def start_ais_bronze(spark: SparkSession, landing: str, bronze_root: str, checkpoint: str | None = None,
                     available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Append stamped, filtered AIS messages to ``bronze/<receipt date>``, where ``read_ais_day`` finds them."""
    src = spark.readStream.format("text").load(landing)
    w = src.writeStream.foreachBatch(lambda df, batch_id: ais_bronze_batch(
        df, bronze_root, _batch_tag(df.sparkSession, batch_id))) \
        .option("checkpointLocation", _ckpt(spark, "ais_bronze", checkpoint))
    return _trigger(w, available_now, interval).start()
