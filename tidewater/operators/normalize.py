"""Bronze -> silver: validate, quarantine, de-duplicate, project.

``classify`` adds ``reason`` (NULL for a valid row) and the parsed columns in a
single projection; ``dedupe`` keeps the first valid row per ``event_id`` in
ingest order with one aggregate (partial aggregation runs before the shuffle,
so a hot id is collapsed map-side).  Nothing here needs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions.text import pincode
from tidewater.functions.timefmt import parse_wire_ts

SILVER_COLUMNS = ["event_id", "shipment_id", "carrier", "event_type", "planned_ts",
                  "actual_ts", "origin", "dest", "vessel_mmsi"]
LASTMILE_COLUMNS = ["shipment_id", "address_raw", "pincode", "eway_bill_no", "eway_valid_until"]


def _ref_valid(carrier: Column, ref: Column) -> Column:
    """Reference matches the carrier's pattern; unknown carrier -> False.

    With a handful of carriers a chain of literal patterns beats a join: each
    regex is compiled once per task, not per row."""
    checks = [F.when(carrier == code, ref.rlike(pattern)) for code, _, pattern, _ in config.CARRIERS]
    return F.coalesce(*checks, F.lit(False))


def _ts_format(carrier: Column) -> Column:
    return F.coalesce(*[F.when(carrier == code, F.lit(fmt)) for code, _, _, fmt in config.CARRIERS])


def _status_map() -> Column:
    pairs = []
    for raw, canonical in config.STATUS_MAP.items():
        pairs += [F.lit(raw), F.lit(canonical)]
    return F.create_map(*pairs)


def _milestone_index(event_type: Column) -> Column:
    pairs = []
    for name, idx in config.MILESTONE_INDEX.items():
        pairs += [F.lit(name), F.lit(idx)]
    return F.try_element_at(F.create_map(*pairs), event_type)


def classify(raw: DataFrame) -> DataFrame:
    """Add ``reason`` (first failing check: malformed_record, unmapped_ref,
    unknown_status, unparseable_time) and parsed ``event_type``,
    ``actual_ts``, ``planned_ts``, ``ms_idx``, ``eway_ts``.

    ``raw`` needs the text columns of the carrier wire record; absent optional
    fields may be NULL."""
    # The wire format is computed once and referenced by name below.
    fmt = F.col("_ts_fmt")
    parsed = raw.withColumn("_ts_fmt", _ts_format(F.col("carrier"))).select(
        "*",
        F.try_element_at(_status_map(), F.col("status")).alias("event_type"),
        parse_wire_ts(F.col("timestamp"), fmt).alias("actual_ts"),
        parse_wire_ts(F.col("planned"), fmt).alias("planned_ts"),
        parse_wire_ts(F.col("eway_valid_until"), fmt).alias("eway_ts"),
        _ref_valid(F.col("carrier"), F.coalesce(F.col("ref"), F.lit(""))).alias("_ref_ok"),
    )
    malformed = F.col("event_id").isNull()
    if "_malformed" in raw.columns:
        malformed = malformed | F.col("_malformed")
    reason = (
        F.when(malformed, F.lit("malformed_record"))
        .when(~F.col("_ref_ok"), F.lit("unmapped_ref"))
        .when(F.col("event_type").isNull(), F.lit("unknown_status"))
        .when(F.col("actual_ts").isNull() | F.col("planned_ts").isNull(), F.lit("unparseable_time"))
    )
    return parsed.select(
        *[c for c in parsed.columns if c not in ("_ref_ok", "_ts_fmt")],
        reason.alias("reason"),
        _milestone_index(F.col("event_type")).alias("ms_idx"),
    )


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNull())


def quarantine_rows(classified: DataFrame) -> DataFrame:
    """Bad rows with their original payload and ``reason``."""
    return classified.where(F.col("reason").isNotNull()).drop(
        "event_type", "actual_ts", "planned_ts", "ms_idx", "eway_ts")


# Columns a de-duplicated row keeps (what silver and last-mile read).
KEPT_COLUMNS = ["ref", "carrier", "event_type", "ms_idx", "planned_ts", "actual_ts", "origin",
                "dest", "vessel_mmsi", "delivery_address", "eway_bill_no", "eway_ts"]


def dedupe(valid: DataFrame, order_col: str = "_ingest") -> DataFrame:
    """First valid row per ``event_id`` in ingest order (total order column).

    The picked value carries only the parsed columns silver and last-mile
    need, which keeps the aggregation buffer and the shuffle narrow."""
    return _first_rows(valid, order_col, lambda c: c)


def dedupe_classified(classified: DataFrame, order_col: str = "_ingest") -> DataFrame:
    """``dedupe(valid_rows(classified))`` with the test for ``reason`` inside the aggregate.

    As a filter the optimizer writes it out in terms of the raw columns and
    moves it below the parsing, into the join the feed comes from: every row
    is then formatted and parsed twice or more.  Bad rows are passed over by
    ``min``; an id with bad rows only has no row."""
    return _first_rows(classified, order_col, lambda c: F.when(F.col("reason").isNull(), c))


def _first_rows(rows: DataFrame, order_col: str, of_valid) -> DataFrame:
    # One struct, the order first: ``min_by`` would keep and shuffle the order column three times.
    cols = [c for c in KEPT_COLUMNS if c in rows.columns]
    first = F.when(F.col(order_col).isNotNull(), F.struct(order_col, *cols))
    kept = rows.groupBy("event_id").agg(F.min(of_valid(first)).alias("r")).where(F.col("r").isNotNull())
    return kept.select("event_id", *[F.col(f"r.{c}").alias(c) for c in [*cols, order_col]])


def silver_events(deduped: DataFrame) -> DataFrame:
    """shipment_events: the silver projection (NULL = missing)."""
    return deduped.select(
        "event_id",
        F.col("ref").alias("shipment_id"),
        "carrier", "event_type", "planned_ts", "actual_ts",
        F.nullif(F.col("origin"), F.lit("")).alias("origin"),
        F.nullif(F.col("dest"), F.lit("")).alias("dest"),
        F.nullif(F.col("vessel_mmsi"), F.lit("")).alias("vessel_mmsi"),
        "ms_idx",
        "_ingest",
    )


def silver_with_last_mile(deduped: DataFrame) -> DataFrame:
    """Silver columns plus the raw last-mile fields, so one per-shipment
    aggregate can pick both the milestones and the latest last-mile row."""
    return deduped.select(
        "event_id", F.col("ref").alias("shipment_id"), "carrier", "event_type", "planned_ts", "actual_ts",
        F.nullif(F.col("origin"), F.lit("")).alias("origin"),
        F.nullif(F.col("dest"), F.lit("")).alias("dest"),
        F.nullif(F.col("vessel_mmsi"), F.lit("")).alias("vessel_mmsi"),
        "ms_idx", "_ingest", "delivery_address", "eway_bill_no", "eway_ts")


def last_mile(deduped: DataFrame) -> DataFrame:
    """last_mile rows for de-duplicated events with a delivery address.

    A bad e-way time gives NULL ``eway_valid_until``; the row is kept."""
    return deduped.where(F.length(F.col("delivery_address")) > 0).select(
        F.col("ref").alias("shipment_id"),
        F.col("delivery_address").alias("address_raw"),
        pincode(F.col("delivery_address")).alias("pincode"),
        "eway_bill_no",
        F.col("eway_ts").alias("eway_valid_until"),
        "_ingest",
    )


def run_counters(classified: DataFrame) -> DataFrame:
    """One-row counters: read, processed, duplicates, quarantined by reason.

    ``processed`` is the number of distinct event ids among valid rows; it is
    taken with an exact distinct count in the same aggregate."""
    r = F.col("reason")
    valid = F.count_if(r.isNull())
    distinct = F.count_distinct(F.when(r.isNull(), F.col("event_id")))
    aggs = [
        F.count(F.lit(1)).alias("events_read"),
        distinct.alias("events_processed"),
        (valid - distinct).alias("duplicates"),
        F.count_if(r.isNotNull()).alias("quarantined_total"),
    ] + [F.count_if(r == name).alias(f"quarantined_{name}") for name in config.QUARANTINE_REASONS]
    return classified.agg(*aggs)
