"""Per-shipment state in one aggregate.

Every ordered pick the rules, legs and ETA need (last row per milestone, the
last milestone, the first row, the first vessel row, the chronologically last
destination) is the ``min``/``max`` of one struct, its ordering fields first,
inside a single ``groupBy``: one shuffle, partial aggregation before it, so a
shipment with millions of rows is reduced map-side.  Each pick is one value of
the buffer (``max_by`` keeps two, with the ordering fields in both).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Milestones whose last row is kept as its own struct column.
PIVOT_MILESTONES = ("vessel_departed", "vessel_arrived", "customs_release", "delivered")


_MS = ("ms_idx", "actual_ts", "event_id")
_CHRONO = ("actual_ts", "event_id")


def _ranked(order, *cols):
    """The ordering fields, then the others that are kept."""
    return F.struct(*order, *[c for c in cols if c not in order])


def _row(name: str, *cols):
    """The kept fields of a pick; NULL when no row was eligible."""
    return F.when(F.col(name).isNotNull(), F.struct(*[F.col(f"{name}.{c}").alias(c) for c in cols])).alias(name)


def shipment_state(silver: DataFrame) -> DataFrame:
    """One row per shipment.

    Columns: ``shipment_id, n_events``; ``last`` (highest milestone, then
    latest: type, carrier, times, origin, dest); ``first_planned_ts`` (lowest
    milestone, then earliest); ``latest_dest`` (chronologically last row);
    ``first_vessel`` (earliest row with a vessel: mmsi, origin, dest);
    ``first_departed_planned_ts``; and per pivot milestone ``<m>`` its latest
    row (times and vessel).  Each pick carries only the fields used later, to
    keep the aggregation buffer narrow.
    """
    last = ("event_type", "ms_idx", "carrier", "planned_ts", "actual_ts", "origin", "dest")
    vessel = ("vessel_mmsi", "origin", "dest")
    milestone = ("planned_ts", "actual_ts", "vessel_mmsi")
    of_type = lambda m: F.col("event_type") == m
    aggs = [
        F.count(F.lit(1)).alias("n_events"),
        F.max(_ranked(_MS, *last)).alias("last"),
        F.min(_ranked(_MS, "planned_ts")).alias("first_planned_ts"),
        F.max(_ranked(_CHRONO, "dest")).alias("latest_dest"),
        F.min(F.when(F.col("vessel_mmsi").isNotNull(), _ranked(_CHRONO, *vessel))).alias("first_vessel"),
        F.min(F.when(of_type("vessel_departed"), _ranked(_CHRONO, "planned_ts"))).alias("first_departed_planned_ts"),
    ] + [F.max(F.when(of_type(m), _ranked(_CHRONO, *milestone))).alias(m) for m in PIVOT_MILESTONES]
    out = ["shipment_id", "n_events", _row("last", *last),
           F.col("first_planned_ts.planned_ts").alias("first_planned_ts"),
           F.col("latest_dest.dest").alias("latest_dest"), _row("first_vessel", *vessel),
           F.col("first_departed_planned_ts.planned_ts").alias("first_departed_planned_ts"),
           *[_row(m, *milestone) for m in PIVOT_MILESTONES]]
    if "delivery_address" in silver.columns:
        # J3 in the same aggregate: the last last-mile row in ingest order.
        has = (F.length(F.col("delivery_address")) > 0) & F.col("_ingest").isNotNull()
        aggs.append(F.max(F.when(has, F.struct("_ingest", "eway_bill_no", F.col("eway_ts").alias("eway_valid_until"))))
                    .alias("last_mile"))
        out.append(_row("last_mile", "eway_bill_no", "eway_valid_until"))
    # The rows are sorted by the hash first: references begin alike (carrier code, zeros), and such text is slow to sort.
    return silver.groupBy(F.xxhash64("shipment_id").alias("_key"), "shipment_id").agg(*aggs).select(*out)


def shipment_legs(state: DataFrame) -> DataFrame:
    """One ocean leg per shipment with a vessel: the first such row."""
    return state.where(F.col("first_vessel").isNotNull()).select(
        "shipment_id",
        F.lit(1).alias("leg_seq"),
        F.lit("ocean").alias("mode"),
        F.col("first_vessel.vessel_mmsi").alias("vessel_mmsi"),
        F.col("first_vessel.origin").alias("origin"),
        F.col("first_vessel.dest").alias("dest"),
    )


def latest_last_mile(lastmile: DataFrame, order_col: str = "_ingest") -> DataFrame:
    """The last last-mile row per shipment in ingest order (later arrival wins)."""
    cols = [c for c in lastmile.columns if c not in ("shipment_id", order_col)]
    return lastmile.groupBy("shipment_id").agg(
        F.max_by(F.struct(*cols), F.col(order_col)).alias("lm")).select("shipment_id", "lm.*")
