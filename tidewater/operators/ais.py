"""AIS operators: anchorage box, anchor-hours, congestion, vessel dimension.

The box test is a projection (a CASE chain over the configured boxes in config
order, first box wins), not a join: with a handful of boxes that is cheaper
than any join and needs no shuffle.  Anchor-hours are distinct
(vessel, box, hour) triples counted per (date, vessel, box); both aggregates
combine map-side, so a vessel that sends a third of all messages is reduced
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import config

DWELL_COLUMNS = ["mmsi", "date", "box", "anchor_hours"]
CONGESTION_COLUMNS = ["port", "date", "vessels_at_anchor", "avg_dwell_h"]
VESSEL_COLUMNS = ["mmsi", "imo", "name", "type", "observed_at"]


def box_of(lat: Column, lon: Column) -> Column:
    """Name of the first configured box containing the point (edges inclusive)."""
    out = None
    for name, _, (lat0, lon0), (lat1, lon1) in config.AIS_BOXES:
        cond = lat.between(lat0, lat1) & lon.between(lon0, lon1)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def anchored_positions(positions: DataFrame) -> DataFrame:
    """Position reports of vessels at anchor inside a box: ``mmsi, box,
    received_at, date, hour``.  Rows without MMSI are dropped (never merged)."""
    p = positions.where(F.col("message_type") == "PositionReport") if "message_type" in positions.columns \
        else positions
    p = p.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("sog").isNotNull()
                & (F.col("sog") < config.SOG_ANCHOR_KN)
                & F.col("mmsi").isNotNull() & (F.col("mmsi") != ""))
    return p.select("mmsi", box_of(F.col("lat"), F.col("lon")).alias("box"), "received_at") \
        .where(F.col("box").isNotNull()) \
        .select("mmsi", "box", "received_at",
                F.to_date("received_at").alias("date"),
                F.date_trunc("hour", "received_at").alias("hour"))


def vessel_dwell(positions: DataFrame) -> DataFrame:
    """vessel_dwell: ``mmsi, date, box, anchor_hours`` (distinct hours)."""
    hours = anchored_positions(positions).select("date", "mmsi", "box", "hour").distinct()
    return hours.groupBy("date", "mmsi", "box").agg(
        F.count(F.lit(1)).alias("anchor_hours")).select(*DWELL_COLUMNS)


def _avg_1dp(total: Column, n: Column) -> Column:
    """Exact ``round(total / n, 1)`` half-up for non-negative integer totals."""
    return F.floor((total * 20 + n) / (n * 2)) / 10.0


def port_congestion(dwell: DataFrame) -> DataFrame:
    """port_congestion per (date, box): vessels at anchor and their average
    anchor-hours; boxes without vessels have no row.  ``port`` holds the box."""
    g = dwell.groupBy("date", "box").agg(
        F.count(F.lit(1)).alias("n"), F.sum("anchor_hours").alias("total"))
    return g.select(F.col("box").alias("port"), "date",
                    F.col("n").alias("vessels_at_anchor"),
                    _avg_1dp(F.col("total"), F.col("n")).alias("avg_dwell_h"))


def box_counts(dwell: DataFrame) -> DataFrame:
    """Vessels per configured box and date including boxes with none (run summary)."""
    names = [b[0] for b in config.AIS_BOXES]
    per_date = dwell.groupBy("date").agg(
        *[F.count_if(F.col("box") == name).alias(f"_b{i}") for i, name in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(name).alias("box"), F.lit(i).alias("ord"),
                              F.col(f"_b{i}").alias("vessels")) for i, name in enumerate(names)])
    return per_date.select("date", F.inline(rows))


def dwell_totals(dwell: DataFrame) -> DataFrame:
    """All-time anchor-hours per vessel, every date and box."""
    return dwell.groupBy("mmsi").agg(F.sum("anchor_hours").cast("double").alias("anchor_hours"))


def latest_by(df: DataFrame, key: str, order: str = "date") -> DataFrame:
    """Latest row per ``key`` by ``order`` (ties go to the larger remaining struct)."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), F.when(F.col(order).isNotNull(), F.struct(order, *cols))).alias("r")) \
        .select(key, "r.*")


def vessel_static(static: DataFrame, order_col: str = "_ingest") -> DataFrame:
    """dim_vessel (silver): last report per MMSI on ``received_at``; on a tie
    the earlier report in ingest order stays (``order_col`` is a number).
    Names are trimmed."""
    key = F.struct(F.col("received_at"), (-F.col(order_col)).alias("o"))
    s = static.where(F.col("mmsi").isNotNull() & (F.col("mmsi") != ""))
    return s.groupBy("mmsi").agg(F.max_by(F.struct(
        F.col("imo").cast("string").alias("imo"),
        F.trim(F.col("name")).alias("name"),
        F.col("type").cast("string").alias("type"),
        F.col("received_at").alias("observed_at")), key).alias("v")).select("mmsi", "v.*")


def run_summary(positions: DataFrame, statics: DataFrame) -> DataFrame:
    """One row per AIS run: position and static report counts, anchored
    reports inside a box, reports without MMSI (dropped, never merged) and
    vessels at anchor."""
    anchored = anchored_positions(positions)
    pos = positions.agg(F.count(F.lit(1)).alias("position_reports"),
                        F.count_if(F.col("mmsi").isNull() | (F.col("mmsi") == "")).alias("missing_mmsi"))
    anc = anchored.agg(F.count(F.lit(1)).alias("anchored_reports"),
                       F.count_distinct("mmsi").alias("vessels_at_anchor"))
    sta = statics.agg(F.count(F.lit(1)).alias("static_reports"))
    # three one-row aggregates side by side
    return pos.withColumn("_k", F.lit(1)).join(anc.withColumn("_k", F.lit(1)), "_k") \
        .join(sta.withColumn("_k", F.lit(1)), "_k").drop("_k")
