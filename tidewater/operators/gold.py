"""Gold tables: facts, dimensions and marts.

Dimensions (carriers, locations, configured vessels) are config-sized and
broadcast.  The scorecard's three group-bys on (carrier, lane, shipment) are
folded into one conditional aggregate, then rolled up per (carrier, lane):
two aggregations, and the second one's input is one row per shipment.

Rounded outputs are computed on exact integers (minutes, tenths) so that every
engine lands on the same digit at a ``.x5`` tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions.text import lane
from tidewater.functions.timefmt import minute_diff


def round_ratio(num: Column, den: Column, scale: int) -> Column:
    """``round(num / den, scale)`` half away from zero, exact for integer inputs."""
    f = 10 ** scale
    n = num.cast("bigint")
    d = den.cast("bigint")
    return F.signum(n) * F.floor((F.abs(n) * 2 * f + d) / (d * 2)) / float(f)


def fct_shipment_events(silver: DataFrame) -> DataFrame:
    """Silver events + carrier name, delay in hours (minute boundaries / 60),
    origin/destination names and lane."""
    spark = silver.sparkSession
    carriers = F.broadcast(config.carriers_df(spark).select(
        F.col("carrier_code").alias("carrier"), "carrier_name"))
    origins = F.broadcast(config.locations_df(spark).select(
        F.col("unlocode").alias("origin"), F.col("port_name").alias("origin_name")))
    dests = F.broadcast(config.locations_df(spark).select(
        F.col("unlocode").alias("dest"), F.col("port_name").alias("dest_name")))
    e = silver.withColumn("delay_min", minute_diff(F.col("actual_ts"), F.col("planned_ts")))
    return (e.join(carriers, "carrier", "left").join(origins, "origin", "left")
            .join(dests, "dest", "left")
            .select("event_id", "shipment_id", "carrier", "carrier_name", "event_type",
                    "planned_ts", "actual_ts", (F.col("delay_min") / 60.0).alias("delay_hours"),
                    "delay_min", "origin", "origin_name", "dest", "dest_name",
                    lane(F.col("origin"), F.col("dest")).alias("lane"), "vessel_mmsi"))


def dim_vessel(observed: DataFrame) -> DataFrame:
    """Gold vessel dimension: configured fleet FULL OUTER observed statics.

    With a config-sized side the full outer join is written as (observed LEFT
    JOIN broadcast config) UNION (configured vessels never observed): the
    second part comes from a semi-join against the broadcast config (at most
    len(VESSELS) rows), so the observed table is never shuffled.  Both sides
    are unique per MMSI."""
    spark = observed.sparkSession
    conf = config.vessels_df(spark).select(F.col("mmsi").alias("c_mmsi"), F.col("name").alias("c_name"))
    o = observed.select(F.col("mmsi").alias("o_mmsi"), "imo", F.col("name").alias("o_name"),
                        "type", "observed_at")
    seen = o.join(F.broadcast(conf), F.col("o_mmsi") == F.col("c_mmsi"), "left")
    present = o.select(F.col("o_mmsi").alias("c_mmsi")).join(F.broadcast(conf.select("c_mmsi")), "c_mmsi",
                                                               "left_semi")
    unseen = conf.join(present, "c_mmsi", "left_anti").select(
        F.lit(None).cast("string").alias("o_mmsi"), F.lit(None).cast("string").alias("imo"),
        F.lit(None).cast("string").alias("o_name"), F.lit(None).cast("string").alias("type"),
        F.lit(None).cast("timestamp").alias("observed_at"), "c_mmsi", "c_name")
    j = seen.unionByName(unseen)
    return j.select(F.coalesce("o_mmsi", "c_mmsi").alias("mmsi"), "imo",
                    F.coalesce(F.nullif(F.col("o_name"), F.lit("")), F.col("c_name")).alias("vessel_name"),
                    F.col("type").alias("ship_type"), "observed_at")


def fct_shipment_legs(legs: DataFrame, vessels: DataFrame) -> DataFrame:
    v = vessels.select(F.col("mmsi").alias("vessel_mmsi"), "vessel_name")
    return legs.join(v, "vessel_mmsi", "left").select(
        "shipment_id", "leg_seq", "mode", "vessel_mmsi", "vessel_name", "origin", "dest",
        lane(F.col("origin"), F.col("dest")).alias("lane"))


def carrier_scorecard(fct: DataFrame, exceptions: DataFrame) -> DataFrame:
    """carrier, lane, shipments, on_time_pct, mis_scan_rate, avg_customs_dwell_h.

    Per (carrier, lane, shipment): on-time flag of delivered rows (max of
    delay <= 24 h), and customs dwell (minutes from the latest arrival to the
    latest release, only when both exist).  A NULL lane never matches in those
    per-shipment lookups, as with ``=`` joins.  Dark = a MISSED_MILESTONE
    exception exists for the shipment id."""
    et = F.col("event_type")
    per = fct.groupBy("carrier", "lane", "shipment_id").agg(
        F.max(F.when(et == "delivered", F.when(F.col("delay_hours") <= 24, 1).otherwise(0)))
        .alias("on_time"),
        F.max(F.when(et == "vessel_arrived", F.col("actual_ts"))).alias("arr"),
        F.max(F.when(et == "customs_release", F.col("actual_ts"))).alias("rel"),
    )
    dark = exceptions.where(F.col("exception_type") == "MISSED_MILESTONE") \
        .select("shipment_id", F.lit(1).alias("dark"))
    per = per.join(dark, "shipment_id", "left")
    lane_ok = F.col("lane").isNotNull()
    customs_min = F.when(lane_ok & F.col("arr").isNotNull() & F.col("rel").isNotNull(),
                         minute_diff(F.col("rel"), F.col("arr")))
    per = per.select("carrier", "lane", "shipment_id",
                     F.when(lane_ok, F.col("on_time")).alias("on_time"),
                     F.coalesce(F.col("dark"), F.lit(0)).alias("dark"),
                     customs_min.alias("customs_min"))
    # ``per`` has one row per (carrier, lane, shipment): the distinct count of
    # shipments is a plain count, no distinct aggregation needed.
    g = per.groupBy("carrier", "lane").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("on_time").alias("on_time_sum"), F.count("on_time").alias("on_time_n"),
        F.sum("dark").alias("dark_sum"), F.count(F.lit(1)).alias("rows"),
        F.sum("customs_min").alias("customs_sum"), F.count("customs_min").alias("customs_n"),
    )
    return g.select(
        "carrier", "lane", "shipments",
        F.when(F.col("on_time_n") > 0, round_ratio(F.col("on_time_sum") * 100, F.col("on_time_n"), 1))
        .alias("on_time_pct"),
        round_ratio(F.col("dark_sum") * 100, F.col("rows"), 1).alias("mis_scan_rate"),
        F.when(F.col("customs_n") > 0, round_ratio(F.col("customs_sum"), F.col("customs_n") * 60, 1))
        .alias("avg_customs_dwell_h"),
    )


def eta_baseline(fct: DataFrame) -> DataFrame:
    """carrier, lane, event_type, observations, median_offset_h (2 dp).

    The median is taken over whole minutes, so it is exact (an integer or a
    half); the hour value is rounded from that exact number."""
    g = fct.groupBy("carrier", "lane", "event_type").agg(
        F.count(F.lit(1)).alias("observations"),
        F.median(F.col("delay_min").cast("double")).alias("_med_min"))
    twice = F.round(F.col("_med_min") * 2).cast("bigint")  # exact: median of integers
    return g.select("carrier", "lane", "event_type", "observations",
                    round_ratio(twice, F.lit(120), 2).alias("median_offset_h"))


def exception_mart(queue: DataFrame) -> DataFrame:
    """exception_type, probable_cause, carrier, open_exceptions, avg_age_h,
    max_age_h, band2_escalations (age >= 96 h)."""
    tenths = F.round(F.col("age_hours") * 10).cast("bigint")
    g = queue.groupBy("exception_type", "probable_cause", "carrier").agg(
        F.count(F.lit(1)).alias("open_exceptions"),
        F.sum(tenths).alias("_t"),
        F.max("age_hours").alias("max_age_h"),
        F.count_if(F.col("age_hours") >= config.BANDS_H[1]).alias("band2_escalations"),
    )
    return g.select("exception_type", "probable_cause", "carrier", "open_exceptions",
                    (F.col("_t") / F.col("open_exceptions") / 10.0).alias("avg_age_h"),
                    "max_age_h", "band2_escalations")
