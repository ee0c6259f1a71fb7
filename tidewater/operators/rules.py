"""Exception rules over shipment state.

All five rules are evaluated in one projection of the per-shipment state: each
rule is a nullable struct, the array of them is filtered and exploded, so the
queue is one pass with no union of separate scans.  Dimension inputs (vessel
anchor totals, last-mile rows, per-port causes) are joined on first; the
per-port cause table is bounded by the configured ports and is broadcast.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions.text import exception_id
from tidewater.functions.timefmt import asof_literal, hours_1dp, hours_text0

EXCEPTION_COLUMNS = ["exception_id", "shipment_id", "carrier", "exception_type",
                     "detected_at", "age_hours", "detail", "probable_cause"]


def _gap_seconds(event_type: Column) -> Column:
    pairs = []
    for name, gap in config.MAX_GAP_H.items():
        if gap is not None:
            pairs += [F.lit(name), F.lit(gap * 3600)]
    return F.try_element_at(F.create_map(*pairs), event_type)


def _since(asof: Column, ts: Column) -> Column:
    return F.unix_seconds(asof) - F.unix_seconds(ts)


def _rule(name: str, fires: Column, age_seconds: Column, detail: Column) -> Column:
    return F.when(fires, F.struct(
        F.lit(name).alias("exception_type"),
        age_seconds.cast("double").alias("age_s"),
        detail.alias("detail"),
    ))


def port_causes(conditions_latest: DataFrame | None, congestion_latest: DataFrame | None,
                spark=None) -> DataFrame:
    """``port, probable_cause`` for every configured port (at most
    ``len(config.PORTS)`` rows, so it is safe to broadcast: the configured
    ports are the left side, and both inputs are unique per port / box).

    Precedence: weather (alerts > 0 or wind >= 60; unreadable wind is calm) ->
    disruption (news > 0) -> congestion (>= 5 vessels at anchor in the port's
    box, latest row) -> unknown."""
    if spark is None:
        src = conditions_latest if conditions_latest is not None else congestion_latest
        spark = src.sparkSession
    ports = config.port_boxes_df(spark)
    cond_cols = [F.lit(None).cast("string").alias(c) for c in
                 ("weather_alerts", "wind_max_kmh", "disruption_news")]
    if conditions_latest is not None:
        # restricted to configured ports, so the broadcast below has at most len(PORTS) rows
        cond = conditions_latest.where(F.col("port").isin(*config.PORT_CODES)).select(
            "port",
            F.col("weather_alerts").cast("string").alias("weather_alerts"),
            F.col("wind_max_kmh").cast("string").alias("wind_max_kmh"),
            F.col("disruption_news").cast("string").alias("disruption_news"))
        ports = ports.join(F.broadcast(cond), "port", "left")
    else:
        ports = ports.select("*", *cond_cols)
    if congestion_latest is not None:
        cong = congestion_latest.select(
            F.col("port").alias("box"), F.col("vessels_at_anchor").alias("vessels"))
        # no hint: adaptive execution broadcasts it after checking its runtime size
        ports = ports.join(cong, "box", "left")
    else:
        ports = ports.withColumn("vessels", F.lit(None).cast("bigint"))

    wind = F.col("wind_max_kmh").try_cast("double")
    windy = F.coalesce((wind >= config.WEATHER_WIND_KMH) & ~F.isnan(wind), F.lit(False))
    alerts = F.coalesce(F.col("weather_alerts").try_cast("double"), F.lit(0.0))
    news = F.coalesce(F.col("disruption_news").try_cast("double"), F.lit(0.0))
    cause = (
        F.when((alerts > 0) | windy, "weather")
        .when(news > 0, "disruption")
        .when(F.coalesce(F.col("vessels"), F.lit(0)) >= config.CONGESTED_VESSELS_MIN, "congestion")
        .otherwise("unknown")
    )
    return ports.select("port", cause.alias("probable_cause"))


def detect_exceptions(state: DataFrame, asof: str | datetime,
                      dwell_totals: DataFrame | None = None,
                      lastmile_latest: DataFrame | None = None,
                      causes: DataFrame | None = None) -> DataFrame:
    """exception_queue rows from ``shipment_state``.

    ``dwell_totals``: ``mmsi, anchor_hours`` (all-time total per vessel).
    ``lastmile_latest``: one row per shipment (``latest_last_mile``); when
    omitted, the state's own ``last_mile`` pick is used if present.
    ``causes``: ``port, probable_cause`` (``port_causes``); missing -> unknown.
    """
    a = asof_literal(asof)
    s = state
    if dwell_totals is not None:
        d = dwell_totals.select(F.col("mmsi").alias("_dep_mmsi"),
                                F.col("anchor_hours").alias("_anchored_h"))
        s = s.join(d, s["vessel_departed.vessel_mmsi"] == d["_dep_mmsi"], "left").drop("_dep_mmsi")
    else:
        s = s.withColumn("_anchored_h", F.lit(None).cast("double"))
    if lastmile_latest is None and "last_mile" in state.columns:
        s = s.select("*", F.col("last_mile.eway_bill_no").alias("_eway_no"),
                     F.col("last_mile.eway_valid_until").alias("_eway_until"),
                     F.col("last_mile").isNotNull().alias("_has_lm"))
    elif lastmile_latest is not None:
        lm = lastmile_latest.select("shipment_id",
                                    F.col("eway_bill_no").alias("_eway_no"),
                                    F.col("eway_valid_until").alias("_eway_until"),
                                    F.lit(True).alias("_has_lm"))
        s = s.join(lm, "shipment_id", "left")
    else:
        s = s.select("*", F.lit(None).cast("string").alias("_eway_no"),
                     F.lit(None).cast("timestamp").alias("_eway_until"),
                     F.lit(None).cast("boolean").alias("_has_lm"))

    last, dep, arr = F.col("last"), F.col("vessel_departed"), F.col("vessel_arrived")
    gap_s = _gap_seconds(last["event_type"])
    silence_s = _since(a, last["actual_ts"])
    late_s = F.unix_seconds(dep["actual_ts"]) - F.unix_seconds(dep["planned_ts"])
    dwell_s = _since(a, arr["actual_ts"])
    anchored = F.coalesce(F.col("_anchored_h").cast("double"), F.lit(0.0))
    mmsi = dep["vessel_mmsi"]
    expired_s = _since(a, F.col("_eway_until"))

    rules = F.array(
        _rule("MISSED_MILESTONE", gap_s.isNotNull() & (silence_s > gap_s), silence_s - gap_s,
              F.concat(F.lit("no event for "), hours_text0(silence_s), F.lit("h after "),
                       last["event_type"], F.lit(" (max normal "), (gap_s / 3600).cast("bigint").cast("string"),
                       F.lit("h)"))),
        _rule("LATE_DEPARTURE", dep.isNotNull() & (late_s > config.LATE_DEPARTURE_H * 3600),
              _since(a, dep["actual_ts"]),
              F.concat(F.lit("departed "), hours_text0(late_s), F.lit("h after plan"))),
        _rule("CUSTOMS_DWELL",
              arr.isNotNull() & F.col("customs_release").isNull()
              & (dwell_s > config.CUSTOMS_DWELL_H * 3600),
              dwell_s - config.CUSTOMS_DWELL_H * 3600,
              F.concat(F.lit("in customs "), hours_text0(dwell_s), F.lit("h with no release"))),
        _rule("VESSEL_STALLED",
              dep.isNotNull() & arr.isNull() & (F.length(mmsi) > 0)
              & (anchored > config.VESSEL_STALLED_H),
              (anchored - config.VESSEL_STALLED_H) * 3600,
              F.concat(F.lit("vessel "), mmsi, F.lit(" at anchor "),
                       F.bround(anchored, 0).cast("bigint").cast("string"), F.lit("h mid-voyage"))),
        _rule("EWAY_BILL_EXPIRED",
              F.coalesce(F.col("_has_lm"), F.lit(False)) & F.col("_eway_until").isNotNull()
              & F.col("delivered").isNull() & (F.col("_eway_until") < a),
              expired_s,
              F.concat(F.lit("e-way bill "), F.coalesce(F.col("_eway_no"), F.lit("")),
                       F.lit(" expired "), hours_text0(expired_s), F.lit("h ago"))),
    )
    if causes is not None:
        c = F.broadcast(causes.select(F.col("port").alias("_dest"), F.col("probable_cause").alias("_cause")))
        s = s.join(c, F.col("latest_dest") == F.col("_dest"), "left")
    else:
        s = s.withColumn("_cause", F.lit(None).cast("string"))
    fired = s.select(
        "shipment_id",
        last["carrier"].alias("carrier"),
        F.coalesce(F.col("_cause"), F.lit("unknown")).alias("probable_cause"),
        F.explode(rules).alias("r"),
    ).where(F.col("r").isNotNull())
    return fired.select(
        exception_id(F.col("shipment_id"), F.col("r.exception_type")).alias("exception_id"),
        "shipment_id", "carrier",
        F.col("r.exception_type").alias("exception_type"),
        a.alias("detected_at"),
        hours_1dp(F.col("r.age_s")).alias("age_hours"),
        F.col("r.detail").alias("detail"),
        "probable_cause",
    )
