"""Raw feeds derived from the benchmark tables.

``carrier_feed`` turns ``lineitem`` joined to ``orders`` into raw carrier
tracking rows (all text, per-carrier wire formats, planted bad rows), so the
pipeline runs on data that grows with the tables.  ``ais_positions`` turns
``events`` into AIS position reports, ``supplier_conditions`` turns
``supplier`` into daily weather/news observations per port.

The recipe is written as column expressions only: the join is an equi-join on
the order key (both sides shuffled on it, or a bucketed pair), everything else
is a per-row projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import config
from tidewater.functions.timefmt import format_wire_ts

# FIXED VALUES of the derived feed recipe.
FEED_CARRIERS = ["MAEU", "MSCU", "CMDU", "HLCU", "ONEY"]          # by order key % 5
FEED_REF_PREFIX = {"MAEU": ("MAEU", 9), "MSCU": ("MSCU", 7), "CMDU": ("CMDUAB", 7),
                   "HLCU": ("HLCU123A", 6), "ONEY": ("ONEY", 10)}
FEED_PLANNED_OFFSET_H = [0, 48, 72, 84, 420, 456, 480, 492]       # by milestone index - 1
FEED_PORTS = ["USLAX", "USLGB", "SGSIN", "INNSA", "INMUN", "CNSHA", "NLRTM", "DEHAM"]
FEED_EWAY_VALID_H = [24, 72, 168]                                  # by part key % 3
FEED_VESSEL_MILESTONES = [3, 4, 5]
DEFAULT_ASOF = "1998-07-01T00:00:00Z"
AIS_POINTS = [(33.70, -118.20), (1.20, 103.80), (19.00, 72.00), (0.0, 0.0)]  # by event_id % 4
N_VESSELS = 75


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def carrier_feed(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Raw carrier rows, one per line item: ``event_id, carrier, ref, status, timestamp, planned,
    origin, dest, vessel_mmsi, delivery_address, eway_bill_no,
    eway_valid_until`` (text) plus ``date`` (bronze partition) and ``_ingest``
    (a struct that totally orders the rows like file order would)."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    # Two fact-sized tables: a sort-merge join on the order key (both sides
    # shuffled, spills under memory pressure).  The per-row feed expressions
    # then run in the post-shuffle stage, spread over all partitions even when
    # the scan itself is a single split.
    j = li.join(od.hint("merge"), "l_orderkey")

    ms = F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.lit(8)) \
          .otherwise(F.col("l_linenumber"))
    k = (F.col("l_orderkey") % 5).cast("int")          # carrier number
    okey = F.col("l_orderkey").cast("string")
    fmts = dict((c, fmt) for c, _, _, fmt in config.CARRIERS)
    cust = F.col("o_custkey")
    planned_s = (F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
                 + _pick(FEED_PLANNED_OFFSET_H, F.col("ms") - 1) * 3600)
    actual_s = (F.col("planned_s") + F.round(F.col("l_quantity") * 3600).cast("bigint")
                + (F.col("l_suppkey") % 60) * 60 - 7200)

    base = (
        j.withColumn("ms", ms)
        .withColumn("planned_s", planned_s)
        .withColumn("actual_s", actual_s)
        .withColumn("k", k)
    )
    base = base.select(
        "*",
        _pick(FEED_CARRIERS, F.col("k")).alias("carrier"),
        F.concat(_pick([FEED_REF_PREFIX[c][0] for c in FEED_CARRIERS], F.col("k")),
                 F.lpad(okey, _pick([FEED_REF_PREFIX[c][1] for c in FEED_CARRIERS], F.col("k")), "0"))
        .alias("clean_ref"),
        _pick([fmts[c] for c in FEED_CARRIERS], F.col("k")).alias("ts_format"),
    )

    pk = F.col("l_partkey")
    status_words = list(config.STATUS_MAP.keys())
    dest_idx = (cust % 8 + 1 + F.floor(cust / 8) % 7) % 8
    pin = (F.lit(110000) + (F.col("l_orderkey") * 37 + pk) % 780000).cast("string")
    styled_pin = (
        F.when(pk % 5 == 0, pin)
        .when(pk % 5 == 1, F.concat(F.substring(pin, 1, 3), F.lit(" "), F.substring(pin, 4, 3)))
        .when(pk % 5 == 2, F.concat(F.lit("PIN-"), pin))
        .when(pk % 5 == 3, F.concat(F.substring(pin, 1, 3), F.lit("-"), F.substring(pin, 4, 3)))
        .otherwise(F.translate(pin, "0", "O"))
    )
    base = base.withColumn("dest", _pick(FEED_PORTS, dest_idx)).withColumn(
        "has_address", (F.col("ms") == 7) & F.col("dest").isin("INNSA", "INMUN"))
    dest = F.col("dest")
    has_address = F.col("has_address")
    address = F.when(has_address, F.concat(
        F.lit("Unit "), F.col("l_linenumber").cast("string"), F.lit(", Dock Road "),
        (F.col("l_suppkey") % 90 + 10).cast("string"), F.lit(", "),
        F.when(dest == "INNSA", F.lit("Navi Mumbai")).otherwise(F.lit("Kutch")),
        F.when(pk % 20 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), styled_pin))))  # some lack the PIN
    actual_ts = F.timestamp_seconds(F.col("actual_s"))
    planned_ts = F.timestamp_seconds(F.col("planned_s"))
    eway_ts = F.timestamp_seconds(F.col("actual_s") + _pick(FEED_EWAY_VALID_H, pk % 3) * 3600)

    return base.select(
        F.substring(F.sha1(F.concat(F.col("clean_ref"), F.lit("|"), F.col("ms").cast("string"))), 1, 16)
        .alias("event_id"),
        F.col("carrier"),
        F.when(pk % 101 == 0, F.concat(F.lit("XXXX"), F.substring(F.col("clean_ref"), 5, 64)))
        .otherwise(F.col("clean_ref")).alias("ref"),
        F.when(pk % 103 == 0, F.concat(F.lit("STATUS_"), F.col("l_suppkey").cast("string")))
        .otherwise(_pick(status_words, F.col("ms") - 1)).alias("status"),
        F.when(pk % 107 == 0, F.lit("not-a-time"))
        .otherwise(format_wire_ts(actual_ts, F.col("ts_format"))).alias("timestamp"),
        format_wire_ts(planned_ts, F.col("ts_format")).alias("planned"),
        _pick(FEED_PORTS, cust % 8).alias("origin"),
        dest.alias("dest"),
        F.when(F.col("ms").isin(*FEED_VESSEL_MILESTONES), (cust % N_VESSELS).cast("string"))
        .alias("vessel_mmsi"),
        address.alias("delivery_address"),
        F.when(has_address, F.concat(F.lit("EWB"), okey)).alias("eway_bill_no"),
        F.when(has_address, format_wire_ts(eway_ts, F.col("ts_format"))).alias("eway_valid_until"),
        F.to_date(actual_ts).alias("date"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                 "l_quantity", "l_extendedprice").alias("_ingest"),
    )


def ais_positions(events: DataFrame) -> DataFrame:
    """AIS position reports ``mmsi, received_at, lat, lon, sog, message_type``
    plus ``_ingest`` (the event id) from the ``events`` table."""
    k = F.col("event_id") % 4
    lat = F.coalesce(*[F.when(k == i, F.lit(p[0])) for i, p in enumerate(AIS_POINTS)])
    lon = F.coalesce(*[F.when(k == i, F.lit(p[1])) for i, p in enumerate(AIS_POINTS)])
    return events.select(
        (F.col("user_id") % N_VESSELS).cast("string").alias("mmsi"),
        F.col("ts").cast("timestamp").alias("received_at"),
        lat.cast("double").alias("lat"),
        lon.cast("double").alias("lon"),
        (F.col("value") / 100).alias("sog"),
        F.lit("PositionReport").alias("message_type"),
        F.col("event_id").alias("_ingest"),
    )


def ais_static(events: DataFrame) -> DataFrame:
    """Ship static reports from ``signup`` events: ``mmsi, imo, name, type,
    received_at, _ingest``.  Names carry padding that the operator trims."""
    return events.where(F.col("event_type") == "signup").select(
        (F.col("user_id") % N_VESSELS).cast("string").alias("mmsi"),
        (F.lit(9000000) + F.col("user_id")).cast("string").alias("imo"),
        F.concat(F.lit(" VESSEL "), (F.col("user_id") % N_VESSELS).cast("string"),
                 F.lit(" "), F.upper(F.get_json_object("props", "$.k")), F.lit("  ")).alias("name"),
        (F.lit(70) + F.col("event_id") % 10).cast("string").alias("type"),
        F.col("ts").cast("timestamp").alias("received_at"),
        F.col("event_id").alias("_ingest"),
    )


def supplier_conditions(supplier: DataFrame) -> DataFrame:
    """Daily port observations from ``supplier``: ``port, date, weather_alerts,
    weather_code, wind_max_kmh, precip_mm, disruption_news`` (one row per
    supplier; several may land on one port-day)."""
    sk = F.col("s_suppkey")
    return supplier.select(
        _pick(FEED_PORTS, sk % 8).alias("port"),
        F.date_add(F.lit("1998-06-01").cast("date"), (sk % 45).cast("int")).alias("date"),
        F.when(sk % 11 == 0, 1).otherwise(0).cast("bigint").alias("weather_alerts"),
        (sk % 4).cast("string").alias("weather_code"),
        (F.abs(F.col("s_acctbal")) % 100).alias("wind_max_kmh"),
        ((sk % 13) / 2.0).alias("precip_mm"),
        F.when(sk % 13 == 0, 1).otherwise(0).cast("bigint").alias("disruption_news"),
    )
