"""Fixed domain values and small dimension tables.

Everything in the block marked FIXED VALUES must stay equal to the behaviour
this library reproduces (milestone vocabulary, thresholds, carrier formats,
port and anchorage geometry, metric vocabulary).  The rest of the module turns
those values into tiny DataFrames that are broadcast to every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# Raw carrier status wording -> canonical milestone, in milestone order.
STATUS_MAP = {
    "BOOKING CONFIRMED": "booking_confirmed",
    "GATE-IN FULL": "gate_in",
    "LOAD ON VESSEL": "loaded_on_vessel",
    "VESSEL DEPARTURE": "vessel_departed",
    "VESSEL ARRIVAL": "vessel_arrived",
    "CUSTOMS RELEASE": "customs_release",
    "OUT FOR DELIVERY": "out_for_delivery",
    "DELIVERED": "delivered",
}
MILESTONES = list(STATUS_MAP.values())

# Longest normal silence (hours) after each milestone; delivered is terminal.
MAX_GAP_H = {
    "booking_confirmed": 60,
    "gate_in": 36,
    "loaded_on_vessel": 24,
    "vessel_departed": 384,
    "vessel_arrived": 72,
    "customs_release": 48,
    "out_for_delivery": 36,
    "delivered": None,
}

LATE_DEPARTURE_H = 24
CUSTOMS_DWELL_H = 48
VESSEL_STALLED_H = 72
CONGESTED_VESSELS_MIN = 5
WEATHER_WIND_KMH = 60.0
SOG_ANCHOR_KN = 0.5

# Alert severity bands (hours, inclusive lower edge) and ops spike threshold.
BANDS_H = (48, 96)
QUARANTINE_SPIKE_PCT = 5.0

# ETA live adjustments (hours).
STALL_ADJ_H = 24.0
CONGESTION_ADJ_H = 12.0
ETA_DEPARTURE_DELAY_MIN_H = 1.0

# Feed freshness targets (seconds).
SLO_NORMALIZE_FRESHNESS_S = 4500
SLO_AIS_STALENESS_S = 600
FEED_SILENCE_MAX_H = 3.0

# Carriers: code, name, reference pattern, wire timestamp format.
CARRIERS = [
    ("MAEU", "Maersk", "^MAEU[0-9]{9}$", "iso8601"),
    ("MSCU", "MSC", "^MSCU[0-9]{7}$", "epoch_ms"),
    ("CMDU", "CMA CGM", "^CMDU[A-Z]{2}[0-9]{7}$", "iso8601"),
    ("HLCU", "Hapag-Lloyd", "^HLCU[0-9]{3}[A-Z][0-9]{6}$", "eu_slash"),
    ("ONEY", "Ocean Network Express", "^ONEY[A-Z0-9]{10}$", "iso8601"),
]

# Ports: UN/LOCODE, name, country, lat, lon.
PORTS = [
    ("USLAX", "Los Angeles", "US", 33.73, -118.26),
    ("USLGB", "Long Beach", "US", 33.75, -118.19),
    ("SGSIN", "Singapore", "SG", 1.26, 103.84),
    ("INNSA", "JNPT Nhava Sheva", "IN", 18.95, 72.95),
    ("INMUN", "Mundra", "IN", 22.75, 69.70),
    ("CNSHA", "Shanghai", "CN", 31.23, 121.49),
    ("NLRTM", "Rotterdam", "NL", 51.95, 4.14),
    ("DEHAM", "Hamburg", "DE", 53.54, 9.97),
]

# AIS anchorage boxes in config order: name, ports, (lat0, lon0), (lat1, lon1).
AIS_BOXES = [
    ("la_long_beach", ("USLAX", "USLGB"), (33.53, -118.43), (33.79, -118.05)),
    ("singapore_strait", ("SGSIN",), (1.03, 103.55), (1.35, 104.10)),
    ("india_west", ("INNSA", "INMUN"), (18.70, 69.50), (23.00, 73.10)),
]

# Configured fleet: mmsi, name.
VESSELS = [
    ("353136000", "EVER GIVEN"),
    ("636092932", "MSC GULSUN"),
    ("228403000", "CMA CGM MARCO POLO"),
    ("440334000", "HMM ALGECIRAS"),
    ("219018271", "MAERSK MC-KINNEY MOLLER"),
    ("563099500", "ONE APUS"),
    ("477333400", "OOCL HONG KONG"),
    ("218780000", "HAPAG BERLIN EXPRESS"),
]

# Address confusables rewritten before PIN extraction, and the PIN pattern
# (first digit 1-8, optional space/dash between the two halves).
PIN_CONFUSABLES_FROM = "OoIlSB"
PIN_CONFUSABLES_TO = "001158"
PIN_PATTERN = r"(?<![0-9])([1-8][0-9]{2})\s*[- ]?\s*([0-9]{3})(?![0-9])"

# Governed metrics: name -> (mart, column, agg, weight column, unit, synonyms).
METRICS = {
    "on_time_pct": ("carrier_scorecard", "on_time_pct", "weighted_avg", "shipments", "%",
                    ["on time", "on-time", "otp", "on time percentage", "delivery performance"]),
    "mis_scan_rate": ("carrier_scorecard", "mis_scan_rate", "weighted_avg", "shipments", "%",
                      ["mis-scan", "misscan", "missed scan", "gone dark", "dark shipments"]),
    "avg_customs_dwell": ("carrier_scorecard", "avg_customs_dwell_h", "avg", None, "h",
                          ["customs dwell", "customs time", "customs delay", "customs clearance time"]),
    "shipments": ("carrier_scorecard", "shipments", "sum", None, "",
                  ["shipment count", "volume", "how many shipments", "number of shipments"]),
    "eta_offset": ("eta_baseline", "median_offset_h", "median_of_medians", None, "h",
                   ["eta offset", "schedule offset", "planned vs actual", "delay baseline", "typical delay"]),
}
# What an answer cites as the meaning of its metric (fixed values).
METRIC_DEFINITIONS = {
    "on_time_pct": "Percent of delivered shipments arriving within 24h of plan.",
    "mis_scan_rate": "Percent of shipments that went silent (MISSED_MILESTONE).",
    "avg_customs_dwell": "Average hours from vessel arrival to customs release.",
    "shipments": "Count of shipments observed.",
    "eta_offset": "Median planned-vs-actual offset per lane/carrier/milestone.",
}
LOWER_IS_BETTER = ("mis_scan_rate", "avg_customs_dwell", "eta_offset")
SUPERLATIVE_BEST = ("best", "highest", "top", "most")
SUPERLATIVE_WORST = ("worst", "lowest", "bottom", "least")

# Question phrases for the two filter dimensions.
DIMENSION_PHRASES = {
    "carrier": {"maersk": "MAEU", "msc": "MSCU", "cma": "CMDU", "cma cgm": "CMDU",
                "hapag": "HLCU", "hapag-lloyd": "HLCU", "one": "ONEY", "ocean network": "ONEY"},
    "port": {"los angeles": "USLAX", "la": "USLAX", "long beach": "USLGB", "singapore": "SGSIN",
             "jnpt": "INNSA", "nhava sheva": "INNSA", "mundra": "INMUN", "shanghai": "CNSHA",
             "rotterdam": "NLRTM", "hamburg": "DEHAM"},
}

# Accepted values used by the data-quality checks.
EXCEPTION_TYPES = ["MISSED_MILESTONE", "LATE_DEPARTURE", "CUSTOMS_DWELL",
                   "VESSEL_STALLED", "EWAY_BILL_EXPIRED"]
PROBABLE_CAUSES = ["weather", "congestion", "disruption", "unknown"]
QUARANTINE_REASONS = ["malformed_record", "unmapped_ref", "unknown_status", "unparseable_time"]

# ---------------------------------------------------------------------------
# Derived helpers
# ---------------------------------------------------------------------------

MILESTONE_INDEX = {m: i + 1 for i, m in enumerate(MILESTONES)}  # 1-based
PORT_CODES = [p[0] for p in PORTS]


def carriers_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("carrier_code", T.StringType(), False),
        T.StructField("carrier_name", T.StringType(), False),
        T.StructField("ref_pattern", T.StringType(), False),
        T.StructField("ts_format", T.StringType(), False),
    ])
    return spark.createDataFrame(CARRIERS, schema)


def locations_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("unlocode", T.StringType(), False),
        T.StructField("port_name", T.StringType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lon", T.DoubleType(), False),
    ])
    return spark.createDataFrame(PORTS, schema)


def boxes_df(spark: SparkSession) -> DataFrame:
    """One row per box with its config order ``ord`` (first box wins on overlap)."""
    rows = [(name, i, lo[0], lo[1], hi[0], hi[1]) for i, (name, _, lo, hi) in enumerate(AIS_BOXES)]
    schema = T.StructType([
        T.StructField("box", T.StringType(), False),
        T.StructField("ord", T.IntegerType(), False),
        T.StructField("lat0", T.DoubleType(), False),
        T.StructField("lon0", T.DoubleType(), False),
        T.StructField("lat1", T.DoubleType(), False),
        T.StructField("lon1", T.DoubleType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def port_boxes_df(spark: SparkSession) -> DataFrame:
    """Every configured port with the anchorage box it belongs to (NULL if none)."""
    box_of_port = {port: name for name, ports, _, _ in AIS_BOXES for port in ports}
    schema = T.StructType([
        T.StructField("port", T.StringType(), False),
        T.StructField("box", T.StringType(), True),
    ])
    return spark.createDataFrame([(p, box_of_port.get(p)) for p in PORT_CODES], schema)


def vessels_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("mmsi", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
    ])
    return spark.createDataFrame(VESSELS, schema)
