"""File sources: carrier ndjson bronze, AIS day files, weather payloads, landing.

Every reader takes an explicit schema (no inference).  Line order inside a
file is kept as an ingest-order key ``(file_path, file_block_start,
monotonically_increasing_id)``: a file split is read by one task in line
order, so the key sorts rows exactly as a sequential reader would see them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.timefmt import ISO_READ

CARRIER_FIELDS = ["event_id", "carrier", "ref", "status", "timestamp", "planned", "origin", "dest",
                  "vessel_mmsi", "delivery_address", "eway_bill_no", "eway_valid_until"]
CARRIER_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in CARRIER_FIELDS])

# AIS messages are parsed once into a typed struct, then cast by position to a
# struct with distinct field names: metadata comes spelled ``MetaData`` or
# ``Metadata`` (and coordinates ``latitude`` or ``Latitude``), which a
# case-insensitive name lookup could not tell apart.  JSON keys themselves are
# matched case-sensitively by the parser.
_META_WIRE = "STRUCT<MMSI: BIGINT, latitude: DOUBLE, longitude: DOUBLE, Latitude: DOUBLE, Longitude: DOUBLE>"
_META_SAFE = "STRUCT<mmsi: BIGINT, lat_lc: DOUBLE, lon_lc: DOUBLE, lat_uc: DOUBLE, lon_uc: DOUBLE>"
AIS_WIRE = (f"STRUCT<MessageType: STRING, MetaData: {_META_WIRE}, Metadata: {_META_WIRE}, "
            "Message: STRUCT<PositionReport: STRUCT<UserID: BIGINT, Latitude: DOUBLE, Longitude: DOUBLE, Sog: DOUBLE>, "
            "ShipStaticData: STRUCT<UserID: BIGINT, ImoNumber: BIGINT, Name: STRING, Type: BIGINT>>, "
            "received_at: STRING>")
AIS_SAFE = (f"STRUCT<mt: STRING, meta_a: {_META_SAFE}, meta_b: {_META_SAFE}, "
            "msg: STRUCT<pos: STRUCT<user_id: BIGINT, lat: DOUBLE, lon: DOUBLE, sog: DOUBLE>, "
            "stat: STRUCT<user_id: BIGINT, imo: BIGINT, name: STRING, type: BIGINT>>, "
            "received_at: STRING>")


def parse_ais(value: Column) -> Column:
    """One JSON parse per AIS message into the ``AIS_SAFE`` struct."""
    return F.from_json(value, AIS_WIRE).cast(AIS_SAFE)


def is_json_object_line(value: Column) -> Column:
    """Exactly one JSON object on the line: parses, nothing trails it, ends in ``}``."""
    # One parse: wrapped in brackets, the line must be a JSON array of exactly
    # one element (nothing trailing, not two values), and start/end with braces.
    trimmed = F.trim(value)
    one = F.size(F.try_parse_json(F.concat(F.lit("["), value, F.lit("]"))).try_cast("array<variant>")) == 1
    return F.coalesce(one & trimmed.startswith("{") & trimmed.endswith("}"), F.lit(False))


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("_ingest"))


def read_carrier_bronze(spark: SparkSession, root: str) -> DataFrame:
    """All ``<root>/<date>/*.ndjson`` lines as raw carrier rows plus ``date``,
    ``_malformed`` (not exactly one JSON object) and ``_ingest``."""
    lines = _lines(spark, f"{root.rstrip('/')}/*/*.ndjson")
    parsed = F.from_json(F.col("value"), CARRIER_SCHEMA)
    return lines.select(
        parsed.alias("j"), "value", "_ingest",
        F.regexp_extract("file_path", r"/([^/]+)/[^/]+$", 1).alias("date"),
        (~is_json_object_line(F.col("value"))).alias("_malformed"),
    ).select(*[F.col(f"j.{f}").alias(f) for f in CARRIER_FIELDS], "date", "value", "_malformed", "_ingest")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _any_file(spark: SparkSession, pattern: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found)


def _empty_files(spark: SparkSession, landing: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{landing.rstrip('/')}/*.ndjson")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    return [f.getPath().toString() for f in found if f.isFile() and not f.getLen()]


def read_ais_day(spark: SparkSession, root: str, date: str) -> DataFrame:
    """One receipt date of AIS messages (``<root>/<date>/*.ndjson``) as ``m``
    (``AIS_SAFE`` struct) and ``_ingest``; a missing day is an empty result,
    not an error."""
    path = f"{root.rstrip('/')}/{date}"
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], "value string")
        return empty.select(parse_ais(F.col("value")).alias("m"), F.lit(0).cast("bigint").alias("_ingest"))
    return spark.read.text(f"{path}/*.ndjson").select(
        parse_ais(F.col("value")).alias("m"), F.monotonically_increasing_id().alias("_ingest"))


def ais_messages(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(positions, statics) from parsed AIS messages (column ``m``).

    Metadata may be spelled ``MetaData`` or ``Metadata``; the MMSI comes from
    metadata, else from the body ``UserID`` (0 counts as missing); coordinates
    come from the body, else from metadata ``latitude``, else ``Latitude``."""
    m = F.col("m")
    a, b = m["meta_a"], m["meta_b"]
    meta_mmsi = F.coalesce(F.nullif(a["mmsi"], F.lit(0)), F.nullif(b["mmsi"], F.lit(0)))
    meta_lat = F.coalesce(a["lat_lc"], b["lat_lc"], a["lat_uc"], b["lat_uc"])
    meta_lon = F.coalesce(a["lon_lc"], b["lon_lc"], a["lon_uc"], b["lon_uc"])
    pos, stat = m["msg"]["pos"], m["msg"]["stat"]
    received = F.try_to_timestamp(m["received_at"], F.lit(ISO_READ))
    positions = raw.where(m["mt"] == "PositionReport").select(
        F.coalesce(meta_mmsi, F.nullif(pos["user_id"], F.lit(0))).cast("string").alias("mmsi"),
        received.alias("received_at"),
        F.coalesce(pos["lat"], meta_lat).alias("lat"),
        F.coalesce(pos["lon"], meta_lon).alias("lon"),
        pos["sog"].alias("sog"),
        F.lit("PositionReport").alias("message_type"),
        "_ingest")
    statics = raw.where(m["mt"] == "ShipStaticData").select(
        F.coalesce(meta_mmsi, F.nullif(stat["user_id"], F.lit(0))).cast("string").alias("mmsi"),
        stat["imo"].cast("string").alias("imo"),
        F.coalesce(stat["name"], F.lit("")).alias("name"),
        stat["type"].cast("string").alias("type"),
        received.alias("received_at"),
        "_ingest")
    return positions, statics


_NWS = T.StructType([T.StructField("results", T.MapType(T.StringType(), T.StructType([
    T.StructField("features", T.ArrayType(T.StringType()))]))),
    T.StructField("errors", T.MapType(T.StringType(), T.StringType()))])
_METEO = T.StructType([T.StructField("results", T.MapType(T.StringType(), T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("weather_code", T.ArrayType(T.StringType())),
        T.StructField("wind_speed_10m_max", T.ArrayType(T.StringType())),
        T.StructField("precipitation_sum", T.ArrayType(T.StringType()))]))]))),
    T.StructField("errors", T.MapType(T.StringType(), T.StringType()))])
_GDELT = T.StructType([T.StructField("articles", T.ArrayType(T.StructType([
    T.StructField("title", T.StringType())])))])


def _payload(spark: SparkSession, root: str, source: str, schema: T.StructType) -> DataFrame:
    """``date, p`` for every ``<root>/<date>/<source>.json`` (whole-file JSON); no such file: no rows."""
    files = f"{root.rstrip('/')}/*/{source}.json"
    if not _any_file(spark, files):
        return spark.createDataFrame([], "date string, value string").select(
            "date", F.from_json("value", schema).alias("p"))
    df = spark.read.text(files, wholetext=True)
    return df.select(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1).alias("date"),
                     F.from_json("value", schema).alias("p"))


def read_weather(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(alerts, forecast, headlines) from landed weather payloads."""
    nws = _payload(spark, root, "nws", _NWS)
    alerts = nws.select("date", F.explode(F.col("p.results")).alias("port", "r")).select(
        "date", "port", F.coalesce(F.size("r.features"), F.lit(0)).alias("n_alerts"))
    meteo = _payload(spark, root, "open_meteo", _METEO)
    forecast = meteo.select("date", F.explode(F.col("p.results")).alias("port", "r")).select(
        "date", "port",
        F.try_element_at(F.col("r.daily.weather_code"), F.lit(1)).alias("weather_code"),
        F.try_element_at(F.col("r.daily.wind_speed_10m_max"), F.lit(1)).alias("wind_max_kmh"),
        F.try_element_at(F.col("r.daily.precipitation_sum"), F.lit(1)).try_cast("double").alias("precip_mm"))
    gdelt = _payload(spark, root, "gdelt", _GDELT)
    headlines = gdelt.select("date", F.explode_outer("p.articles").alias("a")).select(
        "date", F.coalesce(F.col("a.title"), F.lit("")).alias("title"))
    return alerts, forecast, headlines


def source_errors(spark: SparkSession, root: str, source: str) -> DataFrame:
    """Per date: ports with results and ports with errors; ``down`` when a
    source has errors and no result at all."""
    schema = _NWS if source == "nws" else _METEO
    p = _payload(spark, root, source, schema)
    return p.select("date", F.coalesce(F.size("p.results"), F.lit(0)).alias("ok"),
                    F.coalesce(F.size("p.errors"), F.lit(0)).alias("errors")) \
        .withColumn("down", (F.col("errors") > 0) & (F.col("ok") == 0))


def landing_validation(spark: SparkSession, landing: str) -> DataFrame:
    """Per landing file: ``file_path, lines, ok`` where one bad JSON line
    rejects the whole file (blank lines are bad)."""
    lines = spark.read.text(f"{landing.rstrip('/')}/*.ndjson").select(
        F.col("_metadata.file_path").alias("file_path"), is_json_object_line(F.col("value")).alias("ok"))
    return lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("lines"), F.every("ok").alias("ok"))


def landing_plan(spark: SparkSession, landing: str, date: str, registry: DataFrame | None = None) -> DataFrame:
    """Content-hash landing: accepted files get ``digest`` (first 12 hex of the
    sha1 of their bytes); files whose (date, digest) is already registered
    count as landed but are not written again.  The registry is keyed by
    (date, digest) like the landing folders, so the same bytes on a later date
    land again; ``landed_other_date`` reports those repeats.

    Columns: ``file_path, date, digest, lines, ok, already_landed, landed_other_date``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ndjson").load(landing) \
        .select(F.col("path").alias("file_path"), F.substring(F.sha1("content"), 1, 12).alias("digest"))
    # Spark's readers skip files without a byte: those are listed by name
    empty = spark.createDataFrame([(p,) for p in _empty_files(spark, landing)], "file_path string")
    files = files.unionByName(empty.withColumn("digest", F.substring(F.sha1(F.lit("")), 1, 12)))
    # one spelling of a path for both readers: no scheme, names as they are on disk
    bare = F.regexp_replace("file_path", "^[a-z0-9]+:/+", "/")
    plain = F.url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))
    checks = landing_validation(spark, landing).select(plain.alias("_at"), "lines", "ok")
    # an empty file has no line to check: it lands, with no events
    plan = (files.withColumn("_at", bare).join(checks, "_at", "left").drop("_at").withColumn("date", F.lit(date))
            .withColumn("lines", F.coalesce("lines", F.lit(0))).withColumn("ok", F.coalesce("ok", F.lit(True))))
    if registry is not None:
        reg = registry.select("date", "digest").distinct().withColumn("already_landed", F.lit(True))
        other = registry.where(F.col("date") != F.lit(date)).select("digest").distinct() \
            .withColumn("landed_other_date", F.lit(True))
        plan = plan.join(reg, ["date", "digest"], "left").join(other, "digest", "left")
    else:
        plan = plan.withColumn("already_landed", F.lit(False)).withColumn("landed_other_date", F.lit(False))
    return plan.select("file_path", "date", "digest", "lines", "ok",
                       F.coalesce("already_landed", F.lit(False)).alias("already_landed"),
                       F.coalesce("landed_other_date", F.lit(False)).alias("landed_other_date"))


def ingest_counters(plan: DataFrame) -> DataFrame:
    """files_landed, files_rejected, events (lines of accepted files)."""
    return plan.agg(F.count_if("ok").alias("files_landed"), F.count_if(~F.col("ok")).alias("files_rejected"),
                    F.coalesce(F.sum(F.when(F.col("ok"), F.col("lines"))), F.lit(0)).alias("events"))


def read_mart(spark: SparkSession, gold_root: str, name: str) -> DataFrame:
    """A gold mart by name; a clear error when it has not been built."""
    path = f"{gold_root.rstrip('/')}/{name}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"mart {name} not built yet ({path}); run the gold stage first")
    return spark.read.parquet(path)


def bronze_file_times(spark: SparkSession, root: str) -> DataFrame:
    """``ts`` = modification time of every bronze carrier file (for feed silence)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.ndjson") \
        .option("recursiveFileLookup", "true").load(root).select(F.col("modificationTime").alias("ts"))


# Typed schemas of the silver tables when they are exchanged as CSV exports.
SILVER_CSV_SCHEMAS = {
    "shipment_events": "event_id string, shipment_id string, carrier string, event_type string, "
                       "planned_ts timestamp, actual_ts timestamp, origin string, dest string, vessel_mmsi string",
    "exception_queue": "exception_id string, shipment_id string, carrier string, exception_type string, "
                       "detected_at timestamp, age_hours double, detail string, probable_cause string",
    "shipment_legs": "shipment_id string, leg_seq int, mode string, vessel_mmsi string, origin string, dest string",
    "last_mile": "shipment_id string, address_raw string, pincode string, eway_bill_no string, "
                 "eway_valid_until timestamp",
}


def read_silver_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A silver CSV export read back with its explicit types (no inference):
    header row, empty field = NULL, ISO-8601 UTC instants."""
    return spark.read.schema(SILVER_CSV_SCHEMAS[table]).option("header", True) \
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").option("mode", "FAILFAST").csv(path)
