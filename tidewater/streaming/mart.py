"""T7: the exception mart kept up to date from changes of the queue (A20), not rebuilt.

The mart's groups are kept as a multiset, how many open exceptions a group has
of each age, in hash buckets.  A change of the queue is a signed row; a
micro-batch adds the signed sums to the buckets they fall in and derives those
buckets' mart rows again.  Buckets without a change are neither read nor
written.  A maximum can fall as well as rise: the next lower age is in the
multiset.

Files of a micro-batch lie under ``batch=<number>/bucket=<b>``; the newest
number of a bucket holds.  A repeated batch starts from the numbers before its
own and replaces its files, so it gives the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater import config
from tidewater.sinks import tables
from tidewater.sinks.tables import snapshot_as_of
from tidewater.streaming import jobs

KEYS = ["exception_type", "probable_cause", "carrier"]
BUCKETS = 256
_HELD = "exception_type string, probable_cause string, carrier string, tenths bigint, n bigint"
_MART = ("exception_type string, probable_cause string, carrier string, open_exceptions bigint, avg_age_h double, "
         "max_age_h double, band2_escalations bigint")


def queue_changes(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """Signed rows ``*KEYS, tenths, sign``: each exception that left, came or changed (-1 its old row, +1 its new one)."""
    row = F.struct(*KEYS, F.round(F.col("age_hours") * 10).cast("bigint").alias("tenths"))
    new = after.select("exception_id", row.alias("new"))
    if before is None:
        return new.select("new.*", F.lit(1).alias("sign"))
    both = before.select("exception_id", row.alias("old")).join(new, "exception_id", "full_outer")
    moved = both.where(~F.col("old").eqNullSafe(F.col("new")))
    signed = F.filter(F.array(F.struct(F.col("old").alias("r"), F.lit(-1).alias("sign")),
                              F.struct(F.col("new").alias("r"), F.lit(1).alias("sign"))), lambda x: x.r.isNotNull())
    return moved.select(F.explode(signed).alias("x")).select("x.r.*", "x.sign")


def _newest(spark: SparkSession, root: str, before: int | None = None, buckets: set[int] | None = None) -> list[str]:
    """Folder of the newest number of each bucket (names only are read)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/batch=*/bucket=*")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    best: dict[int, tuple[int, str]] = {}
    for f in fs.globStatus(path) or []:
        at = f.getPath()
        number, bucket = int(at.getParent().getName().split("=")[1]), int(at.getName().split("=")[1])
        if (before is None or number < before) and (buckets is None or bucket in buckets):
            best[bucket] = max(best.get(bucket, (-1, "")), (number, at.toString()))
    return [p for _, p in best.values()]


def apply_changes(changes: DataFrame, root: str, batch: int) -> list[int]:
    """Add signed rows to the multiset under ``root/held`` and derive the mart rows of the touched buckets under
    ``root/mart``; returns those buckets."""
    spark = changes.sparkSession
    bucket = F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS)).cast("int")
    delta = changes.groupBy(*KEYS, "tenths").agg(F.sum("sign").cast("bigint").alias("n")).where("n <> 0").persist()
    try:
        touched = sorted(r.b for r in delta.select(bucket.alias("b")).distinct().collect())  # at most BUCKETS numbers
        if touched:
            paths = _newest(spark, f"{root}/held", batch, set(touched))
            held = delta if not paths else delta.unionByName(spark.read.schema(_HELD).parquet(*paths).where("n <> 0"))
            # a bucket that has emptied keeps its rows of none, so that its older files do not come back
            summed = held.groupBy(*KEYS, "tenths").agg(F.sum("n").alias("n")).withColumn("bucket", bucket)
            at = f"{root}/held/batch={batch:012d}"
            summed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
            read = spark.read.schema(_HELD + ", bucket int").parquet(at)
            _mart_of(read).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
                f"{root}/mart/batch={batch:012d}")
    finally:
        delta.unpersist()
    return touched


def _mart_of(held: DataFrame) -> DataFrame:
    there = F.col("n") > 0
    g = held.groupBy("bucket", *KEYS).agg(
        F.sum("n").alias("open_exceptions"), F.sum(F.col("n") * F.col("tenths")).alias("_t"),
        F.max(F.when(there, F.col("tenths"))).alias("_most"),
        F.coalesce(F.sum(F.when(F.col("tenths") >= 10 * config.BANDS_H[1], F.col("n"))), F.lit(0)).alias("band2_escalations"))
    return g.select("bucket", *KEYS, "open_exceptions",
                    F.when(F.col("open_exceptions") > 0, F.col("_t") / F.col("open_exceptions") / 10.0).alias("avg_age_h"),
                    (F.col("_most") / 10.0).alias("max_age_h"), "band2_escalations")


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    """The exception mart as it is now; groups without an open exception are not in it."""
    paths = _newest(spark, f"{root}/mart")
    if not paths:
        return spark.createDataFrame([], _MART)
    return spark.read.schema(_MART).parquet(*paths).where("open_exceptions > 0")


def incremental_mart_batch(batch: DataFrame, snapshots_root: str, root: str, number: int) -> None:
    """Bring the mart from the snapshot applied last to the newest one of the micro-batch; an older one changes nothing."""
    spark = batch.sparkSession
    newest = batch.agg(F.max("snapshot_ts")).first()[0]
    run = str(number)
    applied = tables.read_before(spark, f"{root}/applied", run)
    last = applied.first().snapshot_ts if applied is not None else None  # one row
    if newest is None or (last is not None and newest <= last):
        return
    all_of = spark.read.schema(batch.schema).parquet(snapshots_root)
    before = None if last is None else snapshot_as_of(all_of.where(F.col("snapshot_ts") == F.lit(last)), last)
    apply_changes(queue_changes(before, batch.where(F.col("snapshot_ts") == F.lit(newest))), root, number)
    tables.write_version(spark.createDataFrame([(newest,)], "snapshot_ts timestamp"), f"{root}/applied", run)


def start_incremental_mart(spark: SparkSession, snapshots_root: str, schema, root: str, checkpoint: str | None = None,
                           available_now: bool = True, interval: str = "15 minutes") -> StreamingQuery:
    """Keep the mart under ``root`` up to date with the snapshots; a checkpoint belongs to one ``root``."""
    w = jobs.queue_stream(spark, snapshots_root, schema).writeStream.foreachBatch(
        lambda df, number: incremental_mart_batch(df, snapshots_root, root, number)) \
        .option("checkpointLocation", jobs._ckpt(spark, "incremental_mart", checkpoint))
    return jobs._trigger(w, available_now, interval).start()
