"""Table writes: full rebuild, date-partition upsert, keyed upsert, snapshots.

Writes go to Parquet.  Idempotence comes from overwriting whole partitions
(dynamic partition overwrite) or writing a new version directory and then
pointing readers at it, so a failed or re-run job never leaves a half-written
table and never overwrites a path it is reading.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.timefmt import asof_literal


def write_sorted(df: DataFrame, path: str, sort_cols: list[str], partitions: int | None = None,
                 fmt: str = "parquet") -> None:
    """Full rebuild of a table in a deterministic global order: range
    partitioning on the sort keys, then a sort inside each partition (no
    single-task global sort, nothing collected).  ``fmt="csv"`` is the gold
    export (header, empty field for NULL, ISO instants)."""
    # output files follow the shuffle width, which is sized from the data volume
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_last() for c in sort_cols]   # NULLs last, as the marts order them
    out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        # missing values are written as empty fields, as in the silver CSV contract
        writer.option("header", True).option("nullValue", "").option("emptyValue", "") \
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").csv(path)
    else:
        writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "date",
                         scope: DataFrame | None = None) -> None:
    """Replace only the partitions present in ``df`` (upsert by date).

    Rows are rebalanced on the partition column: small dates share a task, a
    date larger than the advisory partition size is split over several.
    ``scope`` holds the dates this run has read; those without a row in ``df``
    are cleared (the driver sees such dates only)."""
    df.hint("rebalance", F.col(partition_col)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    if scope is not None:
        read = scope.select(F.col(partition_col).cast("string").alias("d")).distinct()
        gone = read.join(df.select(F.col(partition_col).cast("string").alias("d")).distinct(), "d", "left_anti")
        clear_partitions(df.sparkSession, path, partition_col, [r.d for r in gone.collect()])


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``; one that no job has written yet is empty."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def clear_partitions(spark: SparkSession, path: str, partition_col: str, values: list[str]) -> None:
    """Remove the given partition directories through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}={v}")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)


def upsert_by_key(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``existing`` whose key is absent from ``new``, plus ``new``."""
    keep = existing.join(new.select(*key).distinct(), key, "left_anti")
    return keep.unionByName(new)


def write_version(df: DataFrame, root: str, run: str | None = None) -> str:
    """Write ``df`` under ``root/v=<id>`` and switch ``root/_CURRENT`` to it.

    The pointer file is written last and replaced by one overwriting rename, so
    readers see either the old or the new version, never a partial one or none.
    ``run`` names what made the version; the pointer also keeps the version that
    run started from, so a repeat of the same run starts there again
    (``read_before``)."""
    held = _pointer(df.sparkSession, root)
    base = held.get("base") if run is not None and held.get("run") == run else held.get("version")
    version = f"{datetime.now(timezone.utc).strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"
    target = f"{root.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(target)
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    ptr = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_CURRENT")
    tmp = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_CURRENT.{uuid.uuid4().hex}")
    fs = ptr.getFileSystem(conf)
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps({"version": version, "run": run, "base": base}).encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(tmp), fs.makeQualified(ptr), how)
    return target


def _pointer(spark: SparkSession, root: str) -> dict:
    """What ``_CURRENT`` says: a few bytes of metadata, read through the Hadoop file system (Spark's file readers
    skip names starting with ``_``)."""
    jvm = spark.sparkContext._jvm
    ptr = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_CURRENT")
    fs = ptr.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(ptr):
        return {}
    stream = fs.open(ptr)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _version(spark: SparkSession, root: str, version: str | None, schema) -> DataFrame | None:
    if version is None:
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root.rstrip('/')}/v={version}")


def read_current(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The table version ``_CURRENT`` points at (None when nothing was written)."""
    return _version(spark, root, _pointer(spark, root).get("version"), schema)


def read_before(spark: SparkSession, root: str, run: str, schema=None) -> DataFrame | None:
    """The version ``run`` starts from: the current one, or, where ``run`` itself made that, the one it was made from."""
    held = _pointer(spark, root)
    return _version(spark, root, held.get("base") if held.get("run") == run else held.get("version"), schema)


def append_snapshot(df: DataFrame, root: str, snapshot_ts: str | datetime) -> None:
    """Add one build of a table under ``snapshot_ts=<instant>``; a repeated run replaces its own."""
    stamped = df.withColumn("snapshot_ts", asof_literal(snapshot_ts))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("snapshot_ts").parquet(root)


def snapshot_as_of(snapshots: DataFrame, t: str | datetime, computed: bool = False) -> DataFrame:
    """Rows of the newest snapshot taken at or before ``t``.

    The newest qualifying instant is a one-row aggregate joined back on the
    snapshot column (a broadcast of one row; with a partitioned table the
    filter prunes to that partition).

    ``computed``: the snapshots are results of the same plan, not a table.  The
    aggregate then takes whole rows, as the join does: with the same columns on
    both sides Spark reuses their exchanges and computes no snapshot twice."""
    eligible = snapshots.where(F.col("snapshot_ts") <= asof_literal(t))
    newest = eligible.agg(F.max("snapshot_ts").alias("snapshot_ts"))
    if computed:
        whole = F.struct("snapshot_ts", *[c for c in snapshots.columns if c != "snapshot_ts"])
        newest = eligible.agg(F.max_by(whole, "snapshot_ts").alias("r")).select("r.snapshot_ts")
    return eligible.join(F.broadcast(newest), "snapshot_ts")


def restore_snapshot(snapshots: DataFrame, t: str | datetime) -> DataFrame:
    """The table as of ``t`` without the snapshot column (to be written forward)."""
    return snapshot_as_of(snapshots, t).drop("snapshot_ts")


def append_json(df: DataFrame, path: str) -> None:
    """Append-only ledger (e.g. alert failures)."""
    df.write.mode("append").json(path)

