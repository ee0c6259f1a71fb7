"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import checkpoint_dir

#: ASCII white space (\x20 and \x09-\x0D) and its complement, as regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\f\r"
#: Spark's setting to remove the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, a null one read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text (runs of anything but ASCII white space)."""
    trimmed = F.btrim(text, F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def word_count(text: Column) -> Column:
    """Number of words of a text: the places where a word begins."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of repeating
    what made them.  Each call has a folder of its own, so a retried job never
    reads a half-written one.  ``options`` are the writer's.  What the write has
    shuffled is removed when it ends, as nothing reads it again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidewater-{name}-{uuid.uuid4().hex}"
    with settings(spark, {_CLEANUP: "true"}):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote, once what was made of them is written itself."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """Connected components of an undirected graph: ``(node, component)``.

    ``component`` is the smallest node of the component.  Each round every node
    takes the smallest label among its neighbours and itself, then the label of
    that label (pointer jumping), so long chains close in logarithmically many
    rounds.  Labels are pre-aggregated per node before the shuffle and written
    to the checkpoint folder each round; the driver sees one count a round.
    Self-loops keep isolated nodes; an empty graph gives an empty table.
    """
    both = stored(
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        .unionByName(edges.select(F.col(dst).alias("u"), F.col(src).alias("v")))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull()).distinct(), "edges")
    held = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")), "labels")
    labels = held
    while True:
        near = (both.join(labels.select(F.col("u").alias("v"), "label"), "v")
                .groupBy("u").agg(F.min("label").alias("near")))
        hop = labels.select(F.col("u").alias("label"), F.col("label").alias("root"))
        step = (labels.join(near, "u").join(hop, "label")
                .select("u", F.least("label", "near", "root").alias("next"),
                        F.col("label").alias("was")))
        step = stored(step, "labels")
        forget(held)
        moved = step.where("next <> was").limit(1).count()
        held, labels = step, step.select("u", F.col("next").alias("label"))
        if not moved:
            forget(both)
            return labels.select(F.col("u").alias("node"), F.col("label").alias("component"))
