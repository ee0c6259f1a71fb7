"""Mixing sources to target weights.

Each source gets a share of a token budget.  Its rows are ordered by a
hash-random key, the running sum of their sizes is formed in range buckets of
that key, and the source is cut at its exact budget, whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import stored, text_of, word_count


def source_targets(sizes: DataFrame, share: float = 1.5, weights: Sequence[int] = (5, 2, 1),
                   max_epochs: int = 2) -> DataFrame:
    """Budget of each source, from ``(source, source_size)``: adds ``weight`` and ``target``.

    Sources in code-point order, null last, weigh ``weights``, repeating.  They
    share ``share`` times all sizes in proportion; a target stops at
    ``max_epochs`` times its source's size and the excess goes to the others by
    weight until none is above.  That water level is closed-form: with sources
    by rising ``cap / weight``, one is capped when the level of what the earlier
    caps leave reaches its own ratio.  The windows run over one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int"))
    s = sizes.select("source", "source_size", weight.alias("weight"),
                     (F.col("source_size") * max_epochs).alias("cap"))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    s = s.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))).alias("total"),
        F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"),
        F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)).alias("open_weight"),
    )
    s = s.withColumn("capped", F.col("ratio") * F.col("open_weight") <= F.col("total") - F.col("below"))
    everywhere = Window.partitionBy()
    spent = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everywhere), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everywhere)
    level = (F.col("total") - spent) / open_weight
    return s.select("source", "source_size", "weight",
                    F.when(F.col("capped"), F.col("cap").cast("double"))
                    .otherwise(level * F.col("weight")).alias("target"))


def _unit_bucket(key: Column, buckets: int) -> Column:
    """Range bucket of a uniform 52-bit key; rises with the key."""
    return F.floor(key.cast("double") * F.lit(buckets / float(1 << 52))).cast("long")


def mix(docs: DataFrame, share: float = 1.5, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 2,
        rows_per_bucket: int = 20_000, seed: int = 17) -> DataFrame:
    """What a mixture takes of each document.

    Returns ``doc_id, source, size, source_size, target, epochs, taken``: one
    row per input row.  ``size`` is the text's word count (null text: 0),
    ``target`` its source's budget, ``epochs`` how often it is taken whole and
    ``taken`` the words taken, repeats counted.  The row at the cut is taken in
    part, so a source's ``taken`` sum to its budget rounded down.

    Order within a source is a hash of id and text, so reruns agree and the
    order does not follow the ids; ties (equal rows, or a hash collision) break by id and
    size.  A source is split into range buckets of about ``rows_per_bucket``
    rows, so one source may hold any share of the rows: a window sees one
    bucket, and a source's buckets are summed before they are lined up.
    Null source: a source of its own.  Null ids: rows like any other.  Empty
    table: empty result.  All sizes 0: every target and ``taken`` is 0.
    """
    text = text_of()
    identity = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    key = F.conv(F.substring(F.md5(identity), 1, 13), 16, 10).cast("long")
    sized = stored(docs.select("doc_id", "source", word_count(text).alias("size"), key.alias("key")), "sizes")
    rows = sized.count()
    buckets = max(1, -(-rows // rows_per_bucket))
    dealt = sized.withColumn("bucket", _unit_bucket(F.col("key"), buckets))
    parts = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("part"))
    sources = source_targets(parts.groupBy("source").agg(F.sum("part").alias("source_size")),
                             share, weights, max_epochs)
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("of"), F.col("bucket").alias("nth"),
                         F.coalesce(F.sum("part").over(ahead), F.lit(0)).alias("offset"))
    parts = parts.join(sources, F.col("of").eqNullSafe(F.col("source"))).drop("source")

    within = (Window.partitionBy("source", "bucket").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = dealt.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    got = placed.join(parts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("nth")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    got = got.withColumn("epochs", epochs)
    left = budget - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("before")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return got.select("doc_id", "source", "size", "source_size", "target", "epochs", taken.cast("long").alias("taken"))
