"""Exact medians by range refinement: no task ever holds all values of a group.

A sketch a group (``percentile_approx``, merged map-side, of bounded size and
with a guaranteed rank error) names a narrow range that must hold the middle
ranks.  One more aggregate counts the values below the range and the distinct
values inside it; running counts over those few finish the selection.  Rows
outside the range are only counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The sketch's rank error is 1 in this many; the range reaches twice as far to either side of the middle.
ACCURACY = 10_000


def medians(rows: DataFrame, keys: list[str], value: str, accuracy: int = ACCURACY) -> DataFrame:
    """``*keys, n, median`` of the rows whose ``value`` is not null; a null key is a key.

    The median of an even count is the mean of the two middle values.  Groups
    without a value have no row; with no keys there is one group.
    """
    reach = 2.0 / accuracy
    held = [f"_k{i}" for i in range(len(keys))]
    v = rows.where(F.col(value).isNotNull()).select(
        *[F.col(k).alias(h) for k, h in zip(keys, held, strict=True)], F.col(value).cast("double").alias("_v"))
    v = v if held else v.withColumn("_one", F.lit(1))
    held = held or ["_one"]
    ends = v.groupBy(*held).agg(F.percentile_approx("_v", [0.5 - reach, 0.5 + reach], accuracy).alias("_e"),
                                F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.count(F.lit(1)).alias("n"))
    # two values or fewer a side of the middle are all of a small group
    small = F.col("n") <= accuracy // 100
    ends = ends.select(*[F.col(h).alias(f"{h}_") for h in held], "n",
                       F.when(small, F.col("_least")).otherwise(F.col("_e")[0]).alias("_low"),
                       F.when(small, F.col("_most")).otherwise(F.col("_e")[1]).alias("_high"))
    same = F.lit(True)
    for h in held:
        same = same & F.col(h).eqNullSafe(F.col(f"{h}_"))
    near = v.join(ends, same).where(F.col("_v") <= F.col("_high"))
    # everything below the range is one entry
    place = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))
    counted = near.groupBy(*held, "n", place.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*held).orderBy(F.col("_v").asc_nulls_first()))
    run = counted.withColumn("_upto", upto)
    lower, upper = F.expr("(n - 1) div 2"), F.expr("n div 2")
    holds = lambda rank: (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))
    picked = run.groupBy(*held, "n").agg(F.max(F.when(holds(lower), F.col("_v"))).alias("_a"),
                                         F.max(F.when(holds(upper), F.col("_v"))).alias("_b"))
    named = [F.col(h).alias(k) for h, k in zip(held, keys)]  # none without keys
    return picked.select(*named, "n", ((F.col("_a") + F.col("_b")) / 2).alias("median"))
