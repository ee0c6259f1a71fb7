"""Data tests as queries: each returns the number of failures (0 = pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _row(name: str, failures) -> list:
    return [F.lit(name).alias("test_name"), failures.cast("bigint").alias("failures")]


def table_checks(df: DataFrame, checks: list[tuple]) -> DataFrame:
    """All checks of one table in one pass, a row ``test_name, failures`` each.

    ``("unique", col, name)``: distinct non-NULL values that occur more than once;
    ``("not_null", col, name)``: NULLs; ``("accepted", col, values, name)``: distinct
    values outside ``values`` (NULL passes); ``("rows", other, name)``: 1 when the
    table ``other`` has another row count, else 0.

    A row gives one cell per checked key, and one per value that is not accepted;
    cells are counted by value, and every check reads those counts."""
    cols = list(dict.fromkeys(c[1] for c in checks if c[0] != "rows"))
    keys = list(dict.fromkeys(c[1] for c in checks if c[0] in ("unique", "not_null")))

    def cell(kind, col=None):
        held = [F.when(F.lit(c == col), F.col(c)).alias(f"v{i}") for i, c in enumerate(cols)]
        return F.struct(F.lit(kind).alias("kind"), F.lit(cols.index(col) if col else -1).alias("at"), *held)

    always = [cell("key", c) for c in keys] or [cell("row")]
    refused = [F.when(~F.col(c[1]).isin(*c[2]), cell(f"refused{i}", c[1])) for i, c in enumerate(checks) if c[0] == "accepted"]
    cells = F.filter(F.array(*always, *refused), lambda x: x.isNotNull()) if refused else F.array(*always)
    counted = df.select(F.explode_outer(cells).alias("c")).select("c.*") \
        .groupBy("kind", "at", *[f"v{i}" for i in range(len(cols))]).agg(F.count(F.lit(1)).alias("n"))

    def of(col):
        return (F.col("kind") == "key") & (F.col("at") == cols.index(col)), F.col(f"v{cols.index(col)}")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    found, others = [], []
    for i, c in enumerate(checks):
        if c[0] == "unique":
            here, v = of(c[1])
            found.append(F.count_if(here & v.isNotNull() & (F.col("n") > 1)))
        elif c[0] == "not_null":
            here, v = of(c[1])
            found.append(total(here & v.isNull()))
        elif c[0] == "accepted":
            found.append(F.count_if(F.col("kind") == f"refused{i}"))
        elif c[0] == "rows":
            found.append(total(of(keys[0])[0] if keys else F.col("kind") == "row"))
            others.append((i, c[1]))
        else:
            raise ValueError(f"unknown check {c[0]!r}")
    out = counted.agg(*[f.cast("bigint").alias(f"f{i}") for i, f in enumerate(found)], F.lit(1).alias("_k"))
    for i, other in others:
        n = other.agg(F.count(F.lit(1)).alias(f"o{i}"), F.lit(1).alias("_k"))
        out = out.join(n, "_k").withColumn(f"f{i}", F.when(F.col(f"f{i}") != F.col(f"o{i}"), 1).otherwise(0).cast("bigint"))
    return out.select(F.inline(F.array(*[F.struct(*_row(c[-1], F.col(f"f{i}"))) for i, c in enumerate(checks)])))


def unique(df: DataFrame, col: str, name: str) -> DataFrame:
    """Distinct non-NULL values that occur more than once."""
    return table_checks(df, [("unique", col, name)])


def not_null(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.agg(*_row(name, F.count_if(F.col(col).isNull())))


def accepted_values(df: DataFrame, col: str, values: list[str], name: str) -> DataFrame:
    """Distinct values outside ``values`` (NULL passes)."""
    return table_checks(df, [("accepted", col, values, name)])


def row_count_equal(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """1 when the two tables have different row counts, else 0."""
    return table_checks(a, [("rows", b, name)])


#: Hash buckets a table is fingerprinted in.
FINGERPRINT_BUCKETS = 4096


def _marked(df: DataFrame) -> DataFrame:
    """Rows with two hashes of all columns (a null counts as a value) and the bucket they fall in."""
    cells = [c for name in df.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return df.select("*", F.xxhash64(F.lit(1), *cells).alias("_h"), F.xxhash64(F.lit(2), *cells).alias("_g")) \
        .withColumn("_bucket", F.pmod("_h", F.lit(FINGERPRINT_BUCKETS)))


def fingerprint(df: DataFrame) -> DataFrame:
    """``_bucket, n, x, y``: rows a bucket and the sums of their hashes, the same in any order, duplicates counted."""
    wide = "decimal(38,0)"
    return _marked(df).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast(wide)).alias("x"),
                                              F.sum(F.col("_g").cast(wide)).alias("y"))


def unequal_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Buckets whose fingerprints differ; equal tables give none, after one exchange of a few rows a task."""
    fa, fb = (fingerprint(df).select("_bucket", F.struct("n", "x", "y").alias(c)) for df, c in ((a, "a"), (b, "b")))
    return fa.join(fb, "_bucket", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("_bucket")


def identical(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one table and not the other, both ways, duplicates counted.

    Tables are compared by their fingerprints; rows meet only for the buckets
    that differ (at most ``FINGERPRINT_BUCKETS`` numbers, broadcast)."""
    b = b.select(*a.columns)
    differ = F.broadcast(unequal_buckets(a, b))
    rest = [_marked(df).join(differ, "_bucket", "left_semi").drop("_bucket", "_h", "_g") for df in (a, b)]
    diff = rest[0].exceptAll(rest[1]).unionByName(rest[1].exceptAll(rest[0]))
    return diff.agg(*_row("identical", F.count(F.lit(1))))
