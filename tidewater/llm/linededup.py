"""Removal of repeated three-line windows across a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key of their id and text, ``(k_id, k_text)``, and the lines."""
    text = text_of()
    return docs.select(F.struct(F.col("doc_id").isNull().alias("null_id"), F.col("doc_id"),
                                F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")).alias("row_key"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.split(text, "\n").alias("lines"))


def line_windows(keyed: DataFrame, window: int = 3) -> DataFrame:
    """Every window of ``window`` consecutive lines: ``row_key, pos, w1, w2``.

    Lines are compared without surrounding white space; windows of blank lines
    only are left out.  Two 64-bit hashes stand for a window.
    """
    trimmed = F.transform("lines", lambda x: F.trim(F.translate(x, "\t\r", "  ")))
    lines = keyed.where(F.size("lines") >= window).select("row_key", trimmed.alias("lines"))
    n = F.size("lines")
    shifted = F.arrays_zip(*[F.slice("lines", i + 1, n - (window - 1)).alias(f"l{i}") for i in range(window)])
    flat = lines.select("row_key", F.posexplode(shifted).alias("pos", "w"))
    parts = [F.col(f"w.l{i}") for i in range(window)]
    return (flat.where(F.concat(*parts) != "")
            .select("row_key", "pos", F.xxhash64(*parts).alias("w1"),
                    F.xxhash64(F.lit(7), *reversed(parts)).alias("w2")))


def dedup_lines(docs: DataFrame, window: int = 3) -> DataFrame:
    """Drop every later occurrence of a repeated ``window``-line passage.

    Lines are parted by ``\\n``.  A window of consecutive lines that occurs
    more than once in the corpus stays where it occurs first (by doc_id, null
    ids last, then by position) and its lines are removed wherever it occurs
    again, in other rows or further down the same one; overlapping removals
    merge.  Every removed line therefore stays somewhere earlier.

    Returns all columns of ``docs`` (``text`` rewritten, and ``n_chars`` if
    present) plus ``n_lines`` and ``n_removed``; one row per input row, never
    fewer.  A text of under ``window`` lines is left alone, a null text stays
    null, and rows equal in id and text are treated alike as one occurrence.
    A column already called ``n_lines`` or ``n_removed`` is replaced.

    The first occurrence is a pre-aggregated minimum per window, one row per
    window whatever its frequency, and joins back to the occurrences, which
    adaptive execution may split; covered positions are grouped by row.
    """
    keyed = _keyed(docs)
    seen = line_windows(keyed, window)
    place = F.struct("row_key", "pos")
    first = (seen.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where(F.col("first") != F.col("last")).select("w1", "w2", "first"))
    again = (seen.join(first, ["w1", "w2"])
             .where(place != F.col("first"))
             .groupBy("row_key").agg(F.collect_set("pos").alias("starts")))
    out = keyed.join(again, "row_key", "left")
    hit = F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (window - 1)))))
    out = out.withColumn("covered", F.coalesce(hit, F.array().cast("array<int>")))
    # positions to keep, as a set difference: linear in the lines
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("covered")))
    text = F.when(F.size("covered") == 0, F.col("row.text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n"))
    out = out.withColumn("new_text", text)
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.col("new_text").alias(c))
        elif c == "n_chars":
            cols.append(F.when(F.size("covered") == 0, F.col("row.n_chars"))
                        .otherwise(F.length("new_text").cast(docs.schema[c].dataType)).alias(c))
        elif c not in ("n_lines", "n_removed"):
            cols.append(F.col(f"row.`{c}`").alias(c))
    return out.select(*cols, F.size("lines").alias("n_lines"), F.size("covered").alias("n_removed"))
