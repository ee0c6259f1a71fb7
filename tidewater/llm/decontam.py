"""Benchmark decontamination by spaced seeds."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stored, text_of, words

#: Token offsets a seed looks at; the positions between them are ignored.
#: Together they hit every aligned stretch of 8 tokens with one substitution
#: and of 10 or 13 tokens with two.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
#: Shorter stretches are sought by masks of their own length.
SHORT = 8
#: Benchmark seeds up to this many are broadcast (about 12 bytes each).
BROADCAST_SEEDS = 4_000_000
_CHUNK = 4096


def _tokens(text: Column) -> Column:
    """64-bit hashes of the lower-cased words."""
    return F.transform(words(F.lower(text)), lambda w: F.xxhash64(w))


def _row_key(id_col: str) -> Column:
    text = text_of()
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))


def _enough(need: int, identity: float) -> int:
    """Equal words that a stretch of ``need`` words must have."""
    return math.ceil(need * identity)


def _masks_of(need: int, identity: float) -> list[tuple[int, tuple[int, ...]]]:
    """``(tag, offsets)`` of the masks that find a stretch of ``need`` words.

    Under ``SHORT`` words one mask for each choice of the positions that may be
    substituted, so none is missed and, below five words, only equal ones hit.
    """
    if need >= SHORT:
        return list(enumerate(MASKS))
    kept = combinations(range(need), _enough(need, identity))
    return [(1000 * need + i, m) for i, m in enumerate(kept)]


def _seeds(rows: DataFrame, masks: list[tuple[int, tuple[int, ...]]]) -> DataFrame:
    """``(key, pos, seed)`` for each mask and token position of ``(key, tokens)``.

    A text is cut into overlapping chunks first, so one row holds a bounded
    array however long the text; shifted copies of a chunk side by side give
    the masked tokens as plain columns.
    """
    span = 1 + max(m[-1] for _, m in masks)
    starts = F.sequence(F.lit(0), F.size("tokens") - 1, F.lit(_CHUNK))
    chunked = rows.where(F.size("tokens") > 0).select(
        "key", F.explode(F.transform(starts, lambda s: F.struct(
            s.alias("at"), F.slice("tokens", s + 1, _CHUNK + span - 1).alias("c")))).alias("x"))
    chunked = chunked.select("key", "x.at", "x.c")
    n = F.least(F.size("c"), F.lit(_CHUNK))
    shifts = F.arrays_zip(*[F.slice("c", i + 1, n).alias(f"t{i}") for i in range(span)])
    flat = chunked.select("key", "at", F.posexplode(shifts).alias("i", "t"))
    flat = flat.select("key", (F.col("at") + F.col("i")).alias("pos"), "t.*")
    seeds = F.array(*[F.when(F.col(f"t{m[-1]}").isNotNull(), F.xxhash64(F.lit(k), *[F.col(f"t{i}") for i in m]))
                      for k, m in masks])
    return (flat.select("key", "pos", F.explode(seeds).alias("seed")).where(F.col("seed").isNotNull()))


def overlaps(docs: DataFrame, benchmark: DataFrame, min_overlap: int = 13, identity: float = 0.8,
             broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """Benchmark passages in documents, allowing substituted words.

    Returns one row per document and benchmark item that overlap: ``doc_id,
    item_id, doc_start, item_start, overlap, matched`` for the alignment with
    most equal words (then the one furthest left).  Tokens are lower-cased
    words.  Item and document overlap when, at some alignment, a stretch of
    ``min_overlap`` words (the whole item if it is shorter) has at least
    ``identity`` of its words equal; at the given 0.8 that is every word of an
    item of under five words.  Items without a word never match; null texts are empty; null ids are ids.  Rows
    equal in id and text count once; an empty table on either side gives an
    empty result.

    The masks find every stretch of 13 words with up to two substitutions
    (and of 8 with one): their hashes of all documents meet the benchmark's.
    Items of under eight words (or all, at such a ``min_overlap``) have masks of
    their own; documents are read with them only for the lengths that occur.
    The benchmark's seeds are counted, broadcast up to ``broadcast_seeds`` and
    shuffled beyond.  Only alignments hit are verified, and only documents
    with a hit are read again for it.
    """
    items = (benchmark.select(_row_key("item_id").alias("key"), _tokens(text_of()).alias("tokens"))
             .where(F.size("tokens") > 0).dropDuplicates(["key"])
             .withColumn("need", F.least(F.size("tokens"), F.lit(min_overlap), F.lit(SHORT))))
    needs = sorted(r.need for r in items.select("need").distinct().collect()) or [SHORT]  # at most SHORT numbers
    masks = [m for need in needs for m in _masks_of(need, identity)]
    wanted = reduce(DataFrame.unionByName, [
        _seeds(items.where(F.col("need") == need), _masks_of(need, identity)) for need in needs]).select("seed", F.col("key").alias("item"), F.col("pos").alias("item_pos"))
    few = wanted.count() <= broadcast_seeds
    hint = F.broadcast if few else (lambda df: df)

    texts = docs.select(_row_key("doc_id").alias("key"), text_of().alias("text"))
    probes = _seeds(texts.select("key", _tokens(F.col("text")).alias("tokens")), masks)
    hits = stored(probes.join(hint(wanted), "seed")
                  .select("key", "item", (F.col("pos") - F.col("item_pos")).alias("diag")).distinct(), "seed-hits")

    named = items.select(F.col("key").alias("item"), F.col("tokens").alias("item_tokens"))
    found = hits.join(hint(named), "item")
    read = texts.join(hits.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    read = read.select("key", _tokens(F.col("text")).alias("tokens"))
    start = F.greatest(F.col("diag"), F.lit(0))
    first = F.greatest(-F.col("diag"), F.lit(0))
    length = F.least(F.size("tokens") - start, F.size("item_tokens") - first)
    pairs = (found.join(read, "key")
             .select("key", "item", start.alias("doc_start"), first.alias("item_start"), length.alias("overlap"),
                     F.least(F.size("item_tokens"), F.lit(min_overlap)).alias("need"),
                     F.zip_with(F.slice("tokens", start + 1, length), F.slice("item_tokens", first + 1, length),
                                lambda a, b: (a == b).cast("int")).alias("same")))
    pairs = pairs.where("overlap >= need")
    stretches = F.transform(
        F.sequence(F.lit(0), F.col("overlap") - F.col("need")),
        lambda i: F.aggregate(F.slice("same", i + 1, F.col("need")), F.lit(0), lambda a, x: a + x))
    good = pairs.where(F.array_max(stretches) >= F.ceil(F.col("need") * F.lit(float(identity))))
    total = F.aggregate("same", F.lit(0), lambda a, x: a + x)
    best = (good.select("key", "item", F.struct(total.alias("matched"), (-F.col("doc_start")).alias("left"),
                                                "doc_start", "item_start", "overlap").alias("x"))
            .groupBy("key", "item").agg(F.max("x").alias("x")))
    return best.select(F.col("key.id").alias("doc_id"), F.col("item.id").alias("item_id"), "x.doc_start",
                       "x.item_start", "x.overlap", "x.matched", F.col("key.h").alias("text_hash"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents without any benchmark overlap, all columns as they were.

    Rows are matched by id and text, so a repeated id with another text stays.
    """
    found = overlaps(docs, benchmark, **params).select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_h")).distinct()
    same = docs["doc_id"].eqNullSafe(F.col("_bad_id")) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
                                                          == F.col("_bad_h"))
    return docs.join(found, same, "left_anti")
