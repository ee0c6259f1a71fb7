"""Near-duplicate documents by Order MinHash."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import components, forget, stored, text_of
from tidewater.llm.variants import build_filters

_MUL = np.uint64(0x9FB21C651E98DF25)
_ADD = np.uint64(0x2545F4914F6CDD1D)
_WIDE = 200_000  # k-mers a text may have to be sketched for all functions at once
_SLOTS = 1 << 22  # counters of the shingle order
_CHUNK = 1 << 14  # counters that are summed together
_FEW = 1_000_000  # texts, named by 8 bytes each, that may be broadcast
_FILTER_BYTES = 32 << 20  # what the filter of shared shingles may take
_YIELD = 0.01  # links that a round must find among its pairs for another one to follow
_SLACK = 1e-6  # bounds on counts of shingles give way by this much, so rounding loses no pair


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MUL
    return x ^ (x >> np.uint64(29))


def kmers(text: str | None, k: int) -> np.ndarray:
    """Keys of the ``k``-word shingles of a text in order, each labelled with its occurrence number.

    Words are lower-cased; a text of under ``k`` words is one shingle, an empty
    one none.  The nth occurrence of a shingle has a key of its own, so the keys
    of one text differ from each other.
    """
    found = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
    tokens = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = len(tokens) - k + 1
    keys = np.zeros(n, np.uint64)
    for i in range(k):
        keys = _mix(keys + tokens[i:i + n] + _ADD)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    start = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    if len(start) < n:
        nth = np.empty(n, np.uint64)
        nth[order] = np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))
        keys = np.where(nth > 0, _mix(keys + nth * _ADD), keys)
    return keys


def sketches(keys: np.ndarray, count: int, length: int) -> np.ndarray:
    """``count`` order-min-hashes: the ``length`` smallest keys of a function, in text order."""
    seeds = _mix(np.arange(1, count + 1, dtype=np.uint64) * _ADD)
    take = min(length, len(keys))
    out = np.empty(count, np.uint64)
    step = count if len(keys) <= _WIDE else 1
    for j in range(0, count, step):
        values = _mix(keys[None, :] ^ seeds[j:j + step, None])
        at = np.argpartition(values, take - 1, axis=1)[:, :take] if take < len(keys) else np.tile(
            np.arange(len(keys)), (step, 1))
        chosen = keys[np.sort(at, axis=1)]
        one = seeds[j:j + step].copy()
        for i in range(take):
            one = _mix(one + chosen[:, i])
        out[j:j + step] = one
    return out


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Share of aligned shingles: ``L / (|a| + |b| - L)``, ``L`` the longest common subsequence.

    0.0 where that is surely under ``least``.  Keys occur once in a text, so
    common keys are anchors and the alignment is the longest rising chain of
    them inside the band that ``least`` leaves: leaving it costs more unaligned
    shingles than ``least`` allows.
    """
    both = len(a) + len(b)
    if not both:
        return 1.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(at_a) < least * (both - len(at_a)):
        return 0.0
    band = both - 2 * least / (1 + least) * both + 1
    inside = np.abs(at_a - at_b) <= band
    at_b = at_b[inside][np.argsort(at_a[inside])]
    if len(at_b) < 2 or (np.diff(at_b) > 0).all():
        chain = len(at_b)
    else:
        tails: list[int] = []
        for x in at_b.tolist():
            place = bisect_left(tails, x)
            if place == len(tails):
                tails.append(x)
            else:
                tails[place] = x
        chain = len(tails)
    return chain / (both - chain)


def rarest(keys: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` first keys by the count of their slot, then by key: an order all texts share."""
    seen = counts[(keys & np.uint64(len(counts) - 1)).astype(np.int64)]
    return keys[np.lexsort((keys, seen))[:length]]


def reach(n: int, share: float) -> int:
    """Rarest shingles of a text of ``n`` that hold one of any ``share * n`` shingles of it."""
    return n - max(1, math.ceil(share * n - _SLACK)) + 1


_MARKED = "doc_id bigint, key binary, n bigint, marks array<bigint>, chunk int, counts binary"


def _sketcher(k: int, count: int, length: int):
    """Sketches of the texts, then the counters of all shingles read, chunk by chunk."""
    names = [c.split()[0] for c in _MARKED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(_SLOTS, np.int32)
        for batch in batches:
            sizes, rows = [], []
            for cell in batch.column("text"):
                keys = kmers(cell.as_py(), k)
                sizes.append(len(keys))
                rows.append(sketches(keys, count, length).view(np.int64) if len(keys) else None)
                np.add.at(seen, (keys & np.uint64(_SLOTS - 1)).astype(np.int64), 1)
            none = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(sizes, pa.int64()),
                 pa.array(rows, pa.list_(pa.int64())), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names=names)
        parts = np.minimum(seen, 65535).astype(np.uint16).reshape(-1, _CHUNK)
        used = np.flatnonzero(parts.any(axis=1))
        none = len(used)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(none, pa.int64()), pa.nulls(none, pa.binary()), pa.nulls(none, pa.int64()),
             pa.nulls(none, pa.list_(pa.int64())), pa.array(used, pa.int32()),
             pa.array([zlib.compress(parts[i].tobytes(), 1) for i in used], pa.binary())], names=names)

    return run


def _verifier(k: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, keys = None, None
        for batch in batches:
            ok = []
            for a, text_a, text_b in zip(batch.column("a").to_pylist(), batch.column("text_a").to_pylist(),
                                         batch.column("text_b").to_pylist(), strict=True):
                if a != last:  # a leader's pairs follow each other
                    last, keys = a, kmers(text_a, k)
                ok.append(similarity(keys, kmers(text_b, k), least))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.float64())],
                                             names=["a", "b", "similarity"])

    return run


def _counts(marked: DataFrame) -> np.ndarray:
    """Shingles of all texts by slot; a table of fixed size, whatever the corpus."""
    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, chunk = np.zeros(_CHUNK, np.int64), None
        for batch in parts:
            chunk = batch.column("chunk")[0]
            for packed in batch.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(packed), np.uint16)
        low = np.minimum(total, 2 ** 31 - 1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()], pa.int32()), pa.array([low.tobytes()])],
                                         names=["chunk", "counts"])

    rows = marked.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInArrow(
        add, "chunk int, counts binary")
    counts = np.zeros(_SLOTS, np.int32)
    for row in rows.toLocalIterator():  # _SLOTS / _CHUNK rows
        counts[row.chunk * _CHUNK:(row.chunk + 1) * _CHUNK] = np.frombuffer(row.counts, np.int32)
    return counts


def _rarest_of(k: int, counts: np.ndarray, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends, rows = [], [], []
            for cell in batch.column("text"):
                keys = kmers(cell.as_py(), k)
                n = len(keys)
                rare = rarest(keys, counts, reach(n, least)) if n else keys
                sizes.append(n)
                rows.append(rare.view(np.int64))
                # the place of the last one in the order all texts share: its count, then its key
                ends.append(dict(seen=int(counts[int(rare[-1]) & (_SLOTS - 1)]),
                                 key=int(rare[-1] ^ np.uint64(1 << 63)) - (1 << 64) if int(rare[-1]) < 1 << 63
                                 else int(rare[-1]) - (1 << 63)) if n else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()),
                 pa.array(ends, pa.struct([("seen", pa.int64()), ("key", pa.int64())])),
                 pa.array(rows, pa.list_(pa.int64()))], names=["node", "n", "last", "rare"])

    return run


def _shared_only(filters):
    """The rare shingles that the filter of shared ones holds, with their texts.

    ``tail`` counts the shingles of the text from this one on in the order all
    texts share, ``after`` those of its prefix that the filter holds.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = filters.value
        for batch in batches:
            lists = batch.column("rare")
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            there = np.flatnonzero(held.holds(0, flat))
            at, n = row[there], batch.column("n").to_numpy()
            place = there - np.r_[0, ends][at]
            upto = np.searchsorted(there, ends)  # shingles held of the texts up to each
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(at)) for c in ("node", "n", "last", "part")],
                 pa.array(flat[there].view(np.int64)), pa.array(n[at] - place), pa.array(upto[at] - np.arange(len(there)))],
                names=["node", "n", "last", "part", "bucket", "tail", "after"])

    return run


def _unmet(texts: DataFrame, marked: DataFrame, named: DataFrame, k: int, least: float) -> DataFrame:
    """All pairs ``a, b`` of unequal parts that may be near duplicates: a prefix-filter join, none is left out.

    Texts of s <= g shingles at similarity ``least`` have ``least / (1 + least) *
    (s + g)`` in common at least, which is no less than ``least * g``.  So at
    least one of the common ones is among the ``reach`` rarest of both.  Behind
    the first of them in the order all texts share come all others, so neither
    text may have fewer shingles from there on than must be common: a pair
    meets only by shingles near the front of both, and only shingles that can be
    the first ones of some smaller text are dealt out.  Of two
    prefixes let one end first: a common shingle that is not in both prefixes
    comes after that end, so the common ones are at most the shared ones of
    either prefix from the first on, and the rest of that text.  Pairs that
    cannot reach the number are not made at all.  The order decides only how
    few texts share a rare shingle.

    Shingles whose texts are one part already drop out by an aggregate; a
    filter of those left, of bounded size, keeps the others from being dealt
    out again.
    """
    spark = texts.sparkSession
    rare = texts.mapInArrow(_rarest_of(k, _counts(marked), least),
                            "node binary, n bigint, last struct<seen:bigint,key:bigint>, rare array<bigint>").where("n > 0")
    # the lists, a fifth of all shingles, meet their labels once; what follows reads them where they were written
    parted = stored(rare.join(named.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
                    .select("node", "n", "last", "rare", F.xxhash64(F.coalesce("component", "node")).alias("part")), "rare")
    label = parted.select(F.explode("rare").alias("bucket"), F.col("part").alias("label"))
    open_ = stored(label.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
                   .where("low <> high").select("bucket"), "open")
    filters = spark.sparkContext.broadcast(build_filters(open_.select(F.lit(0).alias("length"), F.col("bucket").alias("hash")),
                                                         _FILTER_BYTES))
    likely = parted.mapInArrow(_shared_only(filters), "node binary, n bigint, last struct<seen:bigint,key:bigint>, "
                               "part bigint, bucket bigint, tail bigint, after bigint")
    share = F.lit(least / (1 + least))
    # where the smaller text of a pair can have the first common shingle: after p others, over least * p of its prefix follow
    first = ((F.col("tail") >= share * 2 * F.col("n") - F.lit(_SLACK))
             & (F.col("after") > F.lit(least) * (F.col("n") - F.col("tail")) - F.lit(4 * _SLACK)))
    begun = stored(likely.where(first).select("bucket").distinct().join(open_, "bucket", "left_semi"), "begun")
    live = stored(likely.join(begun, "bucket", "left_semi").distinct(), "rare-open")
    forget(parted, open_, begun)
    other = live.select("bucket", *[F.col(c).alias(f"{c}_g") for c in ("node", "n", "last", "part", "tail", "after")])
    smaller = live.where(first)
    ordered = (F.col("n") < F.col("n_g")) | ((F.col("n") == F.col("n_g")) & (F.col("node") < F.col("node_g")))
    needed = share * (F.col("n") + F.col("n_g")) - F.lit(_SLACK)
    # what both texts have behind their prefixes; a prefix is as long as its text's size says
    rest = [F.ceil(F.col(n) * F.lit(least) - F.lit(_SLACK)) - 1 for n in ("n", "n_g")]
    rest = F.when(F.col("last") <= F.col("last_g"), rest[0]).otherwise(rest[1])
    met = smaller.join(other, "bucket").where(
        ordered & (F.col("part") != F.col("part_g")) & _alike("n", "n_g", least)
        & (F.least("tail", "tail_g") >= needed) & (F.least("after", "after_g") + rest >= needed))
    return met.select(F.least("node", "node_g").alias("a"), F.greatest("node", "node_g").alias("b")).distinct()


def _alike(a: str, b: str, least: float):
    """Sizes that allow the similarity at all."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(least)


def near_classes(docs: DataFrame, k: int = 5, least: float = 0.8, count: int = 24, length: int = 4,
                 all_pairs_to: int = 16) -> DataFrame:
    """Classes of near-duplicate documents.

    Returns ``doc_id, key, class_id, class_size, links, kept``, one row per
    input row.  Two texts are near duplicates when their aligned ``k``-word
    shingles are at least ``least`` of all (see ``similarity``); classes are
    the connected components.  ``class_id`` is the smallest doc_id of the class
    (null only if it has no other), ``links`` the verified pairs the row's text
    is in, and ``kept`` marks the rows of the smallest ``(doc_id, key)``, null
    ids last.  ``key`` is the digest of the text.  Equal texts are one class
    without any pairs; null and blank texts are near duplicates of each other
    only; rows equal in id and text are ``kept`` alike.  Empty table: empty.

    The classes are exact: sketches find most links cheaply, then ``_unmet``
    names every other pair of unequal parts that can be near duplicates, and all
    of those are verified.

    A text has ``count`` sketches of ``length`` shingles; pairs that share three
    are verified first.  Texts that share a sketch meet in its bucket.  A bucket
    of up to ``all_pairs_to`` compares all its pairs.  The texts of larger ones
    are compared with the leader of their largest bucket, the member that shares
    most buckets; while the members of a bucket are not yet one part, they meet
    a leader of another part, drawn anew each round, until a round's pairs
    hold hardly a link (texts around a common passage never become one part);
    ``_unmet`` comes to the others.  A round is linear in a bucket's size, and a
    pair's two texts are all a task holds.
    """
    key = F.unhex(F.md5(F.encode(text_of(), "UTF-8")))
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), key.alias("key"), text_of().alias("text"))
    made = stored(base.mapInArrow(_sketcher(k, count, length), _MARKED), "sketches")
    marked = made.where("chunk is null").select("doc_id", "key", "n", "marks")
    nodes = stored(marked.groupBy("key").agg(F.first("n").alias("n"), F.first("marks").alias("marks")), "nodes")
    spread = nodes.select(F.col("key").alias("node"), "n", F.posexplode("marks").alias("j", "mark"))
    spread = spread.select("node", "n", F.xxhash64("j", "mark").alias("bucket"))
    sizes = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = stored(spread.join(sizes, "bucket"), "buckets")
    central = met.groupBy("node").agg(F.sum("size").alias("degree"))
    large = stored(met.where(F.col("size") > all_pairs_to).join(central, "node"), "large-buckets")

    few = met.where(F.col("size") <= all_pairs_to).select("bucket", "node", "n")
    other = few.select("bucket", F.col("node").alias("b"), F.col("n").alias("n_b"))
    pairs = (few.join(other, "bucket").where((F.col("node") < F.col("b")) & _alike("n", "n_b", least))
             .select(F.col("node").alias("a"), "b"))
    leaders = large.groupBy("bucket").agg(F.max(F.struct("degree", "node", "n")).alias("lead"))
    # a text first meets one leader only; the buckets it shares with others come back while they are of several parts
    first = large.join(leaders, "bucket").groupBy("node").agg(
        F.max_by(F.struct("n", "lead"), F.struct("size", "lead.degree", "bucket")).alias("x"))
    first = first.select("node", "x.*").where((F.col("node") != F.col("lead.node")) & _alike("n", "lead.n", least))
    pairs = pairs.unionByName(first.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b")))
    texts = docs.select(key.alias("key"), text_of().alias("text"))
    links = stored(_verify(_three(pairs.distinct(), nodes), texts, k, least), "links")
    blank = nodes.where(F.col("n") == 0).select("key")
    blank = blank.join(F.broadcast(blank.agg(F.min("key").alias("b"))), F.col("key") != F.col("b")).select(
        F.col("key").alias("a"), "b", F.lit(1.0).alias("similarity"))
    links = links.unionByName(blank)

    named = components(links)
    part = stored(large.join(named.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select(
        "bucket", "node", "n", F.coalesce("component", "node").alias("part")), "parts")
    # the rounds read the texts of large buckets only, written once
    inside = stored(_texts_of(texts, part.select(F.col("node").alias("key"))), "large-texts")
    turn = 0
    while True:
        # buckets whose members are not one part yet draw a leader, another one each round
        drawn = F.max(F.struct(F.xxhash64(F.lit(turn), "bucket", "node").alias("draw"), "node", "n", "part"))
        others = (part.groupBy("bucket").agg(drawn.alias("lead"), F.min("part").alias("low"), F.max("part").alias("high"))
                  .where("low <> high").select("bucket", "lead"))
        others = stored(others, "leaders")
        pairs = _with_leader(part, others, least, F.col("part") != F.col("lead.part"))
        tried = _three(pairs.distinct(), nodes)
        new = stored(_verify(tried, inside, k, least), "links")
        found = new.count()
        if not found:
            break
        links = links.unionByName(new)
        merged = components(_between_parts(new, part.select("node", "part").distinct()))
        open_ = part.join(others.select("bucket").distinct(), "bucket", "left_semi")
        part = stored(_renamed(open_, merged, "part"), "parts")
        named = _relabelled(named, merged)
        if found < _YIELD * tried.count():
            break
        turn += 1
    forget(inside)
    new = stored(_verify(stored(_unmet(texts, made, named, k, least), "candidates"), texts, k, least), "links")
    if new.limit(1).count():
        links = links.unionByName(new)
        of = nodes.select(F.col("key").alias("node")).join(named, "node", "left").select(
            "node", F.coalesce("component", "node").alias("part"))
        named = _relabelled(named, components(_between_parts(new, of)))
    return _classes(marked, named, links)


def _between_parts(links: DataFrame, of: DataFrame) -> DataFrame:
    """The links as edges between the parts their two texts are in, ``node, part``."""
    return (links.join(of.select(F.col("node").alias("a"), F.col("part").alias("pa")), "a")
            .join(of.select(F.col("node").alias("b"), F.col("part").alias("pb")), "b")
            .select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct())


def _renamed(rows: DataFrame, merged: DataFrame, col: str) -> DataFrame:
    """Rows whose part ``col`` has been merged into another carry that one's name."""
    to = merged.select(F.col("node").alias(col), F.col("component").alias("_to"))
    return rows.join(to, col, "left").withColumn(col, F.coalesce("_to", col)).select(*rows.columns)


def _relabelled(named: DataFrame, merged: DataFrame) -> DataFrame:
    """Labels after parts have merged; texts that had no link before come in."""
    alone = merged.join(named, "node", "left_anti").select("node", "component")
    return stored(_renamed(named, merged, "component").unionByName(alone), "labels")


def _with_leader(members: DataFrame, leaders: DataFrame, least: float, also=None) -> DataFrame:
    """Pairs of a bucket's leader and its other members of like size."""
    met = members.join(leaders, "bucket").where(
        (F.col("node") != F.col("lead.node")) & _alike("n", "lead.n", least))
    met = met if also is None else met.where(also)
    return met.select(F.least("node", "lead.node").alias("a"), F.greatest("node", "lead.node").alias("b"))


def _three(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs that share three sketches, before any text is read; ``_unmet`` comes back to the others."""
    marks = nodes.select("key", "marks")
    alike = F.size(F.filter(F.zip_with("marks_a", "marks_b", lambda x, y: x == y), lambda same: same))
    return stored(pairs.join(marks.select(F.col("key").alias("a"), F.col("marks").alias("marks_a")), "a")
                  .join(marks.select(F.col("key").alias("b"), F.col("marks").alias("marks_b")), "b")
                  .where(alike >= 3).select("a", "b"), "candidates")


def _verify(pairs: DataFrame, texts: DataFrame, k: int, least: float) -> DataFrame:
    """The pairs whose aligned similarity is at least ``least``."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("key"))
    read = _texts_of(texts, named)
    both = (pairs.join(read.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
            .join(read.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"))
    return both.mapInArrow(_verifier(k, least), "a binary, b binary, similarity double").where(
        F.col("similarity") >= F.lit(least))


def _texts_of(texts: DataFrame, named: DataFrame) -> DataFrame:
    """The texts of the named keys, each once.  Up to ``_FEW`` names are broadcast, so that the other texts stay where
    they are."""
    hashed = named.select(F.xxhash64("key").alias("h")).distinct()
    few = F.broadcast(hashed) if hashed.limit(_FEW + 1).count() <= _FEW else hashed
    return texts.withColumn("h", F.xxhash64("key")).join(few, "h", "left_semi").dropDuplicates(["key"]).select("key", "text")


def _classes(marked: DataFrame, named: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with their class; a class is pre-aggregated over its rows."""
    degree = (links.select(F.explode(F.array("a", "b")).alias("node"), F.struct("a", "b").alias("pair"))
              .distinct().groupBy("node").agg(F.count(F.lit(1)).alias("links")))
    known = named.join(degree, "node").withColumnRenamed("node", "key")
    rows = marked.select("doc_id", "key").join(known, "key", "left").select(
        "doc_id", "key", F.coalesce("component", "key").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    heads = rows.groupBy("component").agg(F.min(place).alias("head"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(heads, "component").select(
        "doc_id", "key", F.col("head.doc_id").alias("class_id"), "class_size", "links",
        (place == F.col("head")).alias("kept"))


def keep_one(docs: DataFrame, **params) -> DataFrame:
    """The documents with one row of each near-duplicate class, all columns as they were.

    The kept row is the class's smallest id; rows equal to it in id and text
    give one row.
    """
    classes = near_classes(docs, **params)
    heads = classes.where("kept").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("_rows"))
    heads = stored(heads.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_rows"), "heads")
    key = F.unhex(F.md5(F.encode(F.coalesce(docs["text"].cast("string"), F.lit("")), "UTF-8")))
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col("_id")) & (key == F.col("_key"))
    kept = docs.join(heads, same)
    once = kept.where("_rows = 1").select(*docs.columns)
    again = kept.where("_rows > 1").dropDuplicates(["_id", "_key"]).select(*docs.columns)
    return once.unionByName(again)
