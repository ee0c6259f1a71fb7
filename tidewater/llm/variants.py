"""Spelling variants: words one edit apart, found by generated edits and broadcast Bloom filters."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stored

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_LONGEST = 64  # words of this many letters and more share a filter shard
_CHUNK = 8192  # filter words of 64 bits that travel together
_CELLS = 1 << 20  # letters probed at a time
_HELD = 400_000  # words a task counts before it hands them on

#: One byte a code point: letters stay (A-Z lower-cased), all else is a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """Maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _counter(modulus: int, least: int):
    """Words of the texts with their occurrences; one letter is dropped where ``modulus`` divides the hash."""
    def table(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                           pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                start = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                for word, n in Counter(runs(text.as_py())).items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if h % modulus == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= least:
                        total[word] += n
                if len(total) > _HELD:
                    yield table(total)
                    total = Counter()
        if total:
            yield table(total)

    return run


def vocabulary(docs: DataFrame, modulus: int = 97, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """``word, n`` of the texts' words (runs of Latin letters) with at least so many letters and occurrences.

    Where ``modulus`` divides the CRC-32 of ``<doc_id>:<word>``, the word loses
    its letter number CRC-32 mod its length.  Null texts have no words; a null
    id is an empty text in the hash.  Words are summed in the tasks before they
    shuffle.
    """
    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("string").alias("doc_id"),
                                                         F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_counter(modulus, least_length), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- hashes of words and of their edits -----------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def _letter(at: np.ndarray, code: np.ndarray) -> np.ndarray:
    """A value of a letter at a place; a word's hash is drawn from their sum, so an edit changes few terms."""
    return _mix(at.astype(np.uint64) * _A + code.astype(np.uint64) * _B + _C)


def _final(total: np.ndarray, length: int) -> np.ndarray:
    return _mix(total + np.full(1, length, np.uint64) * _A)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row a word."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1)


def word_hashes(words: list[str]) -> np.ndarray:
    out = np.empty(len(words), np.uint64)
    for length, at in _by_length(words).items():
        for part in _pieces(at, length):
            codes = _codes([words[i] for i in part])
            out[part] = _final(_letter(np.arange(length), codes).sum(axis=1, dtype=np.uint64), length)
    return out


def _by_length(words: list[str]) -> dict[int, list[int]]:
    found = defaultdict(list)
    for i, w in enumerate(words):
        found[len(w)].append(i)
    return found


def _pieces(at: list[int], length: int) -> Iterator[np.ndarray]:
    step = max(1, _CELLS // max(length, 1))
    for i in range(0, len(at), step):
        yield np.array(at[i:i + step])


def edits(codes: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, row, hash)`` of the words' edits: every deletion, and every letter replaced by a smaller one.

    Insertions are the deletions of the longer word, and of two words that
    differ in one letter one has the smaller, so these name each pair once.
    Equal deletions (of neighbouring equal letters) are named once.
    """
    count, length = codes.shape
    places = np.arange(length)
    here = _letter(places, codes)
    total = here.sum(axis=1, dtype=np.uint64)
    before = np.cumsum(here, axis=1, dtype=np.uint64) - here
    moved = np.zeros_like(here)
    moved[:, 1:] = _letter(places[:-1], codes[:, 1:])
    after = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
    once = np.ones(codes.shape, bool)
    once[:, :-1] = codes[:, 1:] != codes[:, :-1]
    row, at = np.nonzero(once)
    yield length - 1, row, _final(before[row, at] + after[row, at], length - 1)
    rest = total[:, None] - here
    for symbol in alphabet:
        row, at = np.nonzero(codes > symbol)
        if len(row):
            yield length, row, _final(rest[row, at] + _letter(places, np.full(length, symbol))[at], length)


# ---- blocked Bloom filters, one shard a length ------------------------------------

class Filters:
    """Blocked Bloom filters in one array: a block is 64 bits, a word sets four of one block.

    ``offsets[s]`` and ``slots[s]`` place the shard of length ``s`` (the last
    one holds all longer words); a shard's slots are a power of two.
    """

    def __init__(self, bits: np.ndarray, offsets: np.ndarray, slots: np.ndarray):
        self.bits, self.offsets, self.slots = bits, offsets, slots

    def holds(self, length: int, hashes: np.ndarray) -> np.ndarray:
        shard = min(length, _LONGEST)
        if not self.slots[shard]:
            return np.zeros(len(hashes), bool)
        block = self.bits[self.offsets[shard] + (hashes & np.uint64(self.slots[shard] - 1)).astype(np.int64)]
        mask = np.zeros(len(hashes), np.uint64)
        for shift in (40, 46, 52, 58):
            mask |= np.uint64(1) << ((hashes >> np.uint64(shift)) & np.uint64(63))
        return (block & mask) == mask


def plan_shards(words: dict[int, int], filter_bytes: int, bits_per_word: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and slots a shard; ``filter_bytes`` bounds their sum, whatever the vocabulary."""
    slots = np.zeros(_LONGEST + 1, np.int64)
    for shard, n in words.items():
        slots[shard] = 1 << max(0, int(n * bits_per_word / 64 - 1).bit_length())
    while slots.sum() * 8 > max(filter_bytes, 8 * (_LONGEST + 1)):
        slots[slots.argmax()] //= 2
    return np.concatenate([[0], np.cumsum(slots)[:-1]]), slots


def build_filters(known: DataFrame, filter_bytes: int) -> Filters:
    """Filters of ``known`` (``length, hash``), built by the executors; the driver gets at most ``filter_bytes``."""
    spark = known.sparkSession
    shard = F.least(F.col("length"), F.lit(_LONGEST)).cast("int")
    sizes = {r.shard: r["count"] for r in known.groupBy(shard.alias("shard")).count().collect()}  # 65 rows at most
    offsets, slots = plan_shards(sizes, filter_bytes)
    bits = np.zeros(int(slots.sum()), np.uint64)
    places = spark.createDataFrame([(i, int(offsets[i]), int(slots[i])) for i in range(_LONGEST + 1)],
                                   "shard int, offset bigint, slots bigint")
    bit = "shiftleft(1L, cast(shiftrightunsigned(hash, {0}) & 63 as int))"
    blocks = (known.select(shard.alias("shard"), "hash").join(F.broadcast(places), "shard")
              .select(F.expr("offset + (hash & (slots - 1))").alias("slot"),
                      F.expr(" | ".join(bit.format(s) for s in (40, 46, 52, 58))).alias("mask"))
              .groupBy("slot").agg(F.bit_or("mask").alias("mask")))

    def pack(part: pa.Table) -> pa.Table:
        chunk = part.column("chunk")[0].as_py()
        held = np.zeros(_CHUNK, np.int64)
        held[part.column("slot").to_numpy() - chunk * _CHUNK] = part.column("mask").to_numpy()
        return pa.table({"chunk": pa.array([chunk], pa.int64()), "bits": pa.array([held.tobytes()], pa.binary())})

    packed = blocks.withColumn("chunk", F.expr(f"slot div {_CHUNK}")).groupBy("chunk").applyInArrow(
        pack, "chunk bigint, bits binary")
    for r in packed.toLocalIterator():
        at = r.chunk * _CHUNK
        part = np.frombuffer(r.bits, np.uint64)[:len(bits) - at]
        bits[at:at + len(part)] = part
    return Filters(bits, offsets, slots)


# ---- near words and forms ----------------------------------------------------------

def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), pa.array([len(w) for w in words], pa.int32()),
             pa.array(word_hashes(words).view(np.int64))], names=["word", "n", "length", "hash"])


def _prober(filters: Broadcast, alphabet: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = filters.value
        for batch in batches:
            words = batch.column("word").to_pylist()
            own = batch.column("hash").to_numpy()
            for length, rows in _by_length(words).items():
                for part in _pieces(rows, length):
                    for edited, row, found in edits(_codes([words[i] for i in part]), alphabet):
                        there = held.holds(edited, found)
                        if there.any():
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[part[row[there]]]), pa.array(found[there].view(np.int64))],
                                names=["source", "edit"])

    return run


def near_words(words: DataFrame, filter_bytes: int = 64 << 20) -> DataFrame:
    """Pairs of words one insertion, deletion or replacement of a code point apart, each once: ``a, n_a, b, n_b``.

    ``words`` has distinct ``word`` and ``n``.  Each task generates its words'
    edits as hashes and probes the broadcast filters, whose size ``filter_bytes``
    bounds; a fuller filter only lets more false positives through.  Those that
    a filter holds, and no others, shuffle to the vocabulary, whose equal hashes
    give the words back; the edit distance itself decides.
    """
    spark = words.sparkSession
    known = stored(words.select("word", F.col("n").cast("bigint").alias("n"))
                   .mapInArrow(_hasher, "word string, n bigint, length int, hash bigint"), "vocabulary")
    # every code point a word holds, at most as many as Unicode has
    symbols = known.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().where("c <> ''").collect()
    alphabet = np.array(sorted(ord(r.c) for r in symbols), np.uint32)
    filters = spark.sparkContext.broadcast(build_filters(known, filter_bytes))
    hits = stored(known.select("word", "hash").mapInArrow(_prober(filters, alphabet), "source bigint, edit bigint"), "edits")
    filters.unpersist()
    a = known.select(F.col("hash").alias("source"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = known.select(F.col("hash").alias("edit"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    pairs = hits.join(b, "edit").join(a, "source").where(F.levenshtein("a", "b", 1) == 1)
    return pairs.select("a", "n_a", "b", "n_b").distinct()


def spelling_forms(words: DataFrame, ratio: int = 2, filter_bytes: int = 64 << 20) -> DataFrame:
    """The commoner spelling of each word: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code-point
    order) if that is at least ``ratio`` times the word's, else null; ``root``
    is the last form reached from the word by following forms, the word itself
    if it has none.  ``n_near`` counts the near words.  An empty table gives an
    empty result.
    """
    words = stored(words, "words")
    pairs = stored(near_words(words, filter_bytes), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("x"))
    leads = F.col("x.less") * -1 >= F.col("n") * ratio
    forms = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(leads, F.col("x.near")).alias("form"),
        F.when(leads, -F.col("x.less")).alias("form_n")), "forms")
    # each step doubles how far a word looks ahead; n doubles along a chain, so a few steps reach its end
    ahead = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(ahead.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ahead = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            break
    return forms.join(ahead, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
