"""Exact top-k search in binary codes by multi-index hashing in shards of the codes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DataType, IntegerType, LongType, StructType

from tidewater.llm.common import forget, stored

BITS = 64
#: Most masks of one segment.
MOST_MASKS = 1 << 18
#: Most codes of a shard; fewer than the least are not parted for more cores.
MOST_CODES, LEAST_CODES = 1 << 21, 1 << 12
#: Most queries that are searched in a shard at a time, and rows held for them.
MOST_QUERIES, MOST_HELD = 1 << 17, 1 << 22
#: Radius of the pass that finds a bound for each query.
FIRST_RADIUS = 1
#: Pairs compared at a time; found ones gathered before they are cut.
_BLOCK, _GATHERED = 1 << 16, 1 << 20
#: Nanoseconds that a pair, a mask or query looked up for a bucket, and a bucket take.
_PAIR, _LOOKUP, _BUCKET = 1.2, 12, 20_000
#: Layout of a found row in 64 bits: query, distance, position in the shard.
_QUERY_AT, _DISTANCE_AT = 39, 32

#: Of a number of segments and queries' bounds: the radius that segment ``j`` needs for each, below 0 for none.
Radius = Callable[[np.ndarray, int, int], np.ndarray]


def sign_code(vector: Column) -> Column:
    """64-bit code of the signs of a vector of up to 64 numbers; missing ones count as not positive.

    A longer vector does not fit and raises: distances of its first numbers
    would not be those of the vector.
    """
    def add(code: Column, i: Column) -> Column:
        one = F.when(F.get(vector, i) > 0, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        # shiftleft by a column, written as SQL has it
        return code.bitwiseOR(F.call_function("shiftleft", one, i))

    folded = F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"), add)
    wide = F.raise_error(F.concat(F.lit(f"a code has {BITS} bits, a vector has "), F.size(vector).cast("string")))
    return F.when(F.size(vector) > BITS, wide.cast("bigint")).when(vector.isNotNull(), folded)


def _cuts(parts: int) -> list[tuple[int, int]]:
    """First bit and width of each of ``parts`` segments; none: one of no bits, in which all codes agree."""
    ends = [BITS * j // parts for j in range(parts + 1)] if parts else [0, 0]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _least_radius(bounds: np.ndarray, parts: int, j: int) -> np.ndarray:
    """Radii with which some segment meets every code within the bound.

    A code that no segment meets differs in over the radius in each, so
    in as many bits as the radii + 1 sum up to, here ``bound + 1``.
    """
    return (bounds + parts - j) // parts - 1 if parts else np.zeros_like(bounds)


def _first_radius(bounds: np.ndarray, parts: int, j: int) -> np.ndarray:
    return np.full_like(bounds, FIRST_RADIUS)


def _masks(width: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of up to ``radius`` of ``width`` bits, those of fewer first, and how many each has."""
    values = np.arange(1 << width, dtype=np.int64)
    bits = np.bitwise_count(values)
    first = np.argsort(bits, kind="stable")[:_ball(width, radius)]
    return values[first], bits[first].astype(np.int64)


def _ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(min(width, radius) + 1))


def _segment(codes: np.ndarray, first: int, width: int) -> np.ndarray:
    return (codes >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)


def _best_parts(codes: np.ndarray, asked: np.ndarray, bounds: np.ndarray, radius: Radius, most_masks: int) -> int:
    """Number of segments that should take the least time; 0: compare all pairs.

    Codes and queries that crowd in the same segment values meet the more often for it.
    """
    best, least = 0, len(codes) * len(asked) * _PAIR
    values, times = np.unique(bounds, return_counts=True)
    for parts in range(4, 11):  # tables of wider segments would be large
        cost = 0.0
        for j, (first, width) in enumerate(_cuts(parts)):
            radii = radius(values, parts, j)
            masks = _ball(width, int(radii.max()))
            if masks > most_masks or cost >= least:
                cost = math.inf
                break
            of_code, of_query = (np.bincount(_segment(x, first, width), minlength=1 << width) for x in (codes, asked))
            crowd = max(1.0, float(of_code @ of_query) * (1 << width) / len(codes) / len(asked))
            met = sum(int(n) * _ball(width, int(r)) for n, r in zip(times, radii)) / (1 << width)
            cost += (np.count_nonzero(of_code) * (_BUCKET + (masks + met) * _LOOKUP)
                     + len(codes) * min(len(asked), met * crowd) * _PAIR)
        if cost < least:
            best, least = parts, cost
    return best


def _nearest(found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each query the ``k`` least found rows, each once, and the k-th where there is one."""
    found = np.sort(found)
    found = found[np.diff(found, prepend=~found[:1]) != 0]
    query = found >> np.uint64(_QUERY_AT)
    begins = np.flatnonzero(np.diff(query, prepend=~query[:1]))
    nth = np.arange(len(found)) - np.repeat(begins, np.diff(begins, append=len(found)))
    return found[nth < k], found[nth == k - 1]


def _search(codes: np.ndarray, asked: np.ndarray, own: tuple[np.ndarray, np.ndarray], bounds: np.ndarray, k: int,
            radius: Radius, parts: int) -> np.ndarray:
    """The up to ``k`` nearest of ``codes`` within the bound of each of ``asked``, by distance and position, packed.

    ``own`` are the positions, from and to, that a query leaves out; ``parts``
    is the number of segments, 0 to compare all pairs.  The codes of one
    segment value are compared at once with all queries that have it in their
    radius, so no two are compared more than once a segment.
    """
    held, fresh, size, most = np.zeros(0, np.uint64), [], 0, _GATHERED
    if not len(codes):
        return held
    caps = bounds.astype(np.uint8)  # go down to the distance of the k-th row held
    xor, count, near = np.empty(_BLOCK, np.uint64), np.empty(_BLOCK, np.uint8), np.empty(_BLOCK, bool)
    for j, (first, width) in enumerate(_cuts(parts)):
        reach = radius(bounds, parts, j)
        if reach.max() < 0:
            continue
        masks, layers = _masks(width, int(reach.max()))
        values = _segment(asked, first, width)
        by_value = np.argsort(values, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << width))])
        sought, reach = asked[by_value], reach[by_value]
        segment = _segment(codes, first, width)
        place = np.argsort(segment, kind="stable")
        segment, listed = segment[place], codes[place]
        starts = np.flatnonzero(np.diff(segment, prepend=-1)).tolist()
        for start, end in zip(starts, [*starts[1:], len(codes)]):
            probed = masks ^ segment[start]
            begin = offsets[probed]
            many = offsets[probed + 1] - begin
            upto = np.cumsum(many)
            met = np.arange(upto[-1]) + np.repeat(begin - (upto - many), many)
            met = met[reach[met] >= np.repeat(layers, many)]
            for left in range(0, len(met), _BLOCK):
                some = met[left:left + _BLOCK]
                code, asking, wide = sought[some], by_value[some], len(some)
                cap = caps[asking]
                for top in range(start, end, step := _BLOCK // wide):
                    rows = listed[top:min(top + step, end), None]
                    shape, n = (len(rows), wide), len(rows) * wide
                    np.bitwise_xor(rows, code, out=xor[:n].reshape(shape))
                    np.bitwise_count(xor[:n], out=count[:n])
                    np.less_equal(count[:n].reshape(shape), cap, out=near[:n].reshape(shape))
                    hit = np.flatnonzero(near[:n])
                    if not len(hit):
                        continue
                    row, column = np.divmod(hit, wide)
                    who, at = asking[column], place[top + row]
                    other = (at < own[0][who]) | (at >= own[1][who])
                    packed = who << _QUERY_AT | count[hit].astype(np.int64) << _DISTANCE_AT | at
                    fresh.append(packed[other].view(np.uint64))
                    size += len(fresh[-1])
                    if size > most:
                        held, last = _nearest(np.concatenate([held, *fresh]), k)
                        caps[last >> np.uint64(_QUERY_AT)] = last >> np.uint64(_DISTANCE_AT) & np.uint64(127)
                        cap = caps[asking]
                        fresh, size, most = [], 0, max(_GATHERED, len(held))
    return _nearest(np.concatenate([held, *fresh]), k)[0]


def _searcher(k: int, radius: Radius, most_masks: int, bound_only: bool) -> Callable:
    """Arrow function over shards, each the rows of its codes and then of the queries (see ``_deal``)."""
    at_a_time = max(1, min(MOST_QUERIES, MOST_HELD // max(1, k)))

    def answers(codes: pa.Table, queries: pa.Table) -> Iterator[pa.RecordBatch]:
        asked, ids, rows = queries["code"].to_numpy(), queries["id"].combine_chunks(), codes["code"].to_numpy()
        # rows of one id stand together
        runs = codes["id"].combine_chunks().dictionary_encode()
        begins = np.searchsorted(runs.indices.to_numpy(), np.arange(len(runs.dictionary) + 1))
        run = pc.fill_null(pc.index_in(ids, value_set=runs.dictionary), -1).to_numpy()
        own = tuple(np.where(run < 0, 0, begins[np.minimum(run + i, len(begins) - 1)]) for i in (0, 1))
        bounds = queries["bound"].to_numpy().astype(np.int64)
        given = rows.view(np.uint64), asked.view(np.uint64)
        parts = _best_parts(*given, bounds, radius, most_masks)
        # all pairs are left to the second pass, which would compare them again
        found = _search(*given, own, bounds, k, radius, parts) if parts or not bound_only else np.zeros(0, np.uint64)
        query = (found >> np.uint64(_QUERY_AT)).astype(np.int64)
        distance = (found >> np.uint64(_DISTANCE_AT) & np.uint64(127)).astype(np.int32)
        if bound_only:
            ends = np.searchsorted(query, np.arange(len(asked) + 1)).astype(np.int32)
            near = pa.ListArray.from_arrays(pa.array(ends), pa.array(distance.astype(np.int8)))
            out = pa.table({"id": ids, "code": asked, "near": near})
        else:
            at = (found & np.uint64((1 << _DISTANCE_AT) - 1)).astype(np.int64)
            out = pa.table({"query_id": ids.take(pa.array(query)), "q": asked[query],
                            "id": codes["id"].take(pa.array(at)), "distance": distance, "code": rows[at]})
        yield from out.to_batches(max_chunksize=_BLOCK)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, codes, parts, queries, waiting = None, None, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if queries:
                yield from answers(codes, pa.Table.from_batches(queries))

        for batch in batches:
            at = batch["at"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a).select(["id", "code", "bound"])
                if at[a] // 2 != shard:
                    yield from flush()
                    shard, codes, parts, queries, waiting = at[a] // 2, None, [], [], 0
                if at[a] % 2 == 0:
                    parts.append(part)
                    continue
                if codes is None:
                    # in the order in which ties are broken, so a position stands for its id and code
                    codes = pa.Table.from_batches(parts, part.schema).select(["id", "code"]).sort_by(
                        [("id", "ascending"), ("code", "ascending")]).combine_chunks()
                    parts = []
                queries.append(part)
                waiting += len(part)
                if waiting >= at_a_time:
                    yield from flush()
                    queries, waiting = [], 0
        yield from flush()

    return run


def _deal(members: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """Codes dealt into ``shards`` partitions by a hash, each with all queries behind them: ``at, id, code, bound``."""
    hashed = F.pmod(F.xxhash64("code"), F.lit(shards)).cast("int")
    rows = members.select((hashed * 2).alias("at"), "id", "code", F.lit(BITS).alias("bound"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    return (rows.unionByName(asked.select(every.alias("shard"), "id", "code", "bound")
                             .select((F.col("shard") * 2 + 1).alias("at"), "id", "code", "bound"))
            .repartitionById(shards, F.shiftright("at", 1)).sortWithinPartitions("at"))


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, most_masks: int = MOST_MASKS) -> DataFrame:
    """The ``k`` nearest rows of each query row by Hamming distance, exactly.

    ``codes`` and ``queries`` have ``id, code`` (64 bits).  Returns ``query_id,
    neighbor_id, distance, rank``; ties go to the smaller id, and a row is not
    its own neighbour (an id repeated with other codes is one row per code;
    pairs of one id are left out).  Rows with a null id or code are not
    searched and ask nothing.  Fewer than ``k`` rows: all of them.  Empty
    table: empty.

    Equal codes are met once: of a code only the ``k + 1`` smallest ids can be
    among the results, found by a window that is cut to that length before the
    shuffle.  These rows are dealt by a hash of the code into shards of about
    ``MOST_CODES`` at most, and every query is searched in every shard, twice.
    First among the codes of which a segment differs in up to ``FIRST_RADIUS``
    bits from its own: the k-th distance that all shards have found together
    bounds the true one.  Then at radii that meet every code within that bound,
    as a code that no segment meets is farther.  A shard cuts its codes into as
    many segments as should take the least time; where looking up masks does
    not pay, or they are over ``most_masks``, it compares all pairs, in the
    second pass only.  Pairs are compared in blocks and become rows only as
    results, at most ``k`` a query and shard.  Each pass is written to the
    checkpoint folder; the driver sees one count.
    """
    known = codes.where(F.col("id").isNotNull() & F.col("code").isNotNull()).select("id", "code").distinct()
    first = Window.partitionBy("code").orderBy("id")
    members = stored(known.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).drop("nth"),
                     "members")
    asked = queries.where(F.col("id").isNotNull() & F.col("code").isNotNull()).select("id", "code").distinct()
    asked = stored(asked.withColumn("bound", F.lit(BITS)), "queries")
    number = members.count()
    few = max(1, min(codes.sparkSession.sparkContext.defaultParallelism, math.ceil(number / LEAST_CODES)))
    shards = few * max(1, math.ceil(number / (few * MOST_CODES)))

    kind: DataType = members.unionByName(asked.drop("bound")).schema["id"].dataType
    lists = StructType().add("id", kind).add("code", LongType()).add("near", ArrayType(ByteType()))
    near = _deal(members, asked, shards).mapInArrow(_searcher(k, _first_radius, most_masks, True), lists)
    kth = F.get(F.sort_array(F.flatten(F.collect_list("near"))), F.lit(k - 1))
    bounded = stored(near.groupBy("id", "code").agg(F.coalesce(kth.cast("int"), F.lit(BITS)).alias("bound")), "bounds")
    rows = (StructType().add("query_id", kind).add("q", LongType()).add("id", kind).add("distance", IntegerType())
            .add("code", LongType()))
    found = stored(_deal(members, bounded, shards).mapInArrow(_searcher(k, _least_radius, most_masks, False), rows),
                   "nearest")
    forget(members, asked, bounded)
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("distance", "id", "code"))
    return (found.select("query_id", F.col("id").alias("neighbor_id"), "distance", rank.alias("rank"))
            .where(F.col("rank") <= k))
