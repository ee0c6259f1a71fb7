"""Ranked lexical search with a K2-treap over the grid of terms and documents."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import settings, stored, text_of

#: Bytes of UTF-8 as terms are made of them: digits and letters, A-Z lower-cased, and all beyond ASCII; others are a space.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_STEP = 4096  # inner cells hold their maximum in these units, rounded up, in a byte; an impact is at most 10**6
_POPCOUNT = np.array([bin(i).count("1") for i in range(16)], np.uint8)
_QUERY_BYTES = 8 << 20  # texts of the items searched together
_AT_ONCE = 64  # document ranges of an item that are split together
_TOGETHER = 50  # items whose ranges are held at a time
_STRETCH = 6  # empty bits under a row's number: rows part this many levels ahead of documents
#: Rows are whole texts or whole shards: few are held at a time, whatever they weigh.
_FEW_TEXTS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}
_FEW_SHARDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "4"}
_SHARD_FILES = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1",
                "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}
_SCHEMA = ("doc_ids array<bigint>, lengths binary, terms binary, df binary, levels array<bigint>, masks binary, "
           "peaks binary, tf binary, large_at binary, large binary")


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text's UTF-8 bytes."""
    return text.translate(_BYTES).split()


def impacts(tf: np.ndarray, length: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What an occurrence count adds to a score, before the term's weight."""
    m = 75 + (25 * length * docs) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# ---- the tree of one shard -------------------------------------------------------

def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of a 32-bit number at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def height_of(rows: int, columns: int) -> int:
    """Levels of the grid.  Rows are spread out, so a node of many documents already stands for few terms:
    its peak says more about the term that is asked for."""
    return max((rows - 1).bit_length() + _STRETCH, (columns - 1).bit_length())


def build_tree(row: np.ndarray, column: np.ndarray, impact: np.ndarray, height: int):
    """Quadtree over the occupied cells of a square grid of ``2 ** height``.

    Returns ``order, masks, peaks, levels``: the cells in tree order, and for
    every inner node, breadth first, which of its four quarters hold cells and
    the largest impact below it.  Empty quarters have no node.
    """
    code = (_spread(row) << np.uint64(1)) | _spread(column)
    order = np.argsort(code, kind="stable")
    code, peak = code[order], impact[order]
    masks, peaks = [], []
    for _ in range(height):
        quarter = np.left_shift(1, (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
        above = code >> np.uint64(2)
        start = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
        masks.append(np.bitwise_or.reduceat(quarter, start))
        peak = np.maximum.reduceat(peak, start)
        peaks.append((-(-peak // _STEP)).astype(np.uint8))
        code = above[start]
    return order, np.concatenate(masks[::-1]), np.concatenate(peaks[::-1]), [len(m) for m in masks[::-1]]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with a term, and their terms."""
    for batch in batches:
        n = [len(terms_of(cell.as_py())) for cell in batch.column("text")]
        yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())],
                                         names=["docs", "terms"])


def _indexer(docs: int, terms: int, docs_per_shard: int, terms_per_shard: int):
    """Shards of consecutive documents of a partition, each with its tree."""
    def shard(rows: list, vocabulary: dict) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
        length = np.array([r[3] for r in rows], np.int64)
        sizes = np.array([len(r[1]) for r in rows])
        column = np.repeat(np.arange(len(rows)), sizes)
        term = np.concatenate([r[1] for r in rows])
        tf = np.concatenate([r[2] for r in rows]).astype(np.int64)
        df = np.bincount(term, minlength=len(vocabulary))
        by_df = np.argsort(-df, kind="stable")  # common terms share the first rows, whose cells lie densely
        row_of = np.empty(len(vocabulary), np.int64)
        row_of[by_df] = np.arange(len(vocabulary))
        names = list(vocabulary)
        order, masks, peaks, levels = build_tree(row_of[term] << _STRETCH, column, impacts(tf, length[column], docs, terms),
                                                 height_of(len(names), len(rows)))
        tf = tf[order]
        large = np.flatnonzero(tf > 255)
        data = [[r[0] for r in rows], length.tobytes(), b"\n".join(names[i] for i in by_df),
                df[by_df].astype(np.int32).tobytes(), levels, masks.tobytes(), peaks.tobytes(),
                np.minimum(tf, 255).astype(np.uint8).tobytes(), large.tobytes(), tf[large].tobytes()]
        types = [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(data, types, strict=True)],
                                          names=[c.split()[0] for c in _SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        held = 0
        number: dict = defaultdict()
        number.default_factory = number.__len__
        for batch in batches:
            for doc_id, cell in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                found = terms_of(cell.as_py())
                if not found:
                    continue
                ids = np.fromiter(map(number.__getitem__, found), np.int32, len(found))
                kinds, counts = np.unique(ids, return_counts=True)
                rows.append((doc_id.as_py(), kinds, counts.astype(np.int32), len(found)))
                held += len(kinds)
                if len(rows) >= docs_per_shard or held >= terms_per_shard:
                    yield shard(rows, number)
                    rows, held = [], 0
                    number = defaultdict()
                    number.default_factory = number.__len__
        if rows:
            yield shard(rows, number)

    return run


@dataclass
class Index:
    """Shards of a corpus: ``docs`` texts with a term, ``terms`` terms in all."""

    shards: DataFrame
    docs: int
    terms: int


def build_index(docs: DataFrame, docs_per_shard: int = 1 << 12, terms_per_shard: int = 300_000) -> Index:
    """K2-treaps over all texts and all their terms, written as one row a shard.

    A shard is a run of documents of one input partition, so nothing shuffles;
    its rows are the shard's terms, its columns the documents by id (null last).
    Texts without a term are in no ranking and not in the index.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().cast("binary").alias("text"))
    with settings(docs.sparkSession, _FEW_TEXTS):
        size = rows.select("text").mapInArrow(_sizes, "docs bigint, terms bigint").agg(
            F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
        total, terms = size.docs or 0, size.terms or 0
        shards = rows.mapInArrow(_indexer(total, max(terms, 1), docs_per_shard, terms_per_shard), _SCHEMA)
        return Index(stored(shards, "term-index", **_SHARD_FILES), total, terms)


class Shard:
    """A shard's tree in memory."""

    def __init__(self, row: dict, docs: int, terms: int):
        self.doc_ids = row["doc_ids"]
        length = np.frombuffer(row["lengths"], np.int64)
        self.m12 = 12 * (75 + (25 * length * docs) // terms)
        self.masks = np.frombuffer(row["masks"], np.uint8)
        self.peaks = np.frombuffer(row["peaks"], np.uint8)
        self.height = len(row["levels"])
        self.first = np.ones(len(self.masks), np.int32)  # nodes are numbered breadth first, the cells after them
        np.cumsum(_POPCOUNT[self.masks[:-1]], out=self.first[1:])
        self.first[1:] += 1
        self.tf = np.frombuffer(row["tf"], np.uint8).astype(np.int32)
        self.tf[np.frombuffer(row["large_at"], np.int64)] = np.frombuffer(row["large"], np.int64)
        self.width = (len(self.doc_ids) - 1).bit_length()  # levels at which documents part

    def quarter(self, node: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the quarter holds cells, and its node."""
        mask = self.masks[node]
        return (mask >> which) & 1 == 1, self.first[node] + _POPCOUNT[mask & (np.left_shift(1, which) - 1)]


def _leading(group: np.ndarray, score: np.ndarray, column: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first of each group by score, then column, in that order."""
    order = np.lexsort((column, -score, group))
    sorted_group = group[order]
    start = np.r_[0, np.flatnonzero(sorted_group[1:] != sorted_group[:-1]) + 1] if len(order) else np.empty(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[rank < k]


def search_shard(shard: Shard, items: list[tuple[np.ndarray, np.ndarray]], floors: np.ndarray, k: int,
                 at_once: int = _AT_ONCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best documents of each item: ``item, column, score``.

    An item is the rows of its terms and their weights.  A state is a range of
    documents with, for each term that occurs in it, the node of the term's row
    path over that range; its bound is the sum of weight times peak.  The states
    of highest bound (then of smallest document) are halved, until no state can
    still hold one of the best.  ``floors`` are scores known to be reached by
    ``k`` documents elsewhere.
    """
    none = np.empty(0, np.int64)
    best = (none, none, none)
    if not items or not sum(len(r) for r, _ in items):
        return best
    h = shard.height
    owner = np.repeat(np.arange(len(items)), [len(r) for r, _ in items])
    row = np.concatenate([r for r, _ in items])
    gain = np.concatenate([w for _, w in items])
    node = np.zeros(len(row), np.int64)
    for level in range(h - shard.width):  # all documents are on one side: only the rows part
        node = shard.quarter(node, ((row >> (h - 1 - level)) & 1) << 1)[1]
    # states: item, level, first column, bound; entries: state, row, gain, node, by state
    item, state = np.unique(owner, return_inverse=True)
    level = np.full(len(item), h - shard.width)
    column = np.zeros(len(item), np.int64)
    bound = np.full(len(item), np.iinfo(np.int64).max)
    last_score, last_column = floors.copy(), np.full(len(floors), np.iinfo(np.int64).max)
    if not shard.width:  # one document: its cells are reached already
        return _cells(shard, item, state, column, gain, node - len(shard.masks))
    while len(item):
        chosen = np.zeros(len(item), bool)
        chosen[_leading(item, bound, column, at_once)] = True
        mine = chosen[state]
        s, r, g, n = state[mine], row[mine], gain[mine], node[mine]
        half = ((r >> (h - 1 - level[s])) & 1) << 1
        halves = [shard.quarter(n, half | side) for side in (0, 1)]
        key = np.concatenate([2 * s[has] + side for side, (has, _) in enumerate(halves)])
        sort = np.argsort(key, kind="stable")
        key = key[sort]
        r, g = (np.concatenate([x[has] for has, _ in halves])[sort] for x in (r, g))
        n = np.concatenate([child[has] for has, child in halves])[sort]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        of = key[start] >> 1
        new_item, new_level = item[of], level[of] + 1
        new_column = column[of] + ((key[start] & 1) << (h - new_level))
        to = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(key)]))
        cells = new_level == h
        if cells.any():
            inside = cells[to]
            number = np.cumsum(cells) - 1
            found = _cells(shard, new_item[cells], number[to[inside]], new_column[cells], g[inside],
                           n[inside] - len(shard.masks))
            best = tuple(np.concatenate(x) for x in zip(best, found, strict=True))
            top = _leading(best[0], best[2], best[1], k)
            best = tuple(x[top] for x in best)
            full = np.flatnonzero(np.bincount(best[0], minlength=len(floors)) >= k)
            end = np.searchsorted(best[0], full, side="right") - 1
            higher = best[2][end] >= last_score[full]
            last_score[full[higher]], last_column[full[higher]] = best[2][end[higher]], best[1][end[higher]]
        inner = ~cells[to]
        worth = np.add.reduceat(np.where(inner, g * shard.peaks[np.where(inner, n, 0)].astype(np.int64) * _STEP, 0), start)
        # what is left, then the new states; those that cannot reach the best any more go
        item, level, column, bound, state, row, gain, node = (
            np.concatenate(x) for x in ((item, new_item), (level, new_level), (column, new_column), (bound, worth),
                                        (state, to + len(item)), (row, r), (gain, g), (node, n)))
        keep = np.r_[~chosen, ~cells]
        keep &= (bound > last_score[item]) | ((bound == last_score[item]) & (column <= last_column[item]))
        number = np.cumsum(keep) - 1
        mine = keep[state]
        state, row, gain, node = number[state[mine]], row[mine], gain[mine], node[mine]
        item, level, column, bound = item[keep], level[keep], column[keep], bound[keep]
    return best


def _cells(shard: Shard, item: np.ndarray, state: np.ndarray, column: np.ndarray, gain: np.ndarray, cell: np.ndarray):
    """Exact scores of single documents."""
    tf = shard.tf[cell].astype(np.int64)
    part = gain * ((1_000_000_000 * tf) // (1000 * tf + shard.m12[column[state]]))
    score = np.zeros(len(item), np.int64)
    np.add.at(score, state, part)
    good = score > 0
    return item[good], column[good], score[good]


# ---- search over all shards --------------------------------------------------------

def _frequencies(wanted: frozenset):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for terms, df in zip(batch.column("terms"), batch.column("df"), strict=True):
                counts = np.frombuffer(df.as_py(), np.int32)
                for i, term in enumerate(terms.as_py().split(b"\n")):
                    if term in wanted:
                        total[term] += int(counts[i])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                             names=["term", "df"])

    return run


def _searcher(queries: list[dict], floors: np.ndarray, docs: int, terms: int, k: int):
    wanted = frozenset().union(*queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                place = {t: j for j, t in enumerate(held.pop("terms").split(b"\n")) if t in wanted}
                shard = Shard(held, docs, terms)
                for at in range(0, len(queries), _TOGETHER):
                    items = []
                    for gains in queries[at:at + _TOGETHER]:
                        known = [(place[t] << _STRETCH, g) for t, g in gains.items() if t in place]
                        items.append(tuple(np.array(x, np.int64) for x in zip(*known, strict=True)) if known
                                     else (np.empty(0, np.int64),) * 2)
                    item, column, score = search_shard(shard, items, floors[at:at + _TOGETHER], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item + at, pa.int64()), pa.array([shard.doc_ids[c] for c in column], pa.int64()),
                         pa.array(score, pa.int64())], names=["query", "doc_id", "score"])

    return run


def _block(index: Index, texts: list, k: int, seed_shards: int) -> DataFrame:
    """The best of every shard for some items: ``query, doc_id, score``; first some shards, whose scores bound the rest."""
    spark = index.shards.sparkSession
    held = [Counter(terms_of(t)) for t in texts]
    wanted = frozenset().union(*held)
    df = {bytes(r.term): r.df for r in index.shards.select("terms", "df").mapInArrow(_frequencies(wanted), "term binary, df bigint")
          .groupBy("term").agg(F.sum("df").alias("df")).collect()}  # terms of this block's items only
    queries = [{t: c * w for t, c in q.items() if t in df and (w := weight(df[t], index.docs)) > 0} for q in held]
    schema = "query bigint, doc_id bigint, score bigint"
    tree = index.shards.drop("df")
    first = F.xxhash64("terms") % seed_shards == 0
    search = lambda rows, floors: rows.mapInArrow(
        _searcher(queries, floors, index.docs, index.terms, k), schema)
    floors = np.zeros(len(queries), np.int64)
    seeded = stored(search(tree.where(first), floors), "seeded")
    for r in _best(seeded, k, ["query"]).where(F.col("rank") == k).select("query", "score").collect():
        floors[r.query] = r.score  # a number an item
    return seeded.unionByName(stored(search(tree.where(~first), floors), "searched"))


def _best(rows: DataFrame, k: int, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank(index: Index, items: DataFrame, k: int = 20, seed_shards: int = 8) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    ``score`` sums, over an item's terms with their repeats, weight times
    impact (``weight``, ``impacts``); only scores above 0 count, equal scores
    rank by id, null last.  Items equal in id and text are one; items without
    terms, or null, have no rows.  An empty table on either side gives an empty
    result.

    Items are searched in blocks of about ``_QUERY_BYTES``, each against all
    shards; a shard gives at most ``k`` documents an item.  One shard in
    ``seed_shards`` is searched first: what its documents reach, the others must
    reach too, so their trees are cut earlier.  That changes the work, never
    the result.
    """
    spark = items.sparkSession
    schema = "item_id {}, rank int, doc_id bigint, score bigint".format(items.schema["item_id"].dataType.simpleString())
    asked = items.select("item_id", text_of().cast("binary").alias("text")).distinct()
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    if not index.docs or not size:
        return spark.createDataFrame([], schema)
    blocks = -(-size // _QUERY_BYTES)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for block in range(blocks):
        rows = asked.where(number == block).collect()  # about _QUERY_BYTES
        if not rows:
            continue
        with settings(spark, _FEW_SHARDS):
            found = _block(index, [bytes(r.text) for r in rows], k, seed_shards)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)],
                                      f"query bigint, item_id {schema.split()[1].rstrip(',')}")
        found = _best(found, k, ["query"]).join(names, "query").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out
