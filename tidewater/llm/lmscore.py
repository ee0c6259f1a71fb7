"""Language-model scoring with a weighted backoff automaton.

The n-gram model of a large corpus does not fit on one machine, so no task
ever holds it.  Documents are dealt into blocks; a block sends the keys of its
distinct n-grams, with their training counts, to buckets by key; a bucket adds
the counts of all blocks up and sends each block the totals of the keys it
asked for.  From these a block builds the part of the automaton that its own
texts can visit, weighted by the counts of the whole corpus, and traverses it
once from left to right.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import automaton
from tidewater.llm.common import text_of

_START, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_SHIFT = np.uint64(29)


class _Vocabulary(dict):
    """64-bit fingerprints of words; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _tokens(texts: list[str], vocabulary: _Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of ``start word* end`` for all texts in a row, and each text's length so."""
    parts, lengths = [], np.empty(len(texts), np.int64)
    for k, text in enumerate(texts):
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        row = np.empty(len(found) + 2, np.uint64)
        row[0], row[-1] = _START, _END
        row[1:-1] = np.fromiter(map(vocabulary.__getitem__, found), np.uint64, len(found))
        parts.append(row)
        lengths[k] = len(row)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), lengths


def _grams(tokens: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """Key of the n-gram of each length 1..order ending at each position; 0 where a text has begun later.

    A longer key extends the key of the history by the word, so the history of
    ``grams[k][i]`` is ``grams[k - 1][i - 1]``.
    """
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    grams = [tokens]
    for n in range(1, order):
        key = np.zeros_like(tokens)
        key[1:] = grams[-1][:-1]  # the history
        key ^= key >> _SHIFT
        key *= _MIX
        key += tokens
        key ^= key >> _SHIFT
        key *= _MIX
        key += np.uint64(n)
        key[place < n] = 0
        grams.append(key)
    return grams


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the place of each key among them."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.empty(len(keys), bool)
    if len(keys):
        fresh[0] = True
        np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(fresh, dtype=np.int32) - 1
    return ranked[fresh], place


def _block(table: pa.Table, order: int, vocabulary: _Vocabulary):
    """What both passes over a block derive from its rows, in the same order of keys."""
    texts = table.column("text").to_pylist()
    tokens, lengths = _tokens(texts, vocabulary)
    del texts
    vocabulary.clear()
    grams, valid, keys, place = _grams(tokens, lengths, order), [], [], []
    for n in range(order):  # an n-gram is not kept longer than needed
        valid.append((grams[n] != 0) if n else np.ones(len(tokens), bool))
        distinct, at = _distinct(grams[n])
        grams[n] = None
        keys.append(distinct)
        place.append(at)
    return lengths, valid, keys, place


def _by_part(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets that sorted keys fall into, each a range of keys, with the place of its keys."""
    part = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.searchsorted(part, np.arange(buckets + 1, dtype=np.uint64))
    for p in np.flatnonzero(np.diff(cuts)):
        yield int(p), slice(cuts[p], cuts[p + 1])


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers, first their lowest bytes, then their next ones: bytes that hardly vary cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _unpack(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, size * 8, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, size).T).view("<u8").ravel()


_ASKED = "block bigint, n int, bucket bigint, size bigint, keys binary, counts binary"
_ANSWERED = "block bigint, n int, bucket bigint, size bigint, totals binary"


def _asker(order: int, buckets: int) -> Callable:
    """First pass: the block's distinct n-grams with their training counts, by bucket."""

    def ask(table: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("block", "n", "bucket", "size", "keys", "counts")}
        block = table.column("block")[0].as_py()
        lengths, _, keys, place = _block(table, order, _Vocabulary())
        learnt = np.repeat(~table.column("held_out").to_numpy(zero_copy_only=False).astype(bool), lengths)
        for n in range(order):
            counts = np.bincount(place[n][learnt], minlength=len(keys[n]))
            for p, at in _by_part(keys[n], buckets):
                out["block"].append(block)
                out["n"].append(n + 1)
                out["bucket"].append(n * buckets + p)
                out["size"].append(at.stop - at.start)
                out["keys"].append(_pack(np.diff(keys[n][at], prepend=np.uint64(0))))
                out["counts"].append(_pack(counts[at]))
        return pa.table({
            "block": pa.array(out["block"], pa.int64()), "n": pa.array(out["n"], pa.int32()),
            "bucket": pa.array(out["bucket"], pa.int64()), "size": pa.array(out["size"], pa.int64()),
            "keys": pa.array(out["keys"], pa.binary()), "counts": pa.array(out["counts"], pa.binary())})

    return ask


def _totals(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's distinct keys, their counts in all blocks together, and the place among
    them of each key that its rows ask for, row after row."""
    sizes = table.column("size").to_pylist()
    flat = np.concatenate([np.cumsum(_unpack(k.as_py(), m), dtype=np.uint64)
                           for k, m in zip(table.column("keys"), sizes, strict=True)])
    counts = np.concatenate([_unpack(c.as_py(), m) for c, m in zip(table.column("counts"), sizes, strict=True)])
    distinct, place = _distinct(flat)
    return distinct, np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64), place


def _answer(table: pa.Table) -> pa.Table:
    """Second pass: each block's keys answered, in the order asked, by the corpus's counts."""
    _, total, place = _totals(table)
    cuts = np.cumsum(table.column("size").to_numpy())[:-1]
    return pa.table({c: table.column(c) for c in ("block", "n", "bucket", "size")} | {
        "totals": pa.array([_pack(total[at]) for at in np.split(place, cuts)], pa.binary())})


def _census(table: pa.Table) -> pa.Table:
    """A bucket's share of the model-wide figures: distinct words, words seen once and twice, tokens."""
    names = ("distinct", "once", "twice", "tokens")
    if table.column("n")[0].as_py() > 1:
        return pa.table({c: pa.array([], pa.int64()) for c in names})
    distinct, total, _ = _totals(table)
    total = total[distinct != _START]  # a history only, never an event
    figures = [int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum()), int(total.sum())]
    return pa.table({c: pa.array([v], pa.int64()) for c, v in zip(names, figures, strict=True)})


def _scorer(order: int, buckets: int, strength: float, growth: float) -> Callable:
    schema = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, known_log double, "
              "score double, vocabulary bigint, train_tokens bigint")

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()),
                             "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()),
                             "known_log": pa.array([], pa.float64()), "score": pa.array([], pa.float64()),
                             "vocabulary": pa.array([], pa.int64()), "train_tokens": pa.array([], pa.int64())})
        lengths, valid, keys, place = _block(table, order, _Vocabulary())
        docs, counts = table.num_rows, []
        row = {b: k for k, b in enumerate(answers.column("bucket").to_pylist())}
        vocabulary, n_tokens = (answers.column(c)[0].as_py() for c in ("vocabulary", "train_tokens"))
        discount = answers.column("discount")[0].as_py()
        for n in range(order):
            total = np.zeros(len(keys[n]), np.int64)
            for p, at in _by_part(keys[n], buckets):
                data = answers.column("totals")[row[n * buckets + p]].as_py()
                total[at] = _unpack(data, at.stop - at.start)
            counts.append(total)
        begins = np.zeros(len(place[0]), bool)
        begins[np.cumsum(lengths) - lengths] = True
        start = int(place[0][0])  # the first token of the first text
        del keys, answers
        gained = np.zeros(len(begins))
        if n_tokens:
            machine, states = automaton.build(place, valid, counts, n_tokens, vocabulary, discount, strength, growth)
            gained = machine.traverse(place[0], begins, int(states[start]), order - 1)
        event, own = ~begins, counts[0][place[0]]
        of = np.repeat(np.arange(docs), lengths)[event]
        add = lambda v: np.bincount(of, weights=v, minlength=docs)
        return pa.table({
            "doc_id": table.column("doc_id").cast(pa.int64()), "held_out": table.column("held_out"),
            "n_tokens": pa.array(lengths - 1, pa.int64()),
            "n_known": pa.array(add(own[event] > 0).astype(np.int64)),
            "known_log": pa.array(add(np.log10(own[event] + 1))),
            "score": pa.array(add(gained[event])),
            "vocabulary": pa.array([vocabulary] * docs, pa.int64()),
            "train_tokens": pa.array([n_tokens] * docs, pa.int64())})

    return score, schema


def score_texts(docs: DataFrame, held_out: str, order: int = 2, strength: float = 8.0, growth: float = 0.7,
                block_bytes: int = 16 << 20) -> DataFrame:
    """log10 probability of every text under an n-gram model of the rows not held out.

    ``docs`` has ``doc_id, text``; ``held_out`` is a boolean SQL expression
    over its columns.  Returns ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score``, one row per input row; extra input
    columns are not looked at.

    Tokens: A-Z lower-cased words between ASCII white space, then one end.  A
    state of the automaton is a history of up to ``order - 1`` tokens (texts
    begin in a start state) that training texts contain ``c`` times.  Its arc
    for a word weighs ``(1 - f) * c(history, word) / c`` on top of ``f`` times
    the weight at the state its failure arc leads to, the history without its
    oldest token; ``f = g / (c + g)`` with ``g = strength * c ** growth``, so
    each state's weights sum to one.  A history unknown to training fails at
    weight 1.  The last state has ``(c - d) / N`` for a known word and leaves
    ``d * V / N`` to the unknown one, ``d = (n1 + 1) / (n1 + 2 n2 + 2)`` from
    the words seen once and twice.  ``base_score`` is the add-one unigram score.

    N-grams are known by 64-bit fingerprints.  Null or empty text: the end
    token alone.  Null ids: rows like others.  Repeated rows: each counts.  No
    training rows: ``score`` is 0 and no token is known.  Empty table: empty.

    A block is about ``block_bytes`` of text whatever a source, id or word
    weighs, and asks once for each distinct n-gram; a frequent word costs a
    bucket one entry per block.  Buckets and blocks grow with the text.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"),
                       F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"))
    volume = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(volume // block_bytes) + 1
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("bigint"))

    asked = dealt.groupBy("block").applyInArrow(_asker(order, blocks), _ASKED)
    answers = asked.groupBy("bucket").applyInArrow(_answer, _ANSWERED)
    census = (asked.groupBy("bucket").applyInArrow(
        _census, "distinct bigint, once bigint, twice bigint, tokens bigint")
        .agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("vocabulary"),
             F.coalesce(F.sum("tokens"), F.lit(0)).alias("train_tokens"),
             ((F.coalesce(F.sum("once"), F.lit(0)) + 1)
              / (F.coalesce(F.sum("once"), F.lit(0)) + 2 * F.coalesce(F.sum("twice"), F.lit(0)) + 2)).alias("discount")))
    answers = answers.crossJoin(F.broadcast(census))  # one row
    score, score_schema = _scorer(order, blocks, strength, growth)
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, score_schema)
    base = F.col("known_log") - F.col("n_tokens") * F.log10(F.col("train_tokens") + F.col("vocabulary") + 1)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", base.alias("base_score"), "score")
