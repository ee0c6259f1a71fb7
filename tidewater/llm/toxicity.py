"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on
toxic text.  A short window of a document is compressed with the ordinary
dictionary and with the toxic one on top of it: what it gains is how much it
shares with toxic text beyond what all text has in common.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of

_WINDOW = re.compile(rb"\s*(?:\S+\s*){1,6}")
_LEVEL = 3


def windows(text: str | None) -> list[bytes]:
    """Runs of six words, lower-cased, one after the other over the whole text."""
    return _WINDOW.findall((text or "").lower().encode("utf-8", "surrogatepass"))


def _dictionary(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """A trained dictionary's content; too few samples serve as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d, level=_LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) > 8 else None
    return zstandard.ZstdCompressor(level=_LEVEL, dict_data=kind, write_content_size=False, write_checksum=False,
                                    write_dict_id=False)


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    threshold: float  # gain that ordinary windows rarely have
    weights: tuple[float, ...]

    def gains(self):
        plain, both = _compressor(self.ordinary), _compressor(self.ordinary + self.toxic)

        def of(text: str | None) -> list[int]:
            return [len(plain.compress(w)) - len(both.compress(w)) for w in windows(text)]

        return of

    def features(self, gains: list[int]) -> tuple[float, ...]:
        """Largest gain, windows over the threshold and their share; all 0 without windows."""
        over = sum(g >= self.threshold for g in gains)
        return (1.0, max([0, *gains]) / 4.0, float(np.log1p(over)), over / max(len(gains), 1), float(np.log1p(len(gains))))

    def score(self, gains: list[int]) -> float:
        at = float(np.dot(self.weights, self.features(gains)))
        return float(1 / (1 + np.exp(-np.clip(at, -35, 35))))


def _marked_words(toxic: list[str], ordinary: list[str], share: float = 0.02, ratio: float = 8.0) -> set[bytes]:
    """Words that ``share`` of the toxic texts (three at least) have, ``ratio`` times as many as of the others."""
    def spread(texts: list[str]) -> Counter:
        return Counter(w for t in texts for w in set(t.lower().encode("utf-8", "surrogatepass").split()))

    bad, good = spread(toxic), spread(ordinary)
    return {w for w, n in bad.items() if n >= max(3, share * len(toxic))
            and n / len(toxic) > ratio * (good[w] + 0.5) / max(len(ordinary), 1)}


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Weighted ridge logistic regression by Newton's steps."""
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - keep * w
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, slope)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(toxic: list[str], ordinary: list[str], totals: tuple[int, int] | None = None,
          ordinary_bytes: int = 32768, toxic_bytes: int = 2048) -> ToxicityModel:
    """Dictionaries from 7 in 10 of the samples, threshold and calibration from the others.

    The toxic dictionary is trained on the words that set toxic texts apart, in
    all their occurrences; repeated texts count once there.  ``totals`` are the
    labelled rows of either kind, for the calibration to hold for all of them.
    Without samples of a kind the score is the share of toxic labels, or 0.
    """
    n, m = totals or (len(toxic), len(ordinary))
    if not toxic or not ordinary:
        odds = np.log((n + 1e-9) / (m + 1e-9))
        return ToxicityModel(b"", b"", 1.0, (float(np.clip(odds, -35, 35)), 0.0, 0.0, 0.0, 0.0))
    cut_t, cut_o = max(1, len(toxic) * 7 // 10), max(1, len(ordinary) * 7 // 10)
    learn_t, learn_o = list(dict.fromkeys(toxic[:cut_t])), list(dict.fromkeys(ordinary[:cut_o]))
    marked = _marked_words(learn_t, learn_o)
    spans = [b" " + w + b" " for t in learn_t for w in t.lower().encode("utf-8", "surrogatepass").split() if w in marked]
    plain = [w for t in learn_o for w in windows(t)]
    plain = plain[::len(plain) // 60_000 + 1]
    model = ToxicityModel(_dictionary(plain, ordinary_bytes, 50, 8),
                          _dictionary(spans or [w for t in learn_t for w in windows(t)], toxic_bytes, 32, 6), 1.0, ())
    gains = model.gains()
    rest_t, rest_o = toxic[cut_t:] or toxic, ordinary[cut_o:] or ordinary
    got_t, got_o = [gains(t) for t in rest_t], [gains(t) for t in rest_o]
    flat = np.concatenate([np.asarray(g) for g in got_o if g] or [np.zeros(1)])
    model = ToxicityModel(model.ordinary, model.toxic, float(max(3, np.quantile(flat, 0.995) + 1)), ())
    x = np.array([model.features(g) for g in got_t + got_o])
    y = np.r_[np.ones(len(got_t)), np.zeros(len(got_o))]
    weight = np.r_[np.full(len(got_t), n / len(got_t)), np.full(len(got_o), m / len(got_o))]
    weight *= len(y) / weight.sum()
    return ToxicityModel(model.ordinary, model.toxic, model.threshold, tuple(_logistic(x, y, weight).tolist()))


def fit(docs: DataFrame, labels: DataFrame, learn_from: str, per_label: int = 2500,
        sample_chars: int = 100_000) -> ToxicityModel:
    """Train on a bounded sample: ``per_label`` labelled rows of either kind.

    Only rows that the SQL expression ``learn_from`` holds for are read, the
    smallest hashes of their ids; texts of over ``sample_chars`` characters are
    left out of the sample (never of the scoring), so the driver gets a bounded
    volume.  An id with several labels is toxic if one says so; null labels and
    ids do not count.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(F.expr(learn_from))
             .groupBy("doc_id").agg(F.max("toxic").alias("y")))
    totals = dict(known.groupBy((F.col("y") > 0).alias("bad")).count().collect())
    picked = None
    for bad in (True, False):
        some = known.where((F.col("y") > 0) == F.lit(bad)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        picked = some if picked is None else picked.unionByName(some)
    texts = (docs.select("doc_id", F.col("text")).where(F.col("text").isNotNull() & (F.length("text") <= sample_chars))
             .join(F.broadcast(picked), "doc_id").orderBy(F.xxhash64("doc_id"), "text").limit(2 * per_label)
             .select((F.col("y") > 0).alias("bad"), "text").collect())
    return train([r.text for r in texts if r.bad], [r.text for r in texts if not r.bad],
                 (totals.get(True, 0), totals.get(False, 0)))


def score_toxicity(docs: DataFrame, model: ToxicityModel, cut: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every row: the calibrated probability that a text is toxic.

    Whole texts are compared, window by window.  Null and empty texts have no
    window and get the score of no evidence.  Null ids, repeated rows: rows
    like others.  Extra columns are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = model.gains()
        for batch in batches:
            scores = np.array([model.score(gains(t)) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(scores >= cut).cast(pa.int32())],
                names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double, predicted int")
