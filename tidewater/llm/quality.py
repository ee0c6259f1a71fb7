"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds on its score part the grades: P(grade <= k) = sigmoid(t_k - score).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of

_SHAPES = ((re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() else "a" if m[0].islower() else "Aa"),
           (re.compile(r"\d+"), lambda m: "0"))
#: Features of a whole text, after the hashed ones.
WHOLE = 10


def _shape(word: str) -> str:
    """Letters, digits and repeats collapsed: what kind of word it is."""
    for pattern, by in _SHAPES:
        word = pattern.sub(by, word)
    return re.sub(r"(.)\1+", r"\1", word)[:12]


def _word_features(word: str, buckets: int) -> tuple[int, ...]:
    names = ("s" + _shape(word), f"l{min(len(word), 24) // 3}", "p" + word[-1:])
    return tuple(xxhash.xxh3_64_intdigest(n.encode("utf-8", "surrogatepass")) % buckets for n in names)


class _Cache(dict):
    """A function of a word, kept for the words seen; emptied when it has grown large."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word: str):
        if len(self) > 300_000:
            self.clear()
        value = self[word] = self.of(word)
        return value


def whole_features(text: str, words: list[str]) -> np.ndarray:
    """Repetition, length and layout of a text, each of about unit size."""
    n = max(len(words), 1)
    lines = text.split("\n")
    again = sum(map(eq, words, words[1:])) / n
    return np.array([
        again, float(again > 0.1), float(again > 0.4),
        sum(map(eq, words, words[2:])) / n,
        len(set(words)) / n,
        np.log1p(len(words)) / 5,
        1 - len(set(lines)) / len(lines),
        np.log1p(len(text) / n) / 3,
        np.log1p(len(lines)) / 5,
        float(not words)])


def features(text: str | None, buckets: int, cache: _Cache) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features: mean count per distinct word of the hashed ones, then the whole text's."""
    text = text or ""
    words = text.split()
    distinct = set(words)
    rows = [cache[w] for w in distinct]
    at, number = np.unique(np.array(rows, np.int32).ravel(), return_counts=True) if rows else (np.empty(0, np.int32),) * 2
    return (np.r_[at, buckets + np.arange(WHOLE)].astype(np.int32),
            np.r_[number / max(len(distinct), 1), whole_features(text, words)])


@dataclass(frozen=True)
class OrdinalModel:
    buckets: int
    weights: np.ndarray
    thresholds: np.ndarray  # rising; one fewer than the grades

    def scorer(self):
        """Linear score of a text; a word's weights are added up once."""
        w, b = self.weights, self.buckets
        cache = _Cache(lambda word: float(sum(w[i] for i in _word_features(word, b))))

        def of(text: str | None) -> float:
            text = text or ""
            words = text.split()
            distinct = set(words)
            mean = sum(map(cache.__getitem__, distinct)) / max(len(distinct), 1)
            return mean + float(w[b:] @ whole_features(text, words))

        return of

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -35, 35)))


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, buckets: int, grade_count: int,
                ridge: float = 3e-5, rounds: int = 600, rate: float = 0.1) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model by Adam's steps, with a ridge on the weights.

    Thresholds start at the grades' frequencies and stay ordered: the first one
    and the logs of the gaps are the parameters.
    """
    n, size = len(rows), buckets + WHOLE
    share = np.cumsum(np.bincount(grades, minlength=grade_count) + 0.5)[:-1] / (n + 0.5 * grade_count)
    thresholds = np.log(share / (1 - share))
    if n == 0:
        return OrdinalModel(buckets, np.zeros(size), thresholds)
    at = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    of = np.repeat(np.arange(n), [len(r[0]) for r in rows])
    scale = np.sqrt(np.bincount(at, weights=value**2, minlength=size) / n) + 1e-3
    value = value / scale[at] * 0.1
    free = np.r_[np.zeros(size), thresholds[0], np.log(np.maximum(np.diff(thresholds), 1e-3))]
    first, second = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, rounds + 1):
        w, cuts = free[:size], np.cumsum(np.r_[free[size], np.exp(free[size + 1:])])
        score = np.bincount(of, weights=value * w[at], minlength=n)
        edge = np.concatenate(([-np.inf], cuts, [np.inf]))
        high = 1 / (1 + np.exp(-np.clip(edge[grades + 1] - score, -35, 35)))
        low = 1 / (1 + np.exp(-np.clip(edge[grades] - score, -35, 35)))
        p = np.maximum(high - low, 1e-12)
        d_high = np.where(np.isinf(edge[grades + 1]), 0, high * (1 - high)) / p
        d_low = np.where(np.isinf(edge[grades]), 0, low * (1 - low)) / p
        d_score = d_high - d_low  # of the negative log likelihood
        d_cut = (np.bincount(grades + 1, weights=-d_high, minlength=grade_count + 1)
                 + np.bincount(grades, weights=d_low, minlength=grade_count + 1))[1:grade_count]
        later = np.cumsum(d_cut[::-1])[::-1]  # a gap moves all later thresholds
        grad = np.r_[np.bincount(at, weights=value * d_score[of], minlength=size) / n + ridge * w,
                     later[0] / n, later[1:] * np.exp(free[size + 1:]) / n]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        free = free - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(buckets, free[:size] / scale * 0.1, np.cumsum(np.r_[free[size], np.exp(free[size + 1:])]))


def fit(docs: DataFrame, ratings: DataFrame, grade_count: int = 3, sample: int = 5000,
        sample_chars: int = 100_000, buckets: int = 1 << 11) -> OrdinalModel:
    """Fit on a bounded sample of rated rows: the ``sample`` smallest hashes of their ids.

    ``ratings`` has ``doc_id, grade`` (0 is worst, up to ``grade_count - 1``);
    null and out-of-range grades and null ids do not count, and of several
    grades of an id the lowest does.  Texts of over ``sample_chars`` characters
    are left out of the sample (never of the scoring), so the driver gets a
    bounded volume; features are made on the executors.
    """
    known = (ratings.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grade_count - 1))
             .groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = (docs.select("doc_id", text_of().alias("text")).where(F.length("text") <= sample_chars)
             .join(F.broadcast(known), "doc_id").select("doc_id", "grade", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Cache(lambda word: _word_features(word, buckets))
        for batch in batches:
            rows = [features(t, buckets, cache) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("grade"),
                 pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))],
                names=["doc_id", "grade", "at", "value"])

    got = texts.mapInArrow(run, "doc_id bigint, grade int, at array<int>, value array<float>").limit(2 * sample).toArrow()
    order = np.lexsort((got.column("grade").to_numpy(), got.column("doc_id").to_numpy()))
    got = got.take(pa.array(order)).combine_chunks()
    rows = [(a.values.to_numpy(), v.values.to_numpy(zero_copy_only=False).astype(np.float64))
            for a, v in zip(got.column("at"), got.column("value"), strict=True)]
    return fit_ordinal(rows, got.column("grade").to_numpy().astype(np.int64), buckets, grade_count)


def rate(docs: DataFrame, model: OrdinalModel, acceptable: int = 1, cut: float = 0.5) -> DataFrame:
    """All columns of ``docs`` plus ``expected_grade, tail, accepted``.

    ``expected_grade`` is the mean grade, ``tail`` the probability of grade
    ``acceptable`` or better, and ``accepted`` whether that is at least
    ``cut``.  Whole texts are read.  Null and empty texts are rated by the
    features of an empty text.  Columns of those names in ``docs`` are replaced.
    """
    @F.pandas_udf("expected_grade double, tail double")
    def graded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = model.scorer()
        for texts in batches:
            tails = model.tails(np.array([score(t) for t in texts]))
            yield pd.DataFrame({"expected_grade": tails.sum(axis=1), "tail": tails[:, acceptable - 1]})

    base = [c for c in docs.columns if c not in ("expected_grade", "tail", "accepted")]
    out = docs.select(*[F.col(f"`{c}`") for c in base], graded(text_of()).alias("_g"))
    return out.select(*[F.col(f"`{c}`") for c in base], "_g.expected_grade", "_g.tail",
                      (F.col("_g.tail") >= cut).alias("accepted"))


def grades_of(labels: DataFrame) -> DataFrame:
    """Three grades from the labels: 0 low quality, 1 good but toxic, 2 good; null quality is unrated."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1,
                                                  F.when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))
