"""Secrets in texts, judged by how many repositories and owners hold each value."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stored, text_of

#: Kinds in the order in which spans of one start are listed; the last is added by ``find_secrets``.
KINDS = ("assign", "access", "hex", "bare")
# The three base patterns.
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, so the least length can stand in the pattern
_BARE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_ROW = ("doc_id bigint, owner string, repository string, found array<struct<kind:int, start:int, stop:int, "
        "value:binary, strong:boolean>>")


def _digest(value: str) -> bytes:
    """What stands for a value in tables: no secret is written out."""
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:16]


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(kind, start, end, value)`` of the three base patterns, by start, then kind."""
    found = [(0, m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(1, m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(2, m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], x[0]))


def looks_random(value: str, least_bits: float) -> bool:
    """Upper-case, lower-case and digits mixed, with ``least_bits`` of entropy a character."""
    if not (re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= least_bits


def bare_spans(text: str, taken: list[tuple[int, int, int, str]], least_bits: float) -> list[tuple]:
    """Long tokens with a digit and a letter outside the base spans: ``(kind, start, end, value, strong)``.

    A strong one looks random by itself; the others count only where the corpus
    knows their value from a base pattern.
    """
    out = []
    for m in _BARE.finditer(text):
        value = m[0]
        if not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)):
            continue
        if all(m.end() <= s or m.start() >= e for _, s, e, _ in taken):
            out.append((3, m.start(), m.end(), value, len(value) >= 20 and looks_random(value, least_bits)))
    return out


def _scanner(least_bits: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
                                   ("value", pa.binary()), ("strong", pa.bool_())]))
        for batch in batches:
            rows = []
            for cell in batch.column("text"):
                text = cell.as_py()
                base = base_spans(text)
                spans = [(*x, True) for x in base] + bare_spans(text, base, least_bits)
                rows.append([dict(kind=k, start=s, stop=e, value=_digest(v), strong=strong) for k, s, e, v, strong in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("owner"), batch.column("repository"), pa.array(rows, kind)],
                names=["doc_id", "owner", "repository", "found"])

    return run


def ownership(occurrences: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each value: ``value, owners, repositories, proven``.

    ``occurrences`` has ``value, owner, repository, proven``.  Each step sums
    before it shuffles, and its key holds one thing more than the next one's, so
    a value that a third of all rows hold never meets in one task.
    """
    each = occurrences.groupBy("value", "owner", "repository").agg(F.max("proven").alias("proven"))
    owned = each.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.max("proven").alias("proven"))
    return owned.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"),
                                      F.max("proven").alias("proven"))


def find_secrets(docs: DataFrame, owner: Column | None = None, repository: Column | None = None,
                 max_owners: int = 2, least_bits: float = 3.5) -> DataFrame:
    """Secrets of every text, one row per input row.

    Returns ``doc_id, found, n_live, n_copied``; ``found`` is an array of
    ``kind, start, stop, owners, repositories, live`` by start, then kind, in
    code points, ``stop`` exclusive.  ``owner`` defaults to the source and
    ``repository`` to the document.

    Base spans (assign, access, hex) are always in ``found``.  A value that more
    than ``max_owners`` owners hold is a copied example: sample keys of
    documentation go from one owner to many.  One that few hold is live.  Live
    values add spans of kind ``bare``: tokens outside the base spans that look
    random, or whose value some text of the corpus holds in a base span, so a
    key that is named in one file is found where it stands alone in another.

    A null owner or repository is one of its own.  Null and empty texts hold
    nothing; repeated rows give repeated rows but count once as a repository; an
    empty table gives an empty result.
    """
    owner = F.col("source").cast("string") if owner is None else owner
    repository = F.col("doc_id").cast("string") if repository is None else repository
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), owner.alias("owner"),
                       repository.alias("repository"), text_of().alias("text"))
    scan = stored(rows.mapInArrow(_scanner(least_bits), _ROW).withColumn("row", F.monotonically_increasing_id()), "secrets")
    spans = scan.where(F.size("found") > 0).select("row", "owner", "repository", F.explode("found").alias("x")).select(
        "row", "owner", "repository", "x.*")
    known = ownership(spans.select("value", "owner", "repository", (F.col("kind") < 3).alias("proven")))
    live = F.col("owners") <= max_owners
    judged = spans.join(known, "value").select("row", F.struct(
        "start", "kind", "stop", "owners", "repositories", live.alias("live")).alias("x"),
        ((F.col("kind") < 3) | (live & (F.col("strong") | F.col("proven")))).alias("kept"))
    listed = judged.where("kept").groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("spans"))
    kinds = F.array(*map(F.lit, KINDS))
    full = scan.join(listed, "row", "left").select("doc_id", F.transform(
        F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,stop:int,owners:bigint,"
                                           "repositories:bigint,live:boolean>>")),
        lambda x: F.struct(F.element_at(kinds, x.kind + 1).alias("kind"), x.start.alias("start"), x.stop.alias("stop"),
                           x.owners.alias("owners"), x.repositories.alias("repositories"), x.live.alias("live"))).alias("found"))
    return full.select("doc_id", "found", F.size(F.filter("found", lambda x: x.live)).cast("long").alias("n_live"),
                       F.size(F.filter("found", lambda x: ~x.live)).cast("long").alias("n_copied"))


def listing(found: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.stop.cast("string"))))
