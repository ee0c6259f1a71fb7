"""Corpus pipeline: documents to a de-duplicated, clean, weighted mixture.

``STAGES`` names the stages in order; each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written before the next one reads it.  All but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import decontam, linededup, mixing, neardup, quality
from tidewater.llm.common import stored, table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier expects to be acceptable."""
    model = quality.fit(docs, quality.grades_of(table(spark, sf_dir, "labels")))
    return quality.rate(docs, model).where("accepted").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated three-line windows; none is dropped, its text may become empty."""
    return linededup.dedup_lines(docs).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mixture takes of each document."""
    return mixing.mix(docs)


STAGES = [
    ("quality", accept_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The classifier and the sketches have no SQL form; tests check each stage, and that run() is their sequence.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
