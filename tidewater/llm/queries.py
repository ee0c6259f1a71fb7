"""Registered queries of the corpus operators: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (chat, decontam, hamming, linededup, lmscore, mixing, neardup, quality, ranked, secretscan,
                           toxicity, urlfilter, variants)
from tidewater.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def held_out_sql(modulus: int) -> str:
    """Rows whose CRC-32 of the id, as text, leaves 2."""
    return f"crc32(encode(coalesce(cast(doc_id as string), ''), 'UTF-8')) % {modulus} = 2"


@query
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_texts(table(spark, sf_dir, "documents"), held_out_sql(7))


@query
def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its last reply swapped."""
    chosen, rejected = chat.swapped_replies(table(spark, sf_dir, "conversations"))
    pairs = chat.preference_pairs(chosen, rejected)
    lengths = lambda mask: F.concat_ws(",", F.transform(mask, lambda m: F.concat(
        m.chars.cast("string"), F.when(m.loss, "+").otherwise("-"))))
    return pairs.select("pair_id", "shared_turns", "prompt", "chosen", "rejected",
                        lengths("chosen_mask").alias("chosen_mask"), lengths("rejected_mask").alias("rejected_mask"))


@query
def op3_benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated three-line windows."""
    kept = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.coalesce("text", F.lit("")).alias("text"))


@query
def op5_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows, by sign code, of every row whose id 100 divides."""
    codes = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.top_k(codes, codes.where(F.col("id") % 100 == 0), k=10)


@query
def op6_url_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.rated_by_document(pages, table(spark, sf_dir, "labels")))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.grades_of(table(spark, sf_dir, "labels")))
    return quality.rate(docs.select("doc_id", "text"), model).select("doc_id", "expected_grade", "tail", "accepted")


@query
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "epochs")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), held_out_sql(4)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), f"not ({held_out})")
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", F.expr(held_out).alias("held_out"), "score", "predicted")


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_classes(table(spark, sf_dir, "documents")).drop("key")


@query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets; a document stands for a repository, its source for the owner."""
    found = secretscan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x.kind != "bare")
    of = lambda kind: F.size(F.filter("found", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", of("assign"), of("access"), of("hex"),
                        F.sha2(secretscan.listing(base).cast("binary"), 256).alias("base_sha256"),
                        secretscan.listing(F.col("found")).alias("spans"), "n_live", "n_copied")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_forms(variants.vocabulary(table(spark, sf_dir, "documents")))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    index = ranked.build_index(table(spark, sf_dir, "documents"))
    return ranked.rank(index, table(spark, sf_dir, "benchmark"), k=20)
