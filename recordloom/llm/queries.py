"""The operators over their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.common import read
from recordloom.llm.debruijn import OP12_SQL, remove_repeated_spans
from recordloom.llm.divergence import OP11_SQL, audit
from recordloom.llm.exact_dedup import OP6_SQL, ExactDedup
from recordloom.llm.language import held_out, identify
from recordloom.llm.mixing import mix
from recordloom.llm.negatives import OP13_SQL, mine
from recordloom.llm.neighbours import nearest
from recordloom.llm.packing import pack
from recordloom.llm.pii import find
from recordloom.llm.repeats import remove_repeats
from recordloom.llm.scoring import OP1_SQL, score
from recordloom.llm.simhash import hexadecimal, near_duplicates
from recordloom.llm.urls import judge

Query = Callable[[SparkSession, str], DataFrame]


def op1_cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    """How close every document is to those that are labelled good and not toxic."""
    labels = read(spark, folder, "labels")
    target = labels.where("quality = 1 AND toxic = 0").select("doc_id")
    found = score(read(spark, folder, "documents").select("doc_id", "text"), target)
    rounded = [F.round(c, 6).alias(c) for c in ("target_loss", "background_loss", "score")]
    return found.select("doc_id", "n_words", *rounded)


def op2_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = mix(read(spark, folder, "documents"))
    return plan.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


def op3_collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return pack(documents).drop("text")


def op5_hierarchical_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text", "lang")
    found = identify(documents)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op6_bloom_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return ExactDedup(read(spark, folder, "documents")).decisions()


def op7_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find(read(spark, folder, "documents"))


def op8_boosted_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge(read(spark, folder, "pages").select("page_id", "url")).drop("url")


def op9_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read(spark, folder, "documents"))


def op10_pigeonring_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op11_divergence_cube(spark: SparkSession, folder: str) -> DataFrame:
    return audit(read(spark, folder, "documents"))


def op12_debruijn_spans(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeated_spans(read(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh label is moved on by one first, as wrong labels would be."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, label)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_cross_entropy_difference,
        op2_pivotal_mix,
        op3_collision_counting,
        op4_length_buckets,
        op5_hierarchical_language,
        op6_bloom_exact_dedup,
        op7_bootstrapped_pii,
        op8_boosted_url_filter,
        op9_suffix_repeats,
        op10_pigeonring_simhash,
        op11_divergence_cube,
        op12_debruijn_spans,
        op13_hard_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op1_cross_entropy_difference": OP1_SQL,
    "op6_bloom_exact_dedup": OP6_SQL,
    "op11_divergence_cube": OP11_SQL,
    "op12_debruijn_spans": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
