"""A corpus pipeline: language, exact copies, near copies, mixture, packing.

Every stage takes all its predecessor kept and returns the columns of documents; the last
one adds the packing.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from recordloom.llm.common import Apart, keep, read, without  # noqa: E402
from recordloom.llm.exact_dedup import ExactDedup  # noqa: E402
from recordloom.llm.language import UNKNOWN, identify  # noqa: E402
from recordloom.llm.mixing import mixed_rows  # noqa: E402
from recordloom.llm.packing import ADDED, pack  # noqa: E402
from recordloom.llm.simhash import survivors  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without text or letters go."""
    rows = Apart(docs)
    found = identify(rows.table, rows["doc_id"], rows["text"], rows["lang"])
    return rows.back(found.where(F.col("lang_pred") != UNKNOWN))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    rows = Apart(docs)
    return rows.back(ExactDedup(rows.table, rows["doc_id"], rows["text"]).survivors())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked fingerprints, the document with the smallest id, nulls last."""
    return survivors(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as its source's target asks for."""
    rows = Apart(docs)
    return rows.back(mixed_rows(rows.table, rows["doc_id"], rows["text"], rows["source"]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their place in token-budget batches of like length.

    Columns of the added names are replaced; all others stay as they are.
    """
    rows = Apart(without(docs, ADDED))
    packed = pack(rows.table, rows["doc_id"], rows["text"])
    return packed.toDF(*rows.names, *ADDED)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixture", mixture),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier, the fingerprints and the rounding are not SQL; tests compare with brute force.
ORACLE_SQL = None
