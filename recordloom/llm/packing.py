"""Packing into optimal length buckets.

The histogram of lengths over all documents has one row per length that occurs: as many as the
longest document has words at most, whatever the number of documents.  Dynamic programming over it chooses
at most ``n_buckets`` upper bounds so that the padding of all documents to their bucket's bound
is least.  Inside a bucket, batches hold as many documents
as the token budget allows at that length, one at least; only the last batch of a bucket is
not full.

Documents get their place in the bucket without one task seeing the bucket: each bucket is
split into parts of about ``PART`` rows by a hash, rows are numbered within parts, and parts
are laid out one after the other.

Defined results: null text has length 0, and length-0 documents pad to the first bound;
documents above the budget form batches of one; repeated rows are documents of their own;
an empty table gives an empty result; columns with the added names are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import without, word_count
from recordloom.operators.once import once

N_BUCKETS = 12
TOKEN_BUDGET = 32_768
PART = 8_192
ADDED = ["length", "bucket", "bucket_length", "batch_id", "slot"]


def best_bounds(classes: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """The bounds, ascending, that minimise ``sum(count * (bound - class))``.

    Buckets that end at class j and begin at class i cost ``class_j * (below_j+1 - below_i)``
    words, padding included: lines in class_j, of which the lower envelope is kept while j
    rises, so each bucket takes one pass over the classes.  All sums are whole numbers.
    """
    n = len(classes)
    if not n:
        return []
    lengths = [int(c) for c in classes]
    below = [0]
    for count in counts:
        below.append(below[-1] + int(count))
    cost = [c * w for c, w in zip(lengths, below[1:])]
    starts: list[list[int]] = []
    for _ in range(min(n_buckets, n) - 1):
        now, start = [], []
        # Lines (slope, height, first class); slopes fall, so the best one moves to the right.
        lines: list[tuple[int, int, int]] = []
        at = 0
        for j, x in enumerate(lengths):
            new = (-below[j], cost[j - 1] if j else 0, j)
            while len(lines) > 1:
                (m1, b1, _), (m2, b2, _) = lines[-2:]
                if (new[1] - b1) * (m1 - m2) > (b2 - b1) * (m1 - new[0]):
                    break
                lines.pop()
            lines.append(new)
            at = min(at, len(lines) - 1)
            while at + 1 < len(lines) and (
                lines[at + 1][0] * x + lines[at + 1][1] < lines[at][0] * x + lines[at][1]
            ):
                at += 1
            slope, height, i = lines[at]
            now.append(slope * x + height + x * below[j + 1])
            start.append(i)
        cost = now
        starts.append(start)
    bounds, j = [], n
    while j > 0:
        bounds.append(lengths[j - 1])
        j = starts.pop()[j - 1] if starts else 0
    return bounds[::-1]


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_buckets: int = N_BUCKETS,
    budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """The rows with length, bucket, bucket_length, batch_id and slot (place in the batch)."""
    df = without(df, ADDED)
    rows = once(df, "_length", word_count(F.col(text_col)))
    histogram = rows.groupBy("_length").count().orderBy("_length").collect()
    bounds = best_bounds(
        np.array([r[0] for r in histogram], dtype=np.int64),
        np.array([r[1] for r in histogram], dtype=np.int64),
        n_buckets,
    )
    sizes, at = [0] * max(1, len(bounds)), 0
    for value, count in histogram:
        while value > bounds[at]:
            at += 1
        sizes[at] += count
    # The last bucket takes what lies above, which nothing does.
    bucket = F.lit(max(0, len(bounds) - 1))
    for i in reversed(range(len(bounds))):
        bucket = F.when(F.col("_length") <= bounds[i], F.lit(i)).otherwise(bucket)
    parts = F.array(*[F.lit(max(1, -(-n // PART))) for n in sizes])
    h = F.xxhash64(F.col(id_col), F.col("_length"))
    rows = rows.withColumn("_bucket", bucket)
    rows = rows.withColumn("_h", h).withColumn("_part", F.pmod("_h", F.get(parts, "_bucket")))
    per_part = rows.groupBy("_bucket", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_bucket").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_part.select(
        F.col("_bucket"), F.col("_part"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    within = Window.partitionBy("_bucket", "_part").orderBy("_h", F.col(id_col))
    numbered = rows.withColumn("_row", F.row_number().over(within) - 1)
    placed = numbered.join(offsets, ["_bucket", "_part"])
    place = F.col("_offset") + F.col("_row")
    length = F.get(F.array(*[F.lit(b).cast("long") for b in bounds or [0]]), F.col("_bucket"))
    holds = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(length, F.lit(1))))
    return placed.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_length").alias("length"), F.col("_bucket").cast("int").alias("bucket"),
        length.alias("bucket_length"),
        F.concat_ws("-", F.col("_bucket"), F.floor(place / holds)).alias("batch_id"),
        F.pmod(place, holds).cast("long").alias("slot"),
    )
