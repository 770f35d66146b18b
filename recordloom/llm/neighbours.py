"""Approximate nearest neighbours by collision counting with query-aware hashing.

Vectors are scaled to length one, so that the nearest by cosine is the nearest by distance.
Each of ``PROJECTIONS`` random directions gives one number per vector, kept as a sorted array.
A query opens a window around its own number in every array; a vector inside the window
collides with it there.  Vectors that collide in at least ``COLLISIONS`` arrays are verified:
their cosine is computed in double precision on the original numbers.  Windows grow by
virtual rehashing (radius times ``GROWTH``, only the new rings are counted) until the k-th
best verified vector lies within the radius.  A vector within the radius collides in an
array with probability 0.826, so it misses the threshold with probability below 0.001.

Vectors are dealt to blocks of at most about ``BLOCK`` by a hash of a row number and queries to
blocks of about ``QUERY_BLOCK``; each pair of blocks is one group of bounded size, and the
best k of every block are merged.  All rows are indexed and none is skipped or capped.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers, and
rows without id, take no part; rows that are repeated in full count once, and rows of one id with
different vectors are rows of their own, as candidates and as queries; vectors of different lengths are not compared; ties go to the smaller id; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import keep
from recordloom.shipping import ship_package

PROJECTIONS = 64
COLLISIONS = 42
WIDTH = 2.719
FIRST_RADIUS = 0.35
GROWTH = 1.35
BLOCK = 8_192
LEAST_BLOCKS = 8
QUERY_BLOCK = 4_096
SEED = 20_240_501


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by their largest component, so that squares neither overflow nor vanish,
    and the lengths of what is left."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x, np.sqrt((x * x).sum(axis=1))


def block_search(
    rows: np.ndarray, ids: np.ndarray, data: np.ndarray, query_rows: np.ndarray,
    queries: np.ndarray, k: int,
) -> list[tuple[int, int, float]]:
    """The k nearest of one block for each query but its own row: query row, id, cosine."""
    dim, n = data.shape[1], len(ids)
    data, length = _scaled(data)
    queries, query_length = _scaled(queries)
    directions = np.random.RandomState(SEED).standard_normal((dim, PROJECTIONS))
    placed = (data / length[:, None]) @ directions
    order = np.argsort(placed, axis=0, kind="stable").T.copy()
    arrays = np.sort(placed, axis=0).T.copy()
    centres = (queries / query_length[:, None]) @ directions
    out = []
    for q in range(len(query_rows)):
        counts = np.zeros(n, dtype=np.int64)
        counts[rows == query_rows[q]] = -PROJECTIONS - 1  # never a candidate
        verified = counts < 0
        wanted = min(k, n - int(verified.sum()))
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        low = high = np.array(
            [np.searchsorted(arrays[p], centres[q, p]) for p in range(PROJECTIONS)]
        )
        radius = FIRST_RADIUS
        while wanted:
            half = WIDTH * radius / 2
            rings = []
            lower = np.empty_like(low)
            upper = np.empty_like(high)
            for p in range(PROJECTIONS):
                lower[p] = np.searchsorted(arrays[p], centres[q, p] - half)
                upper[p] = np.searchsorted(arrays[p], centres[q, p] + half, side="right")
                rings.append(order[p, lower[p] : low[p]])
                rings.append(order[p, high[p] : upper[p]])
            low, high = lower, upper
            counts += np.bincount(np.concatenate(rings), minlength=n)
            candidates = np.flatnonzero((counts >= COLLISIONS) & ~verified)
            if len(candidates):
                verified[candidates] = True
                dot = (data[candidates] * queries[q]).sum(axis=1)
                cosine = dot / (length[candidates] * query_length[q])
                best_ids = np.concatenate([best_ids, ids[candidates]])
                best = np.concatenate([best, np.clip(cosine, -1.0, 1.0)])
                first = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[first], best[first]
            if len(best) >= wanted and 2 - 2 * best[wanted - 1] <= radius * radius:
                break
            if radius > 2 and verified.all():
                break
            radius *= GROWTH
        out.extend((int(query_rows[q]), int(i), float(s)) for i, s in zip(best_ids, best))
    return out


def _search(k: int):
    def group(table: pa.Table) -> pa.Table:
        vectors = table.column("v").combine_chunks()
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1)
        ids, rows = table.column("id").to_numpy(), table.column("row").to_numpy()
        asked = table.column("query").to_numpy().astype(bool)
        found = []
        if asked.any() and not asked.all():
            found = block_search(rows[~asked], ids[~asked], x[~asked], rows[asked], x[asked], k)
        named = dict(zip(rows[asked].tolist(), ids[asked].tolist()))
        return pa.table(
            {
                "query": pa.array([f[0] for f in found], pa.int64()),
                "query_id": pa.array([named[f[0]] for f in found], pa.int64()),
                "vec_id": pa.array([f[1] for f in found], pa.int64()),
                "score": pa.array([f[2] for f in found], pa.float64()),
            }
        )

    return group


def nearest(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest to every row that is a query."""
    ship_package(df.sparkSession)
    rows = df.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    # Rows that are repeated in full count once; rows that share an id are rows of their own.
    rows = keep(rows.groupBy("id", "v").agg(F.max("query").alias("query")))
    rows = keep(rows.select(F.monotonically_increasing_id().alias("row"), "id", "v", "query"))
    n, n_queries = rows.agg(F.count("*"), F.count_if("query")).first()
    blocks = max(LEAST_BLOCKS, -(-n // BLOCK))
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    h = F.xxhash64(F.lit(SEED), F.col("row"))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    size = F.size("v").alias("dim")
    data = rows.select(
        "row", "id", "v", F.lit(False).alias("query"), size,
        F.pmod(h, F.lit(blocks)).cast("int").alias("block"),
        every(query_blocks).alias("query_block"),
    )
    asked = rows.where("query").select(
        "row", "id", "v", "query", size, every(blocks).alias("block"),
        F.pmod(h, F.lit(query_blocks)).cast("int").alias("query_block"),
    )
    pairs = data.unionByName(asked).groupBy("dim", "block", "query_block")
    found = pairs.applyInArrow(_search(k), "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
