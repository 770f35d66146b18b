"""Hard negatives by rotated one-bit codes with exact integer scores.

Vectors are made of whole numbers; a score is the inner product of two of them.  An anchor's
positives are its best rows of the same label; for every positive, its hard negatives are the
best rows of another label whose score lies in a band below the positive's.

Index, one row per vector, all rows: the vector is scaled to length one and coded ``LEVELS``
times.  Each level rotates what is left of it by a random orthogonal matrix, stores the signs as
one bit a component, and the alignment: the inner product of what is left with its code vector
(the signs over the square root of the dimension).  The code vector times the alignment is then
taken off.  The norm of the rest is stored too.

Filter: an anchor is rotated once per level and its components are rounded to ``PLANES`` bits;
its inner product with a code vector is a weighted sum of population counts of code and bit
planes, wrong by at most the sum of the rounding errors.  Estimates of the levels, weighted
with the alignments, add up to the score; what the codes leave out is at most the rest's norm
times the anchor's (Cauchy-Schwarz).  So each row gets an interval that holds its true score for
certain.  Level by level, rows go whose interval can't reach the band or the k-th best lower
bound; rows left after the last one are scored exactly in whole numbers.  No row is lost
to an estimate.

Rows are dealt to data blocks of about ``BLOCK`` and anchors to blocks of about ``QUERY_BLOCK``
by a hash of a row number; each pair of blocks is one task, for the positives first and then,
with the scores of the positives known, for the negatives.  Blocks' best rows are merged.

Scores are computed in floating point where every partial sum is a whole number that the type
holds exactly (below 2**24 or 2**53), and as Python's whole numbers beyond; a score that no
long can hold is an error.

Defined results: rows with null label or vector, or with null or non-finite components, take no
part; zero vectors do, with score 0; vectors of different lengths are not compared; rows count
by themselves, so equal ids are different rows (an anchor is never its own positive); rows
without id are no anchors and come last among equal scores; ties by smaller id; vectors without
components take no part; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from recordloom.llm.common import keep
from recordloom.shipping import ship_package

POSITIVES = 5
NEGATIVES = 3
BAND = (50, 95)
LEVELS = 4
PLANES = 6
BLOCK = 8_192
LEAST_BLOCKS = 8
QUERY_BLOCK = 16_384
SEED = 20_240_613
_CHUNK = 1_024
# Level from which intervals are short enough for the k-th best lower bound to tell.
_SETTLING = 2
_EXACT = float(1 << 53)
_EXACT_SINGLE = float(1 << 24)
# Doubles of the filter are wrong by far less than this part of the two norms.
_SLACK = 1e-9


@lru_cache(maxsize=64)
def rotation(dim: int, level: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is drawn."""
    drawn = np.random.RandomState((SEED + 7919 * level + dim) % (1 << 32)).standard_normal((dim, dim))
    q, r = np.linalg.qr(drawn)
    return q * np.sign(np.diag(r))


def _bits(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    rest = -signs.shape[1] % 64
    padded = np.pad(signs, ((0, 0), (0, rest)))
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


class Coded(NamedTuple):
    """Codes (level, row, word), alignments and norms of the rests (level, row), norms (row)."""

    codes: np.ndarray
    align: np.ndarray
    rest: np.ndarray
    norm: np.ndarray


def encode(x: np.ndarray, levels: int = LEVELS) -> Coded:
    """One-bit codes of the rows of ``x``; all alignments are those of the vector at length one."""
    dim = x.shape[1]
    norm = np.sqrt((x * x).sum(axis=1))
    left = x / np.where(norm > 0, norm, 1.0)[:, None]
    codes, align, rest = [], [], []
    for level in range(levels):
        turned = left @ rotation(dim, level)
        signs = turned >= 0
        code = np.where(signs, 1.0, -1.0) / np.sqrt(dim)
        share = (turned * code).sum(axis=1)
        left = (turned - share[:, None] * code) @ rotation(dim, level).T
        codes.append(_bits(signs))
        align.append(share)
        rest.append(np.sqrt((left * left).sum(axis=1)))
    return Coded(np.array(codes), np.array(align), np.array(rest), norm)


class Anchor(NamedTuple):
    """What the filter needs of one anchor at each level."""

    vector: np.ndarray
    norm: float
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray
    planes: np.ndarray
    error: np.ndarray


def anchors(vectors: np.ndarray, levels: int = LEVELS, planes: int = PLANES) -> Iterator[Anchor]:
    """Rotates vectors and rounds them to bit planes; the errors of rounding are summed up."""
    dim = vectors.shape[1]
    low, step, total, bits, error = [], [], [], [], []
    for level in range(levels):
        turned = vectors @ rotation(dim, level)
        least, most = turned.min(axis=1), turned.max(axis=1)
        unit = np.where(most > least, (most - least) / ((1 << planes) - 1), 1.0)
        whole = np.rint((turned - least[:, None]) / unit[:, None]).astype(np.int64)
        rounded = least[:, None] + unit[:, None] * whole
        low.append(least)
        step.append(unit)
        total.append(whole.sum(axis=1))
        error.append(np.abs(turned - rounded).sum(axis=1) / np.sqrt(dim))
        bits.append(np.stack([_bits((whole >> j & 1).astype(bool)) for j in range(planes)], axis=1))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    parts = [np.stack(x, axis=1) for x in (low, step, total, bits, error)]
    for i, vector in enumerate(vectors):
        yield Anchor(vector, float(norms[i]), *(x[i] for x in parts))


class Interval:
    """Bounds of the scores of a block's rows with one anchor, narrowed level by level."""

    def __init__(self, anchor: Anchor, block: Block, start: int, end: int, taken: np.ndarray):
        self.anchor = anchor
        self.rows = np.arange(start, end)
        self.taken = taken[start:end]
        self.parts = [a[..., start:end] for a in (block.codes, block.ones, block.align, block.rest)]
        self.sum = np.zeros(end - start)
        self.error = np.zeros(end - start)

    def narrow(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds, from population counts of this level and those before."""
        at, (codes, ones, align, rest) = self.anchor, self.parts
        weighted = np.zeros(len(self.rows), dtype=np.int32)
        for word in range(codes.shape[1]):
            for j in range(at.planes.shape[1]):
                count = np.bitwise_count(codes[level, word] & at.planes[level, j, word])
                weighted += np.left_shift(count, j, dtype=np.int32)
        dim = len(at.vector)
        root = np.sqrt(dim)
        found = weighted * (2 * at.step[level] / root)
        found += ones[level] * (2 * at.low[level] / root)
        found -= (at.low[level] * dim + at.step[level] * at.total[level]) / root
        found *= align[level]
        self.sum += found
        self.error += np.abs(align[level]) * at.error[level]
        half = self.error + rest[level] * at.norm
        return self.sum - half, self.sum + half

    def keep(self, staying: np.ndarray) -> None:
        """Rows that are left; copied only where that saves work."""
        left = np.flatnonzero(staying)
        if 4 * len(left) <= 3 * len(staying):
            self.rows, self.taken = self.rows[left], self.taken[left]
            self.sum, self.error = self.sum[left], self.error[left]
            self.parts = [a.take(left, axis=-1) for a in self.parts]


def _best(values: np.ndarray, k: int) -> float:
    """The k-th largest, or nothing to beat."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def exact(data: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers."""
    if not len(data):
        return np.empty(0, dtype=np.int64)
    bound = float(np.abs(data).max()) * float(np.abs(vector).max()) * len(vector)
    if bound < (_EXACT if data.dtype == np.float64 else _EXACT_SINGLE):
        return (data @ vector.astype(data.dtype)).astype(np.int64)
    data = data.astype(np.float64)
    if bound < _EXACT:
        return (data @ vector).astype(np.int64)
    mine = [int(v) for v in vector]
    found = [sum(int(a) * b for a, b in zip(row, mine)) for row in data]
    if any(not -(1 << 63) < f < 1 << 63 for f in found):
        raise OverflowError("a score does not fit a long")
    return np.array(found, dtype=np.int64)


def best_rows(
    anchor: Anchor, block: Block, start: int, end: int, taken: np.ndarray, k: int,
    bands: list[tuple[float, float]],
) -> list[list[tuple[int, int]]]:
    """For each band, place in the block and score of the k best rows in it, best first.

    Rows from ``start`` to ``end`` take part where ``taken`` says so.
    """
    interval = Interval(anchor, block, start, end, taken)
    open_bands = [b for b in bands if b[0] <= b[1]]
    if not open_bands:
        return [[] for _ in bands]
    lowest, most = min(open_bands), max(b[1] for b in open_bands)
    # Where one band has both the least edges, its k-th best bound is the least of all bands'.
    telling = lowest[1] == min(b[1] for b in open_bands)
    least = lowest[0]
    for level in range(len(block.codes)):
        if len(interval.rows) <= k:
            break
        low, high = interval.narrow(level)
        if level >= _SETTLING and telling:
            certain = low[interval.taken & (low >= lowest[0]) & (high <= lowest[1])]
            least = max(least, _best(certain, k))
        interval.keep(interval.taken & (high >= least) & (low <= most))
    rows = interval.rows[interval.taken]
    scores = exact(block.data[rows], anchor.vector)
    found = []
    for least, most in bands:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        inside = inside[scores[inside] >= _best(scores[inside], k)]
        first = inside[np.lexsort((block.order[rows[inside]], -scores[inside]))][:k]
        found.append(list(zip(rows[first].tolist(), scores[first].tolist())))
    return found


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


class Block:
    """The rows of one block that are searched, in order of their labels.

    ``align`` and ``rest`` are those of the index times the rows' norms.
    """

    def __init__(self, table: pa.Table):
        table = table.sort_by("label")
        n = len(table)
        self.data = _matrix(table["v"], n)
        if n and np.abs(self.data).max() <= _EXACT_SINGLE:
            self.data = self.data.astype(np.float32)
        words = -(-self.data.shape[1] // 64)
        codes = _matrix(table["codes"], n).view(np.uint64).reshape(n, -1, words)
        self.codes = codes.transpose(1, 2, 0).copy()
        self.ones = np.bitwise_count(self.codes).sum(axis=1, dtype=np.int64)
        norm = table["norm"].to_numpy()
        self.align = _matrix(table["align"], n).T * norm
        self.rest = (_matrix(table["rest"], n).T + _SLACK) * norm
        self.labels, self.rows = table["label"].to_numpy(), table["row"].to_numpy()
        self.ids = table["id"].to_pylist()
        sooner = sorted(range(n), key=lambda i: (self.ids[i] is None, self.ids[i] or 0, self.rows[i]))
        self.order = np.empty(n, dtype=np.int64)
        self.order[sooner] = np.arange(n)

    def same(self, label: int) -> tuple[int, int]:
        """Where the rows of a label start and end."""
        return tuple(np.searchsorted(self.labels, [label, label + 1]).tolist())


_FOUND = {
    "anchor": pa.int64(), "anchor_id": pa.int64(), "place": pa.int32(), "row": pa.int64(),
    "id": pa.int64(), "score": pa.int64(), "positive_id": pa.int64(), "positive_score": pa.int64(),
}


def _search(how):
    """Runs ``how(an anchor's columns, the anchor, block)`` for a pair of blocks."""

    def group(table: pa.Table) -> pa.Table:
        asked = table["asked"].combine_chunks()
        data, queries = table.filter(pc.invert(asked)), table.filter(asked)
        out: list[tuple] = []
        block = Block(data) if len(data) and len(queries) else None
        for start in range(0, len(queries) if block else 0, _CHUNK):
            part = queries.slice(start, _CHUNK)
            told = part.select(["row", "id", "label", "positives"]).to_pylist()
            for at, anchor in zip(told, anchors(_matrix(part["v"], len(part)))):
                for place, row, score, *positive in how(at, anchor, block):
                    out.append((
                        at["row"], at["id"], place, int(block.rows[row]), block.ids[row], score,
                        *(positive or (None, None)),
                    ))
        columns = list(zip(*out)) or [()] * len(_FOUND)
        return pa.table({n: pa.array(c, t) for c, (n, t) in zip(columns, _FOUND.items())})

    return group


def _positives(k: int):
    def how(at, anchor, block):
        found = best_rows(
            anchor, block, *block.same(at["label"]), block.rows != at["row"], k, [(-np.inf, np.inf)]
        )
        return [(0, r, s) for r, s in found[0]]

    return how


def _negatives(k: int, band: tuple[int, int]):
    def how(at, anchor, block):
        told = at["positives"]
        # The whole scores s with band[0] * score <= 100 s <= band[1] * score.
        edges = [(-(-band[0] * p["score"] // 100), band[1] * p["score"] // 100) for p in told]
        found = best_rows(
            anchor, block, 0, len(block.rows), block.labels != at["label"], k, edges
        )
        return [
            (place, r, s, p["id"], p["score"])
            for place, (p, rows) in enumerate(zip(told, found))
            for r, s in rows
        ]

    return how


def usable(vector: Column) -> Column:
    """No null and nothing that is not a number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def _index_batches(times: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(4).value_lengths().to_numpy()
            for dim in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == dim)))
                n = len(part)
                x = np.floor(float(times) * part.column(4).flatten().to_numpy().reshape(n, -1))
                if not np.isfinite(x).all():
                    raise OverflowError(f"a component times {times} is beyond all doubles")
                coded = encode(x)
                lists = [
                    (x, pa.float64()),
                    (coded.codes.transpose(1, 0, 2).reshape(n, -1).view(np.int64), pa.int64()),
                    (coded.align.T, pa.float64()),
                    (coded.rest.T, pa.float64()),
                ]
                arrays = [
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * a.shape[1]),
                        pa.array(np.ascontiguousarray(a).ravel(), t),
                    )
                    for a, t in lists
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], *arrays, pa.array(coded.norm)],
                    names=["row", "id", "label", "anchor", "v", "codes", "align", "rest", "norm"],
                )

    return add


def index(
    df: DataFrame, is_anchor: Column, label: Column, id_col: str, vector_col: str, times: int
) -> DataFrame:
    """Every usable row with a number of its own, its vector in whole numbers and its codes."""
    ship_package(df.sparkSession)
    chosen = df.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        (F.coalesce(is_anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("anchor"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    chosen = keep(chosen.where(F.col("label").isNotNull() & usable(F.col("v")) & (F.size("v") > 0)))
    rows = chosen.select(F.monotonically_increasing_id().alias("row"), "id", "label", "anchor", "v")
    kinds = (
        "row long, id long, label long, anchor boolean, v array<double>, codes array<long>, "
        "align array<double>, rest array<double>, norm double"
    )
    return keep(rows.mapInArrow(_index_batches(times), kinds))


def _blocks(rows: DataFrame, asked: DataFrame, blocks: int, query_blocks: int) -> GroupedData:
    """Each row in its data block and each anchor in its own, for all pairs of the two."""
    h = F.xxhash64(F.lit(SEED), F.col("row"))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    data = rows.select(
        "row", "id", "label", "v", "codes", "align", "rest", "norm", F.lit(False).alias("asked"),
        F.lit(None).cast(asked.schema["positives"].dataType).alias("positives"),
        F.pmod(h, F.lit(blocks)).cast("int").alias("block"), every(query_blocks).alias("query_block"),
    )
    nothing = {c: F.lit(None).cast(rows.schema[c].dataType) for c in ("codes", "align", "rest", "norm")}
    asked = asked.select(
        "row", "id", "label", "v", *[v.alias(c) for c, v in nothing.items()],
        F.lit(True).alias("asked"), "positives", every(blocks).alias("block"),
        F.pmod(h, F.lit(query_blocks)).cast("int").alias("query_block"),
    )
    both = data.unionByName(asked).withColumn("dim", F.size("v"))
    return both.groupBy("dim", "block", "query_block")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "place").orderBy(
        F.col("score").desc(), F.col("id").asc_nulls_last(), "row"
    )
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    df: DataFrame,
    is_anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    times: int = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components become floor(times * x).  A negative's score lies between the two per cents
    ``band`` of its positive's.
    """
    rows = index(df, is_anchor, label, id_col, vector_col, times)
    n, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    blocks = max(LEAST_BLOCKS, -(-n // BLOCK)), max(1, -(-n_anchors // QUERY_BLOCK))
    kinds = ", ".join(f"{n} {'int' if n == 'place' else 'long'}" for n in _FOUND)
    listed = "array<struct<rank:int, id:bigint, score:bigint>>"
    asked = rows.where("anchor").select("row", "id", "label", "v")
    alone = asked.withColumn("positives", F.lit(None).cast(listed))
    near = _blocks(rows, alone, *blocks).applyInArrow(_search(_positives(positives)), kinds)
    near = _first(near, positives).groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives")
    )
    paired = keep(asked.join(near.withColumnRenamed("anchor", "row"), "row"))
    found = _blocks(rows, paired, *blocks).applyInArrow(_search(_negatives(negatives, band)), kinds)
    return _first(found, negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


OP13_SQL = f"""
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id AS id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r AS anchor, a.id AS anchor_id, b.r, b.id, a.label = b.label AS same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE a.id % 50 = 0
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY anchor ORDER BY score DESC, id NULLS LAST, r) AS place FROM scored WHERE same)
  WHERE place <= {POSITIVES}
), negatives AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score,
         n.score AS negative_score, row_number() OVER (
           PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.id NULLS LAST, n.r) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
  WHERE {BAND[0]} * p.score <= 100 * n.score AND 100 * n.score <= {BAND[1]} * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= {NEGATIVES}
"""
