"""SimHash near-duplicates with pigeonring filtering.

Fingerprints: 64 bits per text from all its word shingles.  Texts link at ``MAX_BITS`` or
fewer differing bits, and linked texts form groups.

Candidates: a fingerprint is a ring of 16 segments of 4 bits.  If two fingerprints differ in
at most 4 bits, then some start on the ring exists from which every chain of l segments differs
in at most l * 4 / 16 bits.  So from that start the first 3 segments are equal, 7 segments
differ in at most one bit, 11 in two, 15 in three.  The index uses the beginning of the chain:
with A, B the next two pairs of segments and C, D the two after them, one of {A, B} is equal
and two of {A, B, C, D} are, so the pair shares the first 3 segments and one of AB, AC, AD,
BC, BD: 28 equal bits.  Each distinct fingerprint is listed under these 80 keys, which
shuffle; inside a key the chain conditions prune before the full Hamming check.

Only distinct fingerprints take part, so copies of one text cost nothing.  A key's list is
searched like a graph: a fingerprint that was reached is never compared with another one
that was, so a dense list of n takes about n comparisons and yields n - 1 links at most,
never all pairs.  Groups are then found by contraction, each round staged.

Defined results: null text counts as empty; a text without words has fingerprint 0 and
links like any other; the group's name is the smallest id reachable; null ids come last;
repeated rows share their group; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import Apart, keep
from recordloom.shipping import ship_package

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = 16
WIDTH = 64 // SEGMENTS
# Segments at these distances from the start, besides the first three: the pairs of AB .. BD.
BLOCKS = {"A": (3, 4), "B": (5, 6), "C": (7, 8), "D": (9, 10)}
PATTERNS = ("AB", "AC", "AD", "BC", "BD")
_SLICE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text, in memory that grows with the text alone."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate([[0], ends + 1]).tolist()
    ends = np.concatenate([ends, [len(line)]]).tolist()
    last = ends[shingle - 1 :] or ends[-1:]
    set_bits = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(last), _SLICE):
        hashes = np.array(
            [digest(line[a:b], SEED) for a, b in zip(starts[at:], last[at : at + _SLICE])],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    on = np.packbits(2 * set_bits > len(last), bitorder="little")
    return int(on.view("<u8")[0])


def marked(df: DataFrame, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """The rows with ``fp``, the fingerprint (as a signed long) of their text, in its place."""
    ship_package(df.sparkSession)
    at = df.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(
                [fingerprint(t.as_py(), shingle) for t in batch.column(at)], dtype=np.uint64
            )
            columns = [*batch.columns[:at], *batch.columns[at + 1 :], pa.array(found.view(np.int64))]
            names = [*batch.schema.names[:at], *batch.schema.names[at + 1 :], "fp"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = [f for f in df.schema.fields if f.name != text_col]
    return df.mapInArrow(add, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """Id and fingerprint (as a signed long), one row per row."""
    chosen = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return marked(chosen, "text", shingle)


def _segments(start: int, distances: tuple[int, ...]) -> list[int]:
    return [(start + d) % SEGMENTS for d in distances]


def _mask(segments: list[int]) -> int:
    mask = 0
    for s in segments:
        mask |= ((1 << WIDTH) - 1) << (s * WIDTH)
    return mask - (1 << 64) if mask >> 63 else mask


def _keys(fp: Column) -> Column:
    """All keys of a fingerprint; the upper bits of a hash carry the bits, the lower the list."""
    lists = []
    for start in range(SEGMENTS):
        for n, pattern in enumerate(PATTERNS):
            places = (0, 1, 2, *BLOCKS[pattern[0]], *BLOCKS[pattern[1]])
            shared = fp.bitwiseAND(F.lit(_mask(_segments(start, places))))
            at = start * len(PATTERNS) + n
            lists.append(F.struct(F.lit(at).alias("list"), shared.alias("shared")))
    return F.array(*lists)


# Bits of a chain of 7, 11 and 15 segments from each start, and how much they may differ.
_CHAINS = [
    [(np.uint64(_mask(_segments(s, tuple(range(n)))) % (1 << 64)), b) for n, b in
     ((7, 1), (11, 2), (15, 3))]
    for s in range(SEGMENTS)
]


def _links(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that connect what is connected in one list, by a search over it."""
    left = fps
    links: list[tuple[int, int]] = []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            here = frontier.pop()
            differ = left ^ here
            near = np.arange(len(left))
            for mask, most in _CHAINS[start]:
                near = near[np.bitwise_count(differ[near] & mask) <= most]
            near = near[np.bitwise_count(differ[near]) <= MAX_BITS]
            if len(near):
                found = left[near]
                links.extend((int(here), int(f)) for f in found)
                frontier.extend(found)
                left = np.delete(left, near)
    return links


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by list and shared bits; one list is held at a time, 8 bytes a row."""
    held: list[np.ndarray] = []
    key: tuple[int, int] | None = None
    out: list[tuple[int, int]] = []

    def close() -> None:
        if key is not None:
            fps = np.concatenate(held).view(np.uint64)
            if len(fps) > 1:
                out.extend(_links(fps, key[0] // len(PATTERNS)))

    def batch_of() -> pa.RecordBatch:
        pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
        )

    for batch in batches:
        lists, shared, fps = (batch.column(i).to_numpy() for i in range(3))
        if not len(lists):
            continue
        cuts = np.flatnonzero((np.diff(lists) != 0) | (np.diff(shared) != 0)) + 1
        edges = [0, *cuts.tolist(), len(lists)]
        for a, b in zip(edges, edges[1:]):
            this = (int(lists[a]), int(shared[a]))
            if this != key:
                close()
                key, held = this, []
            held.append(fps[a:b])
        if len(out) >= 10_000:
            yield batch_of()
    close()
    yield batch_of()


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that are connected."""
    ship_package(distinct.sparkSession)
    listed = distinct.select("fp", F.explode(_keys(F.col("fp"))).alias("k"))
    listed = listed.select("k.list", "k.shared", "fp")
    # Most fingerprints are alone under most of their keys and need no search.
    dealt = listed.repartition("list", "shared").sortWithinPartitions("list", "shared", "fp")
    return dealt.mapInArrow(_link_batches, "a bigint, b bigint")


def groups(edges: DataFrame) -> DataFrame:
    """Node and group of every node that has a link; the group is one of its nodes.

    Each round every node moves to the neighbour (or itself) with the least hash and links
    are redrawn between where their ends moved; links within a group vanish.  The number of
    nodes falls by a constant factor a round.
    """
    spark = edges.sparkSession
    edges = keep(edges.distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = keep(nodes.select("node", F.col("node").alias("group")))
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("n"))
        moves = both.groupBy("a").agg(F.min(rank("b")).alias("to"))
        moves = keep(
            moves.select(F.col("a").alias("old"), F.least(F.col("to"), rank("a"))["n"].alias("new"))
        )
        for side in ("a", "b"):
            moved = edges.join(moves, edges[side] == moves["old"])
            other = "b" if side == "a" else "a"
            edges = moved.select(F.col("new").alias(side), other).select("a", "b")
        edges = keep(edges.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        ).distinct())
        labels = keep(
            labels.join(moves, labels["group"] == moves["old"], "left").select(
                "node", F.coalesce("new", "group").alias("group")
            )
        )
        turn += 1
    return labels if turn else spark.createDataFrame([], "node bigint, group bigint")


def _grouped(distinct: DataFrame) -> DataFrame:
    """fp and group of every distinct fingerprint; the group is one of its fingerprints."""
    label = groups(links(distinct.select("fp")))
    return distinct.join(label, distinct["fp"] == label["node"], "left").select(
        *distinct.columns, F.coalesce("group", "fp").alias("group")
    )


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """Id, fp (signed long) and component_id of every row."""
    marked = keep(fingerprints(df, id_col, text_col, shingle))
    distinct = keep(marked.groupBy("fp").agg(F.min("id").alias("least")))
    named = _grouped(distinct)
    least = keep(named.groupBy("group").agg(F.min("least").alias("component_id")))
    per = keep(named.select("fp", "group").join(least, "group").select("fp", "component_id"))
    return marked.join(per, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def survivors(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """The rows of which one stays per group: the one with the smallest id, nulls last.

    Rows stay or go by a number of their own, so null or repeated ids take no others along; of
    equal ids the row with the smaller hash of its text stays.  All columns are kept, whatever
    their names.
    """
    apart = Apart(df)
    rows = keep(apart.table.withColumn("row", F.monotonically_increasing_id()))
    text = F.col(apart[text_col])
    chosen = rows.select("row", F.col(apart[id_col]).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    prints = keep(marked(chosen, "text", shingle))
    order = F.struct(F.col("id").isNull().alias("last"), "id", "h", "row")
    distinct = keep(
        prints.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    )
    named = keep(_grouped(distinct))
    several = named.groupBy("group").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    several = several.where("n > 1").select("group", F.col("first.row").alias("stays"))
    per = named.select("fp", "group").join(several, "group")
    going = keep(prints.join(per, "fp").where("row <> stays").select("row"))
    # The list of rows that go is broadcast by the engine if it is small; else both are sorted.
    return apart.back(rows.join(going, "row", "left_anti"))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
