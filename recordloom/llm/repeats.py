"""Removal of long byte strings that occur more than once, by sorting sampled suffixes.

Suffix tuples and common prefixes decide, as in external induced sorting, but not of every
suffix: with a minimum length of ``LENGTH`` bytes it is enough to sort a sample and to
induce the suffixes around it.

* Sample.  The representative of a string of ``LENGTH`` bytes is the place in it whose next
  ``PREFIX`` bytes have the least hash.  Equal strings have it at the same distance, so
  they can only be equal if those prefixes are.  Starts with the same representative follow
  each other; together they form a block, about 70 starts on average.
* Sorted tuples.  (prefix, block content, document, start) of all blocks go through
  Spark's external sort and aggregation, whose spilled runs take the part of the disk-backed
  queues.  A prefix that occurs once ends there.  A block whose whole content occurs
  again is repeated in all its starts.
* Induction.  Where one prefix has several block contents, the common part is shorter than the
  block: one document of each content derives its starts' suffixes, cut at ``LENGTH``, from the
  sampled one, and these are compared in the same way.

So the tuples are a small part of all suffixes, hot prefixes are counted within tasks before
they shuffle, and no shard has to fit into memory.  Filters of bounded size (as in the exact
deduplication) keep what cannot matter out of the shuffles; texts move only if something is
removed from them or compared in them.

Defined results: null text counts as empty; texts shorter than ``LENGTH`` lose nothing;
overlaps count, also within one text; strings never cross texts; all strings are judged on the
input; repeated rows repeat each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import discard, keep
from recordloom.shipping import ship_package

LENGTH = 200
PREFIX = 64
# Bytes of one text that are looked at together.
_PIECE = 1 << 21
_PLACE_BITS = np.uint64(23)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ROWS_PER_WORD = 8
_MAX_WORDS = 1 << 22


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _prefix_hashes(data: np.ndarray, length: int) -> np.ndarray:
    if not _POWERS:
        _POWERS.append(_powers(_PIECE + LENGTH))
    up, down = _POWERS[0]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[length:] - sums[:-length]) * down[: len(data) - length + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def blocks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the prefix and first start of every block, in order.

    A long text is taken in pieces; a block that reaches over their border is two blocks
    there, so borders are at multiples of the piece from the text's start and only cost work.
    """
    names, starts = [], []
    n = len(text) - LENGTH + 1
    for at in range(0, n, _PIECE):
        data = np.frombuffer(text, np.uint8, min(_PIECE + LENGTH - 1, len(text) - at), at)
        h = _prefix_hashes(data, PREFIX)
        packed = (h >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        place = _least(packed, LENGTH - PREFIX + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))
        place = place.astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        names.append(h[place[first]].view(np.int64))
        starts.append(first + at)
    if not names:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(names), np.concatenate(starts)


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the prefixes, block contents, first and last starts of its blocks."""
    long_lists, digest = pa.list_(pa.int64()), xxhash.xxh3_64_intdigest
    for batch in batches:
        columns: tuple[list, ...] = ([], [], [], [])
        for text in batch.column(1):
            data = text.as_py().encode()
            names, first = blocks(data)
            last = np.append(first[1:], max(len(data) - LENGTH + 1, 0)) - 1
            content = [
                digest(data[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist())
            ] if len(first) else []
            last = last[: len(first)]
            for column, value in zip(columns, (names, _signed(content), first, last)):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, long_lists) for c in columns]],
            names=["k", "names", "contents", "first", "last"],
        )


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes, cut at the minimum length, of the blocks that are asked for."""
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for k, text, asked in zip(*(batch.column(i) for i in range(3))):
            data = text.as_py().encode()
            for part in asked.as_py():
                a, b = part["first"], part["last"] + 1
                n = b - a
                suffixes = _signed([digest(data[p : p + LENGTH]) for p in range(a, b)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, k.as_py())),
                        pa.array(np.full(n, part["name"])),
                        pa.array(suffixes),
                        pa.array(np.arange(a, b, dtype=np.int32)),
                        pa.array(np.full(n, part["weight"], dtype=np.int32)),
                    ],
                    names=["k", "name", "suffix", "start", "weight"],
                )


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without what is covered."""
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            data = text.as_py().encode()
            edges = np.zeros(len(data) + 1, dtype=np.int64)
            if spans.is_valid:
                np.add.at(edges, spans.values.field("s").to_numpy(), 1)
                np.add.at(edges, spans.values.field("e").to_numpy(), -1)
            gone = np.cumsum(edges[:-1]) > 0
            rest = np.frombuffer(data, np.uint8)[~gone].tobytes()
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) and gone[0])
            out.append((len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _bits(key: Column) -> Column:
    one, h = F.lit(1).cast("long"), F.xxhash64(key, F.lit(7))
    shifted = [
        F.call_function(
            "shiftleft", one, F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int")
        )
        for at in (0, 20, 40)
    ]
    return shifted[0].bitwiseOR(shifted[1]).bitwiseOR(shifted[2])


def _flagged(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: false only where ``key`` is surely not among ``keys``.

    The filter has a word per few keys, ``_MAX_WORDS`` at most: 64 MB if all are in use.
    """
    n, words = keys.count(), 1 << 10
    while words < min(n // _ROWS_PER_WORD, _MAX_WORDS):
        words *= 2
    word = lambda c: F.xxhash64(c).bitwiseAND(F.lit(words - 1))
    k = F.col(keys.columns[0])
    held = keep(keys.groupBy(word(k).alias("_w")).agg(F.bit_or(_bits(k)).alias("_held")))
    found = df.withColumn("_at", word(F.col(key))).join(
        F.broadcast(held), F.col("_at") == F.col("_w"), "left"
    )
    mine = _bits(F.col(key))
    flag = F.coalesce(F.col("_held").bitwiseAND(mine) == mine, F.lit(False))
    return found.withColumn(name, flag).drop("_w", "_at", "_held")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    ship_package(df.sparkSession)
    texts = df.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("k", F.xxhash64("text"))
    per_text = keep(
        texts.select("k", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(
            _block_batches,
            "k long, names array<long>, contents array<long>, first array<long>, last array<long>",
        )
    )
    names = per_text.select(F.explode("names").alias("name"))
    twice = keep(names.groupBy("name").count().where("count > 1").select("name"))
    rows = per_text.select(
        "k", F.explode(F.arrays_zip("names", "contents", "first", "last")).alias("b")
    ).select("k", F.col("b.names").alias("name"), F.col("b.contents").alias("content"),
             F.col("b.first").cast("int").alias("first"), F.col("b.last").cast("int").alias("last"))
    rows = keep(_flagged(rows, "name", twice, "maybe").where("maybe").drop("maybe"))
    discard(per_text)
    contents = keep(
        rows.groupBy("name", "content").agg(
            F.count("*").alias("n"), F.min(F.struct("k", "first", "last")).alias("one")
        )
    )
    # Blocks that occur again as a whole.
    whole = keep(contents.where("n > 1").select("name", "content"))
    spans = rows.join(whole, ["name", "content"]).select(
        "k", F.col("first").alias("s"), (F.col("last") + LENGTH).alias("e")
    ).distinct()
    # Prefixes with several block contents.
    several = keep(contents.groupBy("name").count().where("count > 1").select("name"))
    asked = contents.join(several, "name").select(
        "one.k", "name", "one.first", "one.last", F.least("n", F.lit(2).cast("long")).alias("weight")
    )
    asked = keep(
        asked.groupBy("k").agg(F.collect_list(F.struct("name", "first", "last", "weight")).alias("asked"))
    )
    needed = _flagged(texts.select("k", "text"), "k", asked.select("k"), "maybe").where("maybe")
    joined = needed.select("k", "text").dropDuplicates(["k"]).join(asked, "k")
    suffixes = keep(
        joined.select("k", "text", "asked").mapInArrow(
            _window_batches, "k long, name long, suffix long, start int, weight int"
        )
    )
    again = keep(
        suffixes.groupBy("name", "suffix").agg(F.sum("weight").alias("n")).where("n > 1")
        .select("name", "suffix")
    )
    single = suffixes.where("weight = 1").withColumn("both", F.xxhash64("name", "suffix"))
    keys = again.select(F.xxhash64("name", "suffix").alias("both"))
    single = _flagged(single, "both", keys, "maybe").where("maybe")
    induced = single.select("k", "name", "suffix", "start").join(again, ["name", "suffix"])
    spans = spans.unionByName(
        induced.select("k", F.col("start").alias("s"), (F.col("start") + LENGTH).alias("e"))
    )
    cuts = keep(spans.groupBy("k").agg(F.collect_list(F.struct("s", "e")).alias("spans")))
    discard(suffixes)
    discard(rows)
    marked = _flagged(texts, "k", cuts.select("k"), "maybe")
    cut_rows = marked.where("maybe").join(cuts, "k", "left").select("id", "text", "spans")
    columns = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    cut = cut_rows.mapInArrow(_cut_batches, columns)
    nothing = F.lit(0).cast("long")
    plain = marked.where("NOT maybe").select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"),
        nothing.alias("n_removed"), nothing.alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )
    return plain.unionByName(cut).withColumnRenamed("id", id_col)
