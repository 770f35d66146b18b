"""Removal of long repeated word spans by compacting the De Bruijn graph of token k-mers.

Edges of the graph are windows of ``K`` consecutive words, its nodes the K - 1 words that two
windows share.  A window repeats if it starts in documents of different ids; in all but the one
with the smallest id its words go.

Super-k-mers: each window has a minimizer, the least hash of its runs of ``SEED_WORDS`` words.
Consecutive windows of one document with the same minimizer (at most K - SEED_WORDS + 1) form a
piece, a path of edges that travels as one row: its source coordinates (id, hash of the text,
first word, number of windows) and the 128-bit hash of its words.  Equal windows have equal
minimizers, so all that can equal a window lies in pieces of the same minimizer, and pieces of a
minimizer that occurs under one id only are left out of the graph.

Compaction: where a minimizer has a single piece, the path inside it does not branch and all its
windows first occur where the piece does.  A piece is joined to the one at its end if they occur
equally often and the one always follows the other: they share a node that does not branch.
The join is made on the coordinates of first sources, so joined pieces are found side by
side in one text, and a maximal chain of them is a path.  Only the head of a path is
matched with its occurrences afterwards; the path's length tells the rest.

Branching: where a minimizer has several pieces, the words of each distinct piece are read at
its first source's coordinates, its hash is checked against them, and its windows are compared
one by one by their 128-bit hashes.

Copies of a passage cost one row each per path; a passage that a third of all documents
hold is counted within tasks and split by the engine where its rows are joined.  The
graph's tables are staged and deleted when the next one stands; nothing is broadcast by hand.

Defined results: null text has no words; documents without id keep all words and make no one
else's go; rows that share an id do not repeat each other, and rows of equal id and text
get equal results; texts of fewer than K words keep all; words are compared as bytes, unchanged;
other columns are not read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import discard, keep
from recordloom.shipping import ship_package

K = 50
SEED_WORDS = 16
_FACTORS = np.random.RandomState(42).randint(0, 1 << 32, (2, SEED_WORDS)).astype(np.uint64)
_FACTORS = (_FACTORS[0] << np.uint64(32) | _FACTORS[1]) | np.uint64(1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


class Words:
    """The words of a text and their places in the text joined by single spaces."""

    def __init__(self, text: bytes | None):
        self.words = (text or b"").split()
        self.line = b" ".join(self.words)
        ends = np.flatnonzero(np.frombuffer(self.line, np.uint8) == 32)
        self.starts = np.concatenate([[0], ends + 1])
        self.ends = np.concatenate([ends, [len(self.line)]])

    def digests(self, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """128-bit hashes, as two longs, of n[i] words from first[i] on."""
        line, digest = self.line, xxhash.xxh3_128_digest
        a, b = self.starts[first].tolist(), self.ends[first + n - 1].tolist()
        return np.frombuffer(
            b"".join([digest(line[x:y]) for x, y in zip(a, b)]), dtype="<i8"
        ).reshape(-1, 2)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    done, out = 1, values
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def pieces(words: list[bytes], k: int, seed_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows and minimizer of a text's super-k-mers."""
    digest = xxhash.xxh3_64_intdigest
    hashed = np.array([digest(w) for w in words], dtype=np.uint64)
    runs = len(words) - seed_words + 1
    mixed = np.zeros(runs, dtype=np.uint64)
    for j in range(seed_words):
        mixed += hashed[j : j + runs] * _FACTORS[j]
    mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(29)
    width = k - seed_words + 1
    least = _least(mixed, width)
    at = np.arange(len(least))
    new = np.concatenate([[True], least[1:] != least[:-1]])
    run_start = np.maximum.accumulate(np.where(new, at, 0))
    starts = np.flatnonzero((at - run_start) % width == 0)
    return starts, np.diff(np.append(starts, len(least))), least[starts].view(np.int64)


def _piece_batches(k: int, seed_words: int):
    names = ["id", "h", "p", "n", "m", "c1", "c2", "next"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(2).cast(pa.binary())):
                text = Words(text.as_py())
                if len(text.words) < k:
                    continue
                start, n, least = pieces(text.words, k, seed_words)
                content = text.digests(start, n + k - 1)
                rows.append(np.full(len(start), row))
                found.append(np.column_stack([start, n, least, content, np.roll(content[:, 0], -1)]))
                found[-1] = np.column_stack([found[-1], np.arange(len(start)) == len(start) - 1])
            at = np.concatenate(rows) if rows else np.empty(0, np.int64)
            cells = np.concatenate(found) if found else np.empty((0, 7), np.int64)
            taken = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken), batch.column(1).take(taken),
                    *[pa.array(np.ascontiguousarray(cells[:, i])) for i in range(5)],
                    pa.array(np.ascontiguousarray(cells[:, 5]), mask=cells[:, 6] == 1),
                ],
                names=names,
            )

    return find


def _window_batches(k: int):
    """The windows of the distinct pieces listed for a text, read at their coordinates."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, (text, listed) in enumerate(
                zip(batch.column(1).cast(pa.binary()), batch.column(2))
            ):
                text = Words(text.as_py())
                cells = np.array(
                    [(x["p"], x["n"], x["c1"], x["c2"]) for x in listed.as_py()], dtype=np.int64
                )
                if (text.digests(cells[:, 0], cells[:, 1] + k - 1) != cells[:, 2:]).any():
                    raise ValueError("a piece is not what stands at its source's coordinates")
                n = cells[:, 1]
                offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                window = text.digests(np.repeat(cells[:, 0], n) + offset, np.full(len(offset), k))
                rows.append(np.full(len(offset), row))
                found.append(np.column_stack([np.repeat(cells[:, 2:], n, axis=0), offset, window]))
            at = np.concatenate(rows) if rows else np.empty(0, np.int64)
            cells = np.concatenate(found) if found else np.empty((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    *[pa.array(np.ascontiguousarray(cells[:, i])) for i in range(5)],
                ],
                names=["id", "c1", "c2", "o", "w1", "w2"],
            )

    return find


def _cut_batches(k: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, gone, kept, spans = [], [], [], []
            for text, listed in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
                words = (text.as_py() or b"").split()
                runs: list[dict[str, int]] = []
                for x in sorted(listed.as_py() or (), key=lambda x: x["p"]):
                    end = x["p"] + x["n"] + k - 1
                    if runs and x["p"] <= runs[-1]["start"] + runs[-1]["n_words"]:
                        last = runs[-1]
                        last["n_words"] = max(last["n_words"], end - last["start"])
                    else:
                        runs.append({"start": x["p"], "n_words": end - x["p"]})
                edges = [0, *(e for r in runs for e in (r["start"], r["start"] + r["n_words"])), len(words)]
                parts = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]] if runs else words
                totals.append(len(words))
                gone.append(len(words) - len(parts))
                kept.append(b" ".join(parts))
                spans.append(runs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()),
                    pa.array(spans, _SPANS), pa.array(kept, pa.binary()).view(pa.string()),
                ],
                names=[batch.schema.names[0], "n_words", "n_removed", "spans", "kept"],
            )

    return cut


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64())]))


def paths(found: DataFrame) -> DataFrame:
    """The maximal paths of pieces that do not branch: c1, c2 of the head, first id and windows.

    ``found`` holds all occurrences of pieces that are alone under their minimizer.
    """
    source = F.min(F.struct("id", "h", "p", "n")).alias("source")
    stood = found.groupBy("c1", "c2").agg(
        source, F.count("*").alias("times"), F.count("next").alias("followed"),
        F.min("next").alias("next"), F.max("next").alias("other_next"),
    )
    stood = keep(stood.select("c1", "c2", "source.*", "times", "followed", "next", "other_next"))
    before = stood.where("followed = times AND next = other_next").select(
        "id", "h", (F.col("p") + F.col("n")).alias("p"), F.col("times").alias("before_times"),
        F.col("next").alias("c1"),
    )
    joined = stood.join(before, ["id", "h", "p", "c1"], "left").withColumn(
        "starts", F.when(F.col("before_times") == F.col("times"), 0).otherwise(1)
    )
    along = Window.partitionBy("id", "h").orderBy("p")
    numbered = joined.withColumn("path", F.sum("starts").over(along))
    head = F.min(F.struct("p", "c1", "c2")).alias("head")
    whole = numbered.groupBy("id", "h", "path").agg(head, F.sum("n").alias("n"))
    return whole.select("head.c1", "head.c2", F.col("id").alias("first"), "n")


def _branching(texts: DataFrame, found: DataFrame, id_type: T.DataType, k: int) -> DataFrame:
    """Pieces that share their minimizer with others: c1, c2, first id, windows and the windows
    (``offsets``) that an earlier document holds in another piece."""
    source = F.min(F.struct("id", "h", "p", "n")).alias("source")
    distinct = keep(found.groupBy("c1", "c2").agg(source).select("c1", "c2", "source.*"))
    listed = distinct.groupBy("id", "h").agg(
        F.collect_list(F.struct("p", "n", "c1", "c2")).alias("listed")
    )
    read = texts.join(listed, ["id", "h"]).select("id", "text", "listed")
    kinds = [("id", id_type), *((c, T.LongType()) for c in ("c1", "c2", "o", "w1", "w2"))]
    schema = T.StructType([T.StructField(c, t) for c, t in kinds])
    windows = keep(read.mapInArrow(_window_batches(k), schema))
    least = windows.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("last"))
    least = least.where("least < last").drop("last")
    later = windows.join(least, ["w1", "w2"]).where("least < id")
    offsets = later.groupBy("c1", "c2").agg(F.collect_set("o").alias("offsets"))
    done = distinct.join(offsets, ["c1", "c2"], "left").select(
        "c1", "c2", F.col("id").alias("first"), "n", "offsets"
    )
    done = keep(done)
    discard(windows)
    discard(distinct)
    return done


def remove_repeated_spans(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    seed_words: int = SEED_WORDS,
) -> DataFrame:
    """Id, n_words, n_removed, spans (start, n_words: what goes) and kept (text) of every row."""
    if not 0 < seed_words <= k:
        raise ValueError(f"seed_words must be from 1 to {k}, not {seed_words}")
    ship_package(df.sparkSession)
    id_type = df.select(id_col).schema[0].dataType
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.select("id", F.xxhash64("text").alias("h"), "text")
    kinds = [("id", id_type), *((c, T.LongType()) for c in ("h", "p", "n", "m", "c1", "c2", "next"))]
    schema = T.StructType([T.StructField(c, t) for c, t in kinds])
    every = keep(texts.where("id IS NOT NULL").mapInArrow(_piece_batches(k, seed_words), schema))
    content = F.struct("c1", "c2")
    shared = every.groupBy("m").agg(
        F.min("id").alias("a"), F.max("id").alias("b"),
        (F.min(content) != F.max(content)).alias("branches"),
    )
    graph = keep(every.join(shared.where("a < b").select("m", "branches"), "m").drop("m"))
    discard(every)
    alone = paths(graph.where(~F.col("branches")))
    mixed = _branching(texts, graph.where("branches"), id_type, k)
    none = F.lit(None).cast(T.ArrayType(T.LongType())).alias("offsets")
    verdicts = alone.select("*", none).unionByName(mixed)
    found = graph.select("id", "h", "p", "c1", "c2").join(verdicts, ["c1", "c2"])
    one = F.transform("offsets", lambda o: F.struct((F.col("p") + o).alias("p"), F.lit(1).cast("long").alias("n")))
    going = F.when(F.col("id") > F.col("first"), F.array(F.struct("p", "n"))).when(
        F.col("id") == F.col("first"), one
    )
    spans = found.select("id", "h", F.explode(going).alias("s")).groupBy("id", "h").agg(
        F.collect_set("s").alias("spans")
    )
    spans = keep(spans)
    discard(graph)
    marked = texts.join(spans, ["id", "h"], "left").select(F.col("id").alias(id_col), "text", "spans")
    out = T.StructType(
        [
            T.StructField(id_col, id_type), T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([
                T.StructField("start", T.LongType()), T.StructField("n_words", T.LongType())]))),
            T.StructField("kept", T.StringType()),
        ]
    )
    return marked.mapInArrow(_cut_batches(k), out)


_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

OP12_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), windows AS (
  SELECT r, doc_id, p, md5(array_to_string(ws[p : p + {K} - 1], ' ')) AS w
  FROM (SELECT *, unnest(range(1, len(ws) - {K} + 2)) AS p FROM docs)
), firsts AS (
  SELECT w, min(doc_id) AS least FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)
), going AS (
  SELECT DISTINCT r, unnest(range(p, p + {K})) AS i
  FROM windows JOIN firsts USING (w) WHERE doc_id > least
), gone AS (
  SELECT r, list(i) AS places, count(*) AS n FROM going GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN ws ELSE
         list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(places, i)),
                        lambda i: ws[i]) END, ' ')) AS kept_sha256
FROM docs LEFT JOIN gone USING (r)
"""
