"""JSON lists of strings, read in byte ranges by as many tasks as a file has splits.

A list is read as text whose lines end with a quotation mark, so Spark's own reader splits the
file and every line belongs to one split.  Whether a mark opens or closes a string depends on all
before it in the file; that is found by a scan over the splits in two passes:

1. Each split cuts its lines into segments: a mark after an odd number of backslashes is
   part of a string and ends no segment.  Per split the segments are counted, and it is noted
   what would be wrong with them if the first one stood outside of a string, and if inside.
2. A running sum over a file's splits tells how many segments stand before each, hence which of
   its segments are strings (the odd ones) and their positions in the list.

A string with an escaped mark may go on from one split into the next, and the brackets stand at the
ends of the file.  Only the first and the last segment of a split can be such parts; they travel
with the summary of the split and are put together by their number in the file.  The summary is one row per split and is staged; it is
joined to the segments by the engine, which broadcasts it while it is small.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import json_text
from recordloom.operators.once import once
from recordloom.operators.pieces import PIECE_BYTES, pieces
from recordloom.shipping import ship_package
from recordloom.sinks.staging import stage

NOT_A_LIST = "is not a JSON list of strings"
_SPACE = r"[ \t\n\r]*"
# What a segment takes as Python objects besides its bytes.
_SEGMENT_BYTES = 256
_KINDS = {
    "path": pa.string(), "start": pa.int64(), "size": pa.int64(), "n": pa.int64(),
    "raw": pa.binary(), "ended": pa.bool_(), "edge": pa.bool_(), "n_bytes": pa.int64(),
}
_EDGE = list(_KINDS).index("edge")
_SCHEMA = (
    "path string, start long, size long, n long, raw binary, ended boolean, edge boolean, n_bytes long"
)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each split, numbered from 0: the first and the last one are its edges."""
    rows: list[list] = []
    split: tuple | None = None
    parts: list[bytes] = []
    n = held = 0

    def batch(found: list[list]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * len(_KINDS)
        arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS.values())]
        return pa.RecordBatch.from_arrays(arrays, names=list(_KINDS))

    def close(ended: bool) -> None:
        nonlocal n, held
        raw = b'"'.join(parts)
        rows.append([*split, n, raw, ended, n == 0, len(raw) + 1])
        held += len(raw) + _SEGMENT_BYTES
        n += 1
        parts.clear()

    def leave() -> None:
        if parts:
            close(ended=False)
        if rows:
            rows[-1][_EDGE] = True

    for lines in (piece for batch in batches for piece in pieces(batch)):
        paths, starts, sizes, values = (c.to_pylist() for c in lines.columns)
        for path, start, size, value in zip(paths, starts, sizes, values):
            if split != (path, start, size):
                leave()
                split, n = (path, start, size), 0
            parts.append(value)
            if (len(value) - len(value.rstrip(b"\\"))) % 2 == 0:
                close(ended=True)
                if held > PIECE_BYTES:
                    # The last one may yet prove to be an edge.
                    yield batch(rows[:-1])
                    del rows[:-1]
                    held = 0
    leave()
    yield batch(rows)


def decoded(raw: Column) -> Column:
    """The string that stands between two marks, NULL where that is no JSON string."""
    read = F.from_json(
        F.concat(F.lit('["'), raw, F.lit('"]')), T.ArrayType(T.VariantType()), json_text._STRICT_READER
    )
    text = F.when(F.size(read) == 1, F.try_variant_get(F.get(read, F.lit(0)), "$", "string"))
    return F.when(F.is_valid_utf8(raw), text)


def _between(raw: Column, first: Column, last: Column) -> Column:
    """Is this what may stand outside of the strings: bracket, comma, bracket?"""
    mark = (
        F.when(first & last, F.lit(r"\[" + _SPACE + r"\]"))
        .when(first, F.lit(r"\["))
        .when(last, F.lit(r"\]"))
        .otherwise(F.lit(","))
    )
    return F.regexp_like(raw, F.concat(F.lit(f"^{_SPACE}"), mark, F.lit(rf"{_SPACE}\z")))


class PromptLists:
    """The lists of one or more files, directories or globs."""

    def __init__(self, spark: SparkSession, paths: str | list[str]):
        self.spark, self.paths = spark, paths

    def _lines(self) -> DataFrame:
        ship_package(self.spark)
        lines = self.spark.read.text(self.paths, lineSep='"').select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary"),
        )
        found = lines.mapInArrow(_segments, _SCHEMA)
        return found.withColumn("raw", F.col("raw").cast("string"))

    @cached_property
    def _splits(self) -> DataFrame:
        """One row per split, staged: segments before it, what is wrong inside, its edges."""
        is_edge = F.col("edge")
        odd = F.col("n") % 2 == 1
        wrong = once(self._lines(), "_text", F.when(~is_edge, decoded(F.col("raw")).isNotNull()))
        never = F.lit(False)
        comma = F.when(~is_edge, _between(F.col("raw"), never, never))
        bad_text, bad_comma = ~F.col("_text"), ~comma
        per = wrong.groupBy("path", "start", "size").agg(
            F.count_if("ended").alias("n_ended"),
            F.sum("n_bytes").alias("n_bytes"),
            # Wrong segments if an even number of segments stands before the split, or an odd one.
            F.count_if((odd & bad_text) | (~odd & bad_comma)).alias("wrong_0"),
            F.count_if((~odd & bad_text) | (odd & bad_comma)).alias("wrong_1"),
            F.collect_list(F.when(is_edge, F.struct("n", "raw", "ended"))).alias("edges"),
        )
        along = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        return stage(per.withColumn("before", F.coalesce(F.sum("n_ended").over(along), F.lit(0))))

    @cached_property
    def _edges(self) -> DataFrame:
        """The segments at the edges of splits, put together: path, number, raw, ended."""
        parts = self._splits.select("path", "start", "before", F.explode("edges").alias("e")).select(
            "path", (F.col("before") + F.col("e.n")).alias("n"),
            F.struct("start", "e.n", "e.raw", "e.ended").alias("part"),
        )
        whole = parts.groupBy("path", "n").agg(F.sort_array(F.collect_list("part")).alias("parts"))
        return whole.select(
            "path", "n", F.array_join(F.transform("parts", lambda p: p["raw"]), '"').alias("raw"),
            F.exists("parts", lambda p: p["ended"]).alias("ended"),
        )

    @cached_property
    def files(self) -> DataFrame:
        """Per file ``path``, ``ok`` (the whole file is a list of strings) and ``n_prompts``; staged."""
        wrong = F.when(F.col("before") % 2 == 0, F.col("wrong_0")).otherwise(F.col("wrong_1"))
        per = self._splits.groupBy("path").agg(
            F.max("size").alias("size"), F.sum("n_bytes").alias("n_bytes"),
            F.sum("n_ended").alias("n_segments"), F.sum(wrong).alias("wrong"),
        )
        edges = self._edges.join(per.select("path", "n_segments"), "path")
        is_string, raw = F.col("n") % 2 == 1, F.col("raw")
        fine = F.when(is_string, decoded(raw).isNotNull()).otherwise(
            _between(raw, F.col("n") == 0, F.col("n") == F.col("n_segments") - 1)
        )
        edges = edges.groupBy("path").agg(F.count_if(~(F.col("ended") & fine)).alias("wrong_edges"))
        # The end of a file ends its last line as a mark would.
        ok = (
            (F.col("wrong") == 0) & (F.col("wrong_edges") == 0) & (F.col("n_segments") % 2 == 1)
            & (F.col("n_bytes") == F.col("size") + 1)
        )
        read = per.join(edges, "path").select(
            "path", ok.alias("ok"), F.when(ok, F.expr("(n_segments - 1) div 2")).otherwise(0).alias("n_prompts")
        )
        # Spark's readers skip files without a byte; they are in the listing that Spark holds.
        # Listing and scan write the same path with one slash or three.
        place = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/").alias("path")
        listed = [(p,) for p in self.spark.read.text(self.paths).inputFiles()]
        named = self.spark.createDataFrame(listed, "path string").select(place)
        empty = named.join(read.select(place), "path", "left_anti").select(
            "path", F.lit(False).alias("ok"), F.lit(0).cast("bigint").alias("n_prompts")
        )
        return stage(read.unionByName(empty))

    def prompts(self) -> DataFrame:
        """``path``, ``pos`` and ``prompt`` of every string; a file that is no list stops the query."""
        refused = F.raise_error(F.concat_ws(" ", "path", F.lit(NOT_A_LIST))).cast("boolean")
        wanted = F.when(F.col("ok"), F.col("n") % 2 == 1).otherwise(refused)
        files = self.files.select("path", "ok")
        splits = self._splits.select("path", "start", "before").join(files, "path")
        inside = self._lines().where("NOT edge").join(splits, ["path", "start"])
        inside = inside.withColumn("n", F.col("n") + F.col("before"))
        found = [rows.where(wanted).select("path", "n", "raw") for rows in (inside, self._edges.join(files, "path"))]
        return found[0].unionByName(found[1]).select(
            "path", F.expr("(n - 1) div 2").alias("pos"), decoded(F.col("raw")).alias("prompt")
        )


def _list_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of one task as the lines of one JSON list."""
    yield pa.RecordBatch.from_arrays([pa.array(["["])], names=["value"])
    before = ""
    for batch in (piece for given in batches for piece in pieces(given)):
        lines = [f"{before if i == 0 else ','}{line}" for i, line in enumerate(batch.column(0).to_pylist())]
        if lines:
            before = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines)], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])


def write_prompt_lists(prompts: DataFrame, path: str, prompt: str = "prompt") -> None:
    """Write prompts as JSON lists, one file and one list per task, in bounded memory."""
    ship_package(prompts.sparkSession)
    # An element of a list of one, without the brackets, is the JSON string.
    listed = F.to_json(F.array(F.col(prompt)))
    element = listed.substr(F.lit(2), F.length(listed) - 2).alias("value")
    prompts.where(F.col(prompt).isNotNull()).select(element).mapInArrow(
        _list_lines, "value string"
    ).write.mode("errorifexists").text(path)
