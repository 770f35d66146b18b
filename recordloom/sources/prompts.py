"""Prompt lists (JSON files) and prompt tables.

Both give ``prompt_id`` and ``prompt``; the id is fixed here, before any exchange, so that
a retried or repeated task finds the same ids.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.functions import json_text
from recordloom.operators.once import once
from recordloom.sinks.staging import scratch_path
from recordloom.sources.prompt_lists import NOT_A_LIST, PromptLists


class PromptFiles(NamedTuple):
    """What a check of prompt files counted on its way."""

    n_files: int
    n_prompts: int


class PromptFileError(ValueError):
    """Prompt files that are not JSON lists of strings; ``table`` lists path and reason of all."""

    def __init__(self, n_files: int, table: str):
        super().__init__(f"{n_files} prompt files are no JSON lists of strings, see {table}")
        self.n_files = n_files
        self.table = table


def prompt_id(*parts: Column) -> Column:
    """Stable id of a prompt from what identifies it; a JSON list keeps nulls and parts apart."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def explode_prompt_lists(lists: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` columns, ``pos`` and ``prompt`` of every string in each row's list.

    Verdict and elements come from the row's own text, so nothing is grouped or joined.  A
    row that is not a list of strings stops the query, whichever rows are asked for.
    """
    source = F.col(text)
    refused = F.concat_ws(" ", *[F.col(k) for k in keep], F.lit(NOT_A_LIST))
    prompts = (
        F.when(~json_text.is_string_list(source, "_elements"), F.raise_error(refused))
        .when(json_text.is_empty_list(source), F.array().cast("array<string>"))
        .otherwise(json_text.string_elements("_elements"))
    )
    parsed = once(lists, "_elements", json_text.prompt_list(source))
    return once(parsed, "_prompts", prompts).select(
        *keep, F.posexplode("_prompts").alias("pos", "prompt")
    )


def read_prompts(
    spark: SparkSession, paths: str | list[str] | PromptLists, partitions: int | None = None
) -> DataFrame:
    """Prompts of one or more JSON list files: ``prompt_id``, ``path``, ``pos``, ``prompt``.

    ``paths`` may be files, directories or globs, or the lists that
    :func:`check_prompt_files` has scanned already.  A file is read by as many tasks as it has
    splits.  Reading a file that is not a list of strings fails; :func:`check_prompt_files` finds
    all of them beforehand.  ``partitions`` deals the prompts out anew afterwards.
    """
    lists = paths if isinstance(paths, PromptLists) else PromptLists(spark, paths)
    rows = lists.prompts()
    identity = prompt_id(F.col("path"), F.col("pos"), F.col("prompt"))
    prompts = rows.select(identity.alias("prompt_id"), "path", "pos", "prompt")
    return prompts if partitions is None else prompts.repartition(partitions)


def check_prompt_files(spark: SparkSession, paths: str | list[str] | PromptLists) -> PromptFiles:
    """Check every file before any model runs; counts of files and prompts, or an error.

    A missing path raises Spark's own PATH_NOT_FOUND error.  Bad files, empty ones among
    them, are all written to a table that the error names.
    """
    lists = paths if isinstance(paths, PromptLists) else PromptLists(spark, paths)
    totals = lists.files.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("ok")).alias("bad"),
        F.coalesce(F.sum("n_prompts"), F.lit(0)).alias("n_prompts"),
    ).first()
    if totals["bad"]:
        table = scratch_path(spark, "bad-prompt-files")
        reason = F.concat_ws(" ", "path", F.lit(NOT_A_LIST)).alias("reason")
        lists.files.where(~F.col("ok")).select("path", reason).write.parquet(table)
        raise PromptFileError(totals["bad"], table)
    return PromptFiles(totals["n"], totals["n_prompts"])


def prompts_from_table(
    table: DataFrame, prompt: str = "prompt", id_columns: tuple[str, ...] | list[str] = ()
) -> DataFrame:
    """Prompts of a table: ``prompt_id``, the id columns and ``prompt``.

    The scan's splits are kept.  Without id columns the id is that of the text, so equal
    prompts share one.  A NULL prompt stops the query, as a non-string in a list does.
    """
    data_type = table.schema[prompt].dataType
    if not isinstance(data_type, T.StringType):
        raise TypeError(f"column {prompt} is {data_type.simpleString()}, prompts are strings")
    # A filter, so that the error cannot be pruned away with the column.
    refused = F.raise_error(F.lit(f"column {prompt} holds NULL")).cast("boolean")
    table = table.where(F.when(F.col(prompt).isNotNull(), True).otherwise(refused))
    keys = [F.col(c) for c in id_columns] or [F.col(prompt)]
    return table.select(prompt_id(*keys).alias("prompt_id"), *id_columns, F.col(prompt).alias("prompt"))


def read_prompt_lines(
    spark: SparkSession, paths: str | list[str], prompt: str = "prompt"
) -> DataFrame:
    """Prompts of JSON Lines files, one object per line; anything but a string is an error.

    A line is judged as a whole, like a record: text around the object, a list, a repeated
    key or a value that is no string stops the query.  Blank lines are skipped.
    """
    line = F.col("value")
    lines = once(
        spark.read.text(paths).where(line.rlike(r"[^ \t\r]")),
        "_document",
        json_text.whole_document(line),
    )
    place = f"$[0]['{prompt}']"
    kind = F.schema_of_variant(F.try_variant_get("_document", place, "variant"))
    text = F.when(
        json_text.is_whole(F.col("_document"), line) & (kind == "STRING"),
        F.try_variant_get("_document", place, "string"),
    )
    return prompts_from_table(once(lines, "_text", text).select(F.col("_text").alias(prompt)), prompt)
