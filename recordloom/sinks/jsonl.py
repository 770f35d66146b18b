"""Result rows and the JSON Lines sink."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names of result and sink rows.
RESULT_COLUMN = "generated_json_string"
SINK_COLUMN = "generated_output_json_string"

# Keep null as an explicit key and escape everything outside ASCII.
_WRITER = {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"}


def result_rows(generated: DataFrame, provenance: bool = True) -> DataFrame:
    """The generated text under its result name, with ``prompt_id`` unless told otherwise."""
    kept = ["prompt_id"] if provenance and "prompt_id" in generated.columns else []
    return generated.select(*kept, F.col("generated_text").alias(RESULT_COLUMN))


def sink_rows(results: DataFrame) -> DataFrame:
    """The one column that is saved; results without text keep their row as null."""
    text = F.col(RESULT_COLUMN) if RESULT_COLUMN in results.columns else F.lit(None)
    return results.select(text.cast("string").alias(SINK_COLUMN))


def run_name(job_id: str, moment: datetime) -> str:
    return f"records_{job_id}_{moment:%Y%m%d_%H%M%S}"


def write_jsonl(
    rows: DataFrame,
    path: str,
    *,
    single_file: bool = False,
    compression: str | None = None,
    again: bool = False,
) -> None:
    """Write rows as JSON Lines part files, by the executors.

    An existing path is an error unless it is written ``again``.

    ``single_file`` funnels everything through one task: for small results only.
    """
    if single_file:
        rows = rows.coalesce(1)
    writer = rows.write.mode("overwrite" if again else "errorifexists").options(**_WRITER)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def read_jsonl(spark, path: str, schema: str = f"{SINK_COLUMN} string") -> DataFrame:
    return spark.read.schema(schema).json(path)
