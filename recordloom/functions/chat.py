"""Chat messages and sampling settings of a request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SYSTEM_TEXT = (
    "You write realistic, varied sample records. Answer with one JSON object that "
    "follows the given schema, and with nothing else."
)


def chat_messages(prompt: Column, system_text: str = DEFAULT_SYSTEM_TEXT) -> Column:
    """ARRAY<STRUCT<role, content>>: a fixed system turn, then the prompt as user turn."""

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(turn("system", F.lit(system_text)), turn("user", prompt))


def _column(value: Column | float | None, data_type: str) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(data_type)


def greedy_top_p(temperature: Column, top_p: Column) -> Column:
    return F.when(temperature == 0.0, F.lit(1.0)).otherwise(top_p)


def greedy_top_k(temperature: Column, top_k: Column) -> Column:
    return F.when(temperature == 0.0, F.lit(-1)).otherwise(top_k)


def sampling_params(
    temperature: Column | float | None = 0.5,
    max_tokens: Column | int | None = 512,
    top_p: Column | float = 1.0,
    top_k: Column | int = -1,
    schema_text: str | None = None,
) -> Column:
    """Sampling STRUCT of a request; every setting may be a column or one value per run.

    No ``max_tokens`` means no limit.  A temperature of 0 means greedy choice, for which ``top_p`` and ``top_k`` are
    switched off.  ``guided_decoding.json`` is filled only when ``schema_text`` is given:
    the model step gets the schema once per task, rows need not carry it.
    """
    warmth = _column(temperature, "double")
    return F.struct(
        warmth.alias("temperature"),
        _column(max_tokens, "int").alias("max_tokens"),
        greedy_top_p(warmth, _column(top_p, "double")).alias("top_p"),
        greedy_top_k(warmth, _column(top_k, "int")).alias("top_k"),
        F.lit(False).alias("detokenize"),
        F.struct(F.lit(schema_text).cast("string").alias("json")).alias("guided_decoding"),
    )
