"""Counts and rates of a run."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

# Rule names of violations.
RULES = ("json_object", "too_large", "required", "type", "enum", "range")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs, without a job of its own.

    Put it where rows leave for the sink, with no exchange behind it: rows of a lost map
    stage would be counted again.  ``observation.get["n"]`` waits for the action.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def _breaking(rule: str) -> Column:
    return F.size(F.filter("violations", lambda v: v["rule"] == rule))


def check_counted(checked: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Total, valid, rejected and per-rule counts of checked records, on the way to a sink."""
    seen = Observation(name)
    return (
        checked.observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_valid").alias("n_valid"),
            F.count_if(~F.col("is_valid")).alias("n_rejected"),
            *[F.sum(_breaking(rule)).alias(rule) for rule in RULES],
        ),
        seen,
    )


def run_summary(checked: DataFrame) -> DataFrame:
    """One row: total, valid, rejected."""
    return checked.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_valid").alias("n_valid"),
        F.count_if(~F.col("is_valid")).alias("n_rejected"),
    )


def violation_summary(checked: DataFrame) -> DataFrame:
    """Violations per rule; counted within each task first, so few rows are exchanged."""
    return (
        checked.select(F.explode("violations").alias("violation"))
        .groupBy(F.col("violation.rule").alias("rule"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def throughput(generated: DataFrame, wall_seconds: float | None = None) -> DataFrame:
    """One row: requests, failures, tokens and tokens per second of model time.

    Model time is summed over tasks; with ``wall_seconds`` the rate of the whole run comes
    along.  Everything is read from columns: worker-side counters are lost when a limit
    ends a task early.
    """
    tokens = F.coalesce(F.sum("n_output_tokens"), F.lit(0))
    seconds = F.sum("generation_ms") / 1000.0
    wall = F.lit(wall_seconds).cast("double")
    return generated.agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count("generation_error").alias("n_failed"),
        tokens.alias("n_output_tokens"),
        seconds.alias("model_seconds"),
        F.try_divide(tokens, seconds).alias("tokens_per_model_second"),
        F.try_divide(tokens, wall).alias("tokens_per_second"),
    )


def preview(df: DataFrame, n: int) -> Iterator[Row]:
    """The first rows, fetched partition by partition; for looking, never for saving."""
    return df.limit(n).toLocalIterator()
