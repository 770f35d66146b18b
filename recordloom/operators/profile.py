"""Sketches of runs: latencies and offending values, small enough to keep and merged across runs.

A profile is one small row per run and group.  Quantile sketches (KLL) answer any rank within
a known error; item sketches count the most frequent values.  Both are formed within tasks
and only sketches are exchanged, so a hot group costs one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.operators.check import DOCUMENT, RECORD, find_violations, parse_text

# Size of the quantile sketches; ranks are then off by QUANTILE_ERROR at most, with 99 % certainty.
SKETCH_SIZE = 400
QUANTILE_ERROR = 0.0075
# Different values that one item sketch tracks; counts are exact below three quarters of it.
ITEMS = 4_096
# Longer values stand as their digest and length, so that a sketch's memory is bounded.
VALUE_LENGTH = 200
# Rules that judge a value; the others judge that there is none.
VALUE_RULES = ("type", "enum", "range")
RANKS = (0.0, 0.5, 0.9, 0.99, 1.0)


def latency_measures() -> list[Column]:
    """Aggregates of a profile, for a grouping or to be observed on rows on their way."""
    return [
        F.count(F.lit(1)).alias("n_requests"),
        F.count("generation_ms").alias("n_timed"),
        F.kll_sketch_agg_double(F.col("generation_ms").cast("double"), SKETCH_SIZE).alias("latency"),
    ]


def latency_profile(generated: DataFrame, run: str | Column, by: list[str] | None = None) -> DataFrame:
    """A row per value of ``by``: ``run``, ``n_requests``, ``n_timed`` and ``latency``, a sketch of
    ``generation_ms``.

    Requests without a time are counted in ``n_requests`` alone; without any time the sketch is
    of no values.  Save it with the run (a few kB a row) and merge it later.
    """
    run = F.lit(run) if isinstance(run, str) else run
    return generated.groupBy(run.alias("run"), *(by or [])).agg(*latency_measures())


def merged_latencies(profiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Profiles of several runs as one, a row per value of ``by``."""
    return profiles.groupBy(*(by or [])).agg(
        F.sum("n_requests").alias("n_requests"),
        F.sum("n_timed").alias("n_timed"),
        F.kll_merge_agg_double("latency").alias("latency"),
    )


def latency_quantiles(profiles: DataFrame, ranks: tuple[float, ...] = RANKS) -> DataFrame:
    """A row per profile row and rank: the profile's columns, ``rank`` and ``latency_ms``.

    Ranks 0 and 1 give the exact least and greatest time; profiles of no times give NULL.
    """
    names = [c for c in profiles.columns if c != "latency"]
    asked = F.array(*[F.lit(float(r)) for r in ranks])
    values = F.kll_sketch_get_quantile_double("latency", asked)
    # A sketch of no values has no quantiles to ask for.
    none = F.array_repeat(F.lit(None).cast("double"), len(ranks))
    values = F.when(F.col("n_timed") > 0, values).otherwise(none)
    return profiles.select(*names, F.inline(F.arrays_zip(asked, values)).alias("rank", "latency_ms"))


def _shown(value: Column) -> Column:
    """The value, or the digest and length of a long one: different values stay different."""
    digest = F.concat_ws(":", F.lit("sha256"), F.sha2(value, 256), F.length(value))
    return F.when(F.length(value) <= VALUE_LENGTH, value).otherwise(digest)


def offending_values(texts: DataFrame, text: str = "generated_text") -> DataFrame:
    """``path``, ``rule``, ``value`` (as JSON) of every value that breaks a rule, a row each.

    Positions in lists are left out of paths (``[*]``).  A missing value is not a value, null is.
    The text is parsed once, by the pass that checks it.
    """
    judged = find_violations(parse_text(texts, text), text=text)
    met = judged.select(DOCUMENT, F.explode("violations").alias("v")).where(
        F.col("v.rule").isin(*VALUE_RULES)
    )
    place = F.concat(F.lit(RECORD), F.expr("substring(v.path, 2)"))
    value = F.try_variant_get(F.col(DOCUMENT), place, "variant")
    return met.select(
        F.regexp_replace("v.path", r"\[[0-9]+\]", "[*]").alias("path"),
        F.col("v.rule").alias("rule"),
        _shown(F.to_json(value)).alias("value"),
    ).where("value IS NOT NULL")


def item_profile(values: DataFrame, run: str | Column, items: int = ITEMS) -> DataFrame:
    """A row per path and rule: ``run``, ``n`` values and ``frequent``, a sketch of the values."""
    run = F.lit(run) if isinstance(run, str) else run
    return values.groupBy(run.alias("run"), "path", "rule").agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k_accumulate(value, {int(items)})").alias("frequent"),
    )


def merged_items(profiles: DataFrame, items: int = ITEMS) -> DataFrame:
    """Item profiles of several runs as one, a row per path and rule."""
    return profiles.groupBy("path", "rule").agg(
        F.sum("n").alias("n"),
        F.expr(f"approx_top_k_combine(frequent, {int(items)})").alias("frequent"),
    )


def frequent_values(profiles: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent values of every path and rule: ``n`` of them, ``n_value`` of this one."""
    top = F.explode(F.expr(f"approx_top_k_estimate(frequent, {int(k)})")).alias("top")
    kept = [c for c in profiles.columns if c != "frequent"]
    return profiles.select(*kept, top).select(
        *kept, F.col("top.item").alias("value"), F.col("top.count").alias("n_value")
    )
