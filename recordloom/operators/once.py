"""Compute an expensive column exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever follows.

    A filter above a plain projection is moved below it with the column's expression
    copied into the filter, so an expensive column would be computed twice, or as often as
    the copy mentions it; an explode adds such a filter by itself.  Nothing is moved below
    a generator's output, hence the explode of a one-element array: still one row per row,
    in the same stage.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
