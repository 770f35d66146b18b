"""Parsed documents as tables of nodes, to any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.operators.once import once
from recordloom.sinks.staging import stage

NODE = ["path", "depth", "kind", "n_children", "text"]


def kind_of(value: Column) -> Column:
    """object, array, string, number, boolean or null; NULL where there is no value."""
    found = F.schema_of_variant(value)
    return (
        F.when(found.startswith("OBJECT<"), "object")
        .when(found.startswith("ARRAY<"), "array")
        .when(found == "STRING", "string")
        .when(found == "BOOLEAN", "boolean")
        .when(found == "VOID", "null")
        .when(found.isNotNull(), "number")
    )


def _children(value: str, path: str, kind: str) -> Column:
    """ARRAY<STRUCT<path, value>> of what an object or a list holds; empty for other values."""
    return F.expr(f"""
    CASE `{kind}`
    WHEN 'object' THEN transform(
        map_entries(try_variant_get(`{value}`, '$', 'map<string,variant>')),
        e -> named_struct('path', concat(`{path}`, '.', e.key), 'value', e.value))
    WHEN 'array' THEN transform(
        try_variant_get(`{value}`, '$', 'array<variant>'),
        (x, i) -> named_struct('path', concat(`{path}`, '[', i, ']'), 'value', x))
    ELSE cast(array() AS array<struct<path: string, value: variant>>) END""")


def nodes(df: DataFrame, value: str, *keep: str) -> DataFrame:
    """One row per node of the VARIANT column ``value``: ``keep`` columns and ``NODE``.

    ``path`` starts at ``$``; ``text`` is that of strings, numbers and booleans.  Objects and
    lists are nodes themselves, so a list without items is kept, with 0 children.  Rows without
    a value have no node.

    The table is taken apart level by level: a level is written, its children are the next one,
    and the first level without children is the last.  So there are as many rounds as the
    deepest document has levels, none of them moves rows between tasks, and a level that is
    wide is as many rows, not a row that grows.
    """
    taken = {c.lower() for c in keep} & {*NODE, "value", "children"}
    if taken:
        raise ValueError(f"columns {sorted(taken)} would be overwritten; rename them first")
    root = df.where(F.col(value).isNotNull())
    level = root.select(*keep, F.lit("$").alias("path"), F.col(value).alias("value"))
    found: DataFrame | None = None
    depth = 0
    while True:
        typed = once(level, "kind", kind_of(F.col("value")))
        parted = once(typed, "children", _children("value", "path", "kind"))
        plain = F.when(
            F.col("kind").isin("string", "number", "boolean"),
            F.try_variant_get("value", "$", "string"),
        )
        here = stage(
            parted.select(
                *keep, "path", F.lit(depth).alias("depth"), "kind",
                F.size("children").alias("n_children"), plain.alias("text"), "children",
            )
        )
        rows = here.select(*keep, *NODE)
        found = rows if found is None else found.unionByName(rows)
        if here.where("n_children > 0").isEmpty():
            return found
        level = here.select(*keep, F.explode("children").alias("c")).select(*keep, "c.path", "c.value")
        depth += 1
