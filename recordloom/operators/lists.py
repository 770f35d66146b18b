"""Lists of records inside a record: child tables, optional fields and their defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.fields import fields_of
from recordloom.functions.rules import moved
from recordloom.operators.check import DOCUMENT, RECORD, find_violations
from recordloom.operators.once import once
from recordloom.schema import ddl_of


def list_items(
    parsed: DataFrame,
    path: str,
    *keep: str,
    document: str = DOCUMENT,
    at: str = RECORD,
    outer: bool = False,
) -> DataFrame:
    """Child table of a list inside a parsed document: ``keep`` columns, ``pos``, ``item``.

    ``outer`` keeps parents without items, with NULL ``pos`` and ``item``.
    """
    items = F.try_variant_get(document, moved(path, at), "array<variant>")
    explode = F.posexplode_outer if outer else F.posexplode
    listed = once(parsed, "_items", items)
    return listed.select(*keep, explode("_items").alias("pos", "item"))


def check_items(items: DataFrame, part: str, item: str = "item") -> DataFrame:
    """Violations and typed record of each list item, by the rules of ``part``."""
    checked = find_violations(items, part, text=None, document=item, at="$")
    is_valid = F.size("violations") == 0
    typed = with_defaults(F.try_variant_get(item, "$", ddl_of(part)), part, item)
    return (
        checked.withColumn("is_valid", is_valid)
        .withColumn("record", F.when(is_valid, typed))
        .drop(item)
    )


def with_defaults(record: Column, part: str, document: str) -> Column:
    """The part with its defaults: missing optional lists become empty, texts stay NULL.

    A list that is given as null in ``document``, the VARIANT column, stays NULL.
    """
    columns = []
    for f in fields_of(part):
        value = record[f.name]
        if f.optional and f.kind == "texts":
            missing = F.try_variant_get(document, f"$.{f.name}", "variant").isNull()
            value = F.when(missing, F.array().cast("array<string>")).otherwise(value)
        columns.append(value.alias(f.name))
    return F.when(record.isNotNull(), F.struct(*columns))


def explode_records(df: DataFrame, field: str, *keep: str, record: str = "record") -> DataFrame:
    """Child table of a typed list-of-record field, keeping parents without items."""
    return df.select(*keep, F.posexplode_outer(f"{record}.{field}").alias("pos", "item"))
