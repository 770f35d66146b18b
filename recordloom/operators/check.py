"""Check generated text against the record's rules, parse it, split and flatten it.

All of it is narrow: no step here shuffles, groups or calls Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.fields import ROOT, fields_of
from recordloom.functions import json_text, rules
from recordloom.operators.once import once
from recordloom.schema import ddl_of, leaf_paths

DOCUMENT = "_document"
_LEAVES, _VERDICTS = "_leaves", "_verdicts"
# Where the record sits in the document (see json_text.whole_document).
RECORD = "$[0]"


def parse_text(df: DataFrame, text: str = "generated_text") -> DataFrame:
    """Add ``_document``, the parsed text; all rules share this one parse."""
    return once(df, DOCUMENT, json_text.whole_document(F.col(text)))


def is_one_object(text: str = "generated_text") -> Column:
    """Truth of "this text is exactly one JSON object" (never NULL), after parse_text."""
    found = F.schema_of_variant(F.try_variant_get(DOCUMENT, RECORD, "variant"))
    is_object = F.coalesce(found.startswith("OBJECT<"), F.lit(False))
    return json_text.is_whole(F.col(DOCUMENT), F.col(text)) & is_object


def find_violations(
    parsed: DataFrame,
    part: str = ROOT,
    extended: bool = False,
    *,
    text: str | None = "generated_text",
    document: str = DOCUMENT,
    at: str = RECORD,
    name: str = "violations",
) -> DataFrame:
    """Add ``violations`` ARRAY<STRUCT<path, rule>> for a VARIANT column.

    Rules: ``json_object`` (not one whole object), ``too_large`` (a text too long to be read),
    ``required``, ``type``, ``enum`` and ``range`` (a whole number beyond 64 bits), at
    most one per path; lists of records are judged item by item.  Extra keys are legal.  ``text`` names the text the document was
    parsed from; None for values that came out of a document already.
    """
    rule_set = rules.RuleSet(document, part, extended, at, _LEAVES, _VERDICTS)
    accepted, refused = rule_set.is_object(), "'json_object'"
    if text is not None:
        refused = f"CASE WHEN {json_text.is_too_large(text)} THEN 'too_large' ELSE {refused} END"
        accepted = json_text.is_whole(F.col(document), F.col(text)) & accepted
    judged = parsed.withColumn(_LEAVES, rule_set.leaf_verdicts()).withColumn(
        _VERDICTS, rule_set.all_verdicts(accepted)
    )
    return once(judged.drop(_LEAVES), name, rule_set.violations(refused)).drop(_VERDICTS)


def check_records(
    df: DataFrame, text: str = "generated_text", part: str = ROOT, extended: bool = False
) -> DataFrame:
    """Add ``violations``, ``is_valid`` and ``record`` (typed, NULL unless valid)."""
    checked = find_violations(parse_text(df, text), part, extended, text=text)
    is_valid = F.size("violations") == 0
    typed = F.try_variant_get(DOCUMENT, RECORD, ddl_of(part, extended))
    return (
        checked.withColumn("is_valid", is_valid)
        .withColumn("record", F.when(is_valid, typed))
        .drop(DOCUMENT)
    )


def split_records(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of checked records.

    Both sides re-read their input: pass a table that was written once, best partitioned
    by ``is_valid``, not the lazy generation plan.
    """
    return checked.where("is_valid"), checked.where("NOT is_valid")


def extra_keys(part: str = ROOT, extended: bool = False) -> Column:
    """ARRAY<STRING> of the paths of undeclared keys at every level, after parse_text."""
    found = []
    for path, declared in rules.object_paths(part, extended).items():
        undeclared = _undeclared_keys(f"`{DOCUMENT}`", rules.moved(path, RECORD), declared)
        found.append(f"transform({undeclared}, k -> concat('{path}.', k))")
    for rule in rules.list_rules(part, extended):
        names = [f.name for f in fields_of(rule.field.part)]
        keys = _undeclared_keys("_item", "$", names)
        named = f"transform({keys}, k -> concat('{rule.path}[', _i, '].', k))"
        listed = rules.each_item(f"`{DOCUMENT}`", rules.moved(rule.path, RECORD), named)
        found.append(f"coalesce(flatten({listed}), cast(array() AS array<string>))")
    return F.expr(f"flatten(array({', '.join(found)}))")


def undeclared_keys(document: str, path: str, declared: list[str]) -> Column:
    """ARRAY<STRING> of an object's keys outside ``declared``; empty for other values."""
    return F.expr(_undeclared_keys(f"`{document}`", path, declared))


def _undeclared_keys(document: str, path: str, declared: list[str]) -> str:
    keys = f"map_keys(try_variant_get({document}, '{path}', 'map<string,variant>'))"
    known = f"cast(array({', '.join(repr(name) for name in declared)}) AS array<string>)"
    return f"coalesce(array_except({keys}, {known}), cast(array() AS array<string>))"


def flatten_record(
    df: DataFrame, *keep: str, record: str = "record", part: str = ROOT
) -> DataFrame:
    """One column per leaf, named by its path below the record with ``__`` in between."""
    leaves = [
        F.col(".".join((record, *path))).alias("__".join(path)) for path in leaf_paths(part)
    ]
    return df.select(*keep, *leaves)
