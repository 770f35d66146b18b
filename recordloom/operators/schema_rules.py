"""JSON Schemas as data: rules as a table, checked by joins against the nodes of documents.

Rows of one table may follow different schemas, each named by ``schema_id``.  A schema text becomes
one row per place in it; a place is a path with ``[*]`` for the positions in lists.  Nodes
of documents (:func:`recordloom.operators.tree.nodes`) are joined to the rules of their own
schema and place, so one plan serves any number of schemas and no expression grows with them.

Understood: ``type`` (one or several), ``properties``, ``required``, ``items``, ``enum`` of strings,
``$ref`` into ``$defs``, and ``anyOf`` with at most one alternative that has parts of its own.
Annotations pass.  A schema that holds anything else, or refers to itself, is refused: it would be
checked by less than it says.
"""

from __future__ import annotations

import json
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.schema import schema_id

# Keywords that say nothing about a document.
_ANNOTATIONS = {"title", "description", "examples", "default", "$defs", "$schema", "$id", "$comment"}
_KINDS = {"object", "array", "string", "number", "integer", "boolean", "null"}
# Nodes that one task of the search for missing names gets: some 100 MB of them, sorted.
NODES_PER_TASK = 1 << 19
RULES = (
    "schema_id string, place string, kinds array<string>, choices array<string>, "
    "required array<string>"
)


class Rule(NamedTuple):
    """One place of a schema; ``kinds`` or ``choices`` that are None allow everything."""

    schema_id: str
    place: str
    kinds: list[str] | None
    choices: list[str] | None
    required: list[str]


def compile_schema(text: str) -> list[Rule]:
    """The rules of one schema text."""
    root = json.loads(text)
    name = schema_id(text)
    out: list[Rule] = []

    def resolved(node: dict[str, Any], seen: tuple[str, ...]) -> tuple[dict[str, Any], tuple[str, ...]]:
        while "$ref" in node:
            ref = node["$ref"]
            if not ref.startswith("#/$defs/"):
                raise ValueError(f"$ref {ref} does not point into $defs")
            if ref in seen:
                raise ValueError(f"{ref} refers to itself")
            rest = {k: v for k, v in node.items() if k != "$ref"}
            node, seen = {**root["$defs"][ref.removeprefix("#/$defs/")], **rest}, (*seen, ref)
        return node, seen

    def visit(node: dict[str, Any], place: str, seen: tuple[str, ...]) -> None:
        node, seen = resolved(node, seen)
        kinds, choices = _kinds(node, place), node.get("enum")
        if "anyOf" in node:
            found = [resolved(option, seen) for option in node["anyOf"]]
            parted = [x for x in found if {"properties", "items", "enum", "anyOf"} & set(x[0])]
            if len(parted) > 1 or "enum" in node or kinds is not None:
                raise ValueError(f"{place}: alternatives with parts of their own")
            own = [_kinds(option, place) for option, _ in found]
            kinds = None if None in own else sorted({k for ks in own for k in ks})
            known = {"type", "properties", "items", "required", "enum", "additionalProperties"} | _ANNOTATIONS
            for option, _ in found:
                _refuse(option, place, known)
            _refuse(node, place, {"anyOf"} | _ANNOTATIONS)
            node, seen = parted[0] if parted else ({}, seen)
            choices = node.get("enum")
        if choices is not None and not all(isinstance(c, str) for c in choices):
            raise ValueError(f"{place}: enum of other values than strings")
        known = {"type", "properties", "items", "required", "enum", "additionalProperties"}
        _refuse(node, place, known | _ANNOTATIONS)
        if node.get("additionalProperties", True) is not True:
            raise ValueError(f"{place}: additionalProperties")
        out.append(Rule(name, place, kinds, choices, sorted(node.get("required", []))))
        for key, child in node.get("properties", {}).items():
            visit(child, f"{place}.{key}", seen)
        if "items" in node:
            visit(node["items"], f"{place}[*]", seen)

    visit(root, "$", ())
    return out


def _kinds(node: dict[str, Any], place: str) -> list[str] | None:
    found = node.get("type")
    listed = [found] if isinstance(found, str) else found
    if listed is not None and not set(listed) <= _KINDS:
        raise ValueError(f"{place}: type {found}")
    return listed


def _refuse(node: dict[str, Any], place: str, known: set[str]) -> None:
    other = sorted(set(node) - known)
    if other:
        raise ValueError(f"{place}: {', '.join(other)} is not understood")


def rule_table(spark: SparkSession, *texts: str) -> DataFrame:
    """The rules of several schemas, one row per schema and place."""
    return spark.createDataFrame([tuple(r) for t in texts for r in compile_schema(t)], RULES)


def schema_violations(nodes: DataFrame, rules: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``path`` and ``rule`` of what is wrong: ``required``, ``type`` or ``enum``.

    ``nodes`` has ``schema_id`` besides the ``keys`` that name a document and the columns of a node.  Parts
    of a missing or misplaced object are not reported on their own; places that a schema does
    not mention are legal.  Choices are judged for strings only.  The nodes are counted first, so
    they should be written, as those of :func:`recordloom.operators.tree.nodes` are.
    """
    place = F.regexp_replace("path", r"\[[0-9]+\]", "[*]")
    placed = nodes.withColumn("place", place)
    # All nodes stand at few places: dealt by place they would meet in as few tasks.  Spark's own choice
    # is against a broadcast where the places fill few of the partitions.
    ruled = placed.join(F.broadcast(rules), ["schema_id", "place"])
    whole = F.col("text").cast("double") % 1 == 0
    fits = F.array_contains("kinds", F.col("kind")) | (
        F.array_contains("kinds", "integer") & (F.col("kind") == "number") & F.coalesce(whole, F.lit(False))
    )
    wrong = F.when(F.col("kinds").isNotNull() & ~fits, "type").when(
        F.col("choices").isNotNull() & (F.col("kind") == "string")
        & ~F.array_contains("choices", F.col("text")), "enum",
    )
    found = ruled.select(*keys, "path", wrong.alias("rule")).where("rule IS NOT NULL")
    asked = ruled.where("kind = 'object'").select(*keys, "path", F.explode("required").alias("name"))
    asked = asked.select(*keys, F.concat("path", F.lit("."), "name").alias("path"))
    # One key that is never null: a struct equals another with nulls in the same fields.  Its partitions
    # grow with the nodes; left alone they are merged by compressed bytes, and paths compress well.
    node = F.struct(*keys, "path").alias("_node")
    there = nodes.select(node).repartition(-(-nodes.count() // NODES_PER_TASK) or 1, "_node")
    lost = asked.select(node).join(there, "_node", "left_anti").select("_node.*")
    return found.unionByName(lost.withColumn("rule", F.lit("required")))
