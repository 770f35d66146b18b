"""Spark types and JSON Schema text of a record part (driver-side metadata only)."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import types as T

from recordloom.fields import ROOT, Field, fields_of

_LEAF_TYPES: dict[str, T.DataType] = {
    "text": T.StringType(),
    "flag": T.BooleanType(),
    "whole": T.LongType(),
    "texts": T.ArrayType(T.StringType()),
}

_JSON_TYPES: dict[str, dict[str, Any]] = {
    "text": {"type": "string"},
    "flag": {"type": "boolean"},
    "whole": {"type": "integer"},
    "texts": {"type": "array", "items": {"type": "string"}},
}


def struct_of(part: str = ROOT, extended: bool = False) -> T.StructType:
    """Spark type of a part; field metadata carries description, examples and choices."""
    columns = []
    for f in fields_of(part, extended):
        if f.kind == "part":
            data_type: T.DataType = struct_of(f.part, extended)
        elif f.kind == "parts":
            data_type = T.ArrayType(struct_of(f.part, extended))
        else:
            data_type = _LEAF_TYPES[f.kind]
        notes = {"description": f.about, "examples": list(f.examples), "enum": list(f.choices)}
        columns.append(
            T.StructField(f.name, data_type, True, {k: v for k, v in notes.items() if v})
        )
    return T.StructType(columns)


def ddl_of(part: str = ROOT, extended: bool = False) -> str:
    """The part's type as text, for VARIANT casts."""
    return struct_of(part, extended).simpleString()


def json_schema(part: str = ROOT, extended: bool = False) -> dict[str, Any]:
    """JSON Schema of a part: nested parts go to ``$defs`` and are referenced."""
    definitions: dict[str, Any] = {}

    def node(f: Field) -> dict[str, Any]:
        if f.kind in ("part", "parts"):
            if f.part not in definitions:
                definitions[f.part] = {}
                definitions[f.part] = body(f.part)
            shape = {"$ref": f"#/$defs/{f.part}"}
            if f.kind == "part":
                return shape
            shape = {"type": "array", "items": shape}
        else:
            shape = dict(_JSON_TYPES[f.kind])
        if f.choices:
            shape["enum"] = list(f.choices)
        if f.optional:
            shape = {"anyOf": [shape, {"type": "null"}]}
            if f.kind not in ("texts", "parts"):
                shape["default"] = None
        if f.about:
            shape["description"] = f.about
        if f.examples:
            shape["examples"] = list(f.examples)
        shape["title"] = f.name.replace("_", " ").title()
        return shape

    def body(name: str) -> dict[str, Any]:
        listed = fields_of(name, extended)
        out: dict[str, Any] = {
            "properties": {f.name: node(f) for f in listed},
            "title": name,
            "type": "object",
        }
        required = [f.name for f in listed if not f.optional]
        if required:
            out["required"] = required
        return out

    root = body(part)
    return {"$defs": definitions, **root} if definitions else root


def json_schema_text(part: str = ROOT, extended: bool = False) -> str:
    return json.dumps(json_schema(part, extended), ensure_ascii=False, separators=(",", ":"))


def schema_id(schema_text: str) -> str:
    """Short stand-in for the schema text on rows that move between executors."""
    return hashlib.sha256(schema_text.encode("utf-8")).hexdigest()


def leaf_paths(part: str = ROOT, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Every leaf of the active part, as name tuples, in declared order."""
    out: list[tuple[str, ...]] = []
    for f in fields_of(part):
        if f.kind == "part":
            out += leaf_paths(f.part, (*prefix, f.name))
        else:
            out.append((*prefix, f.name))
    return out
