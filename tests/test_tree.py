"""Nodes of nested documents against a plain Python walk."""

import json

import pytest
from pyspark.sql import functions as F

from recordloom.operators.tree import nodes

DOCUMENTS = [
    '{"a":{"b":[{"c":[[1,2.5],[]]},{"c":[]}]},"d":null,"e":true,"f":"x","g":{}}',
    "[]", "{}", "[[[[[[1]]]]]]", '"x"', "null", "-1.50", '{"a":"","b":[null,false,{"":1}]}',
]


def _walk(value, path="$", depth=0):
    if isinstance(value, dict):
        yield path, depth, "object", len(value), None
        for key, child in value.items():
            yield from _walk(child, f"{path}.{key}", depth + 1)
    elif isinstance(value, list):
        yield path, depth, "array", len(value), None
        for i, child in enumerate(value):
            yield from _walk(child, f"{path}[{i}]", depth + 1)
    elif value is None:
        yield path, depth, "null", 0, None
    elif isinstance(value, bool):
        yield path, depth, "boolean", 0, str(value).lower()
    else:
        yield path, depth, "string" if isinstance(value, str) else "number", 0, str(value)


def test_nodes_equal_a_walk(spark):
    rows = spark.createDataFrame([*enumerate(DOCUMENTS), (99, None)], "i int, t string")
    found = nodes(rows.withColumn("v", F.try_parse_json("t")), "v", "i").collect()
    wanted = [(i, *n) for i, t in enumerate(DOCUMENTS) for n in _walk(json.loads(t))]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "i int, t string").withColumn("v", F.try_parse_json("t"))
    assert nodes(empty, "v", "i").count() == 0
    with pytest.raises(ValueError, match="path"):
        nodes(empty.withColumnRenamed("i", "path"), "v", "path")
