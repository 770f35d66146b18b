"""Rules as rows against the generated rules of the record, and on schemas of their own."""

import json

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from recordloom.operators import check, schema_rules
from recordloom.operators.schema_rules import compile_schema, rule_table, schema_violations
from recordloom.operators.tree import nodes
from recordloom.plans.queries import _step_lists, damaged
from recordloom.schema import json_schema_text, schema_id


def _by_rules(parsed, text):
    rows = parsed.where(check.is_one_object()).select(
        "doc_id", F.lit(schema_id(text)).alias("schema_id"),
        F.try_variant_get(check.DOCUMENT, check.RECORD, "variant").alias("v"),
    )
    found = nodes(rows, "v", "doc_id", "schema_id")
    return sorted(map(tuple, schema_violations(found, rule_table(parsed.sparkSession, text), "doc_id").collect()))


@pytest.mark.parametrize("extended", [False, True])
def test_equal_to_the_generated_rules(spark, extended):
    parsed = _step_lists(spark, SMALL) if extended else check.parse_text(damaged(spark, SMALL))
    wanted = check.find_violations(parsed, extended=extended).select("doc_id", F.explode("violations").alias("v"))
    wanted = wanted.select("doc_id", "v.path", "v.rule").where("rule <> 'json_object'").collect()
    assert _by_rules(parsed, json_schema_text(extended=extended)) == sorted(map(tuple, wanted))
    assert len(wanted) > 50


SCHEMA = {
    "type": "object",
    "required": ["n", "who"],
    "properties": {
        "n": {"type": "integer"},
        "x": {"type": ["number", "null"]},
        "who": {"anyOf": [{"$ref": "#/$defs/Person"}, {"type": "null"}], "description": "someone"},
        "grid": {"type": "array", "items": {"type": "array", "items": {"enum": ["a", "b"], "type": "string"}}},
        "any": {},
    },
    "$defs": {"Person": {"type": "object", "required": ["name"], "properties": {"name": {"type": "string"}}}},
}


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ('{"n":1,"who":null,"x":null,"any":[1]}', []),
        ('{"n":1.0,"who":{"name":"a"},"x":2.5}', []),
        ('{"n":1.5,"who":{"name":5},"x":"2"}', [("$.n", "type"), ("$.who.name", "type"), ("$.x", "type")]),
        ('{"who":{}}', [("$.n", "required"), ("$.who.name", "required")]),
        ('{"n":1,"who":[],"grid":[["a","c"],"b",[1]]}',
         [("$.grid[0][1]", "enum"), ("$.grid[1]", "type"), ("$.grid[2][0]", "type"), ("$.who", "type")]),
        ("[]", [("$", "type")]),
    ],
)
def test_own_schema(spark, text, wanted):
    schema = json.dumps(SCHEMA)
    rows = spark.createDataFrame([(None, schema_id(schema), text)], "id int, schema_id string, t string")
    found = nodes(rows.withColumn("v", F.parse_json("t")), "v", "id", "schema_id")
    got = schema_violations(found, rule_table(spark, schema), "id").collect()
    assert sorted((r.path, r.rule) for r in got) == wanted


def test_partitions_grow_with_nodes_not_with_places(spark, monkeypatch):
    """Nodes are not dealt by place; ids that repeat or are null are told apart by path alone, as any."""
    monkeypatch.setattr(schema_rules, "NODES_PER_TASK", 10)
    schema = json.dumps({"type": "object", "required": ["a", "b"], "properties": {"a": {"type": "integer"}}})
    texts = ['{"a":1,"b":2}', '{"a":"x"}', "{}", '{"b":1}']
    ids = [None if i < 8 else i // 2 for i in range(200)]
    rows = [(i, schema_id(schema), texts[k % 3 if k >= 8 else 3 - k % 2]) for k, i in enumerate(ids)]
    table = spark.createDataFrame(rows, "id int, schema_id string, t string").repartition(3)
    found = nodes(table.withColumn("v", F.parse_json("t")), "v", "id", "schema_id").cache()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        violations = schema_violations(found, rule_table(spark, schema), "id")
        got = sorted(map(tuple, violations.collect()), key=repr)
        plan = violations._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    there, wanted = {(i, k) for i, _, t in rows for k in json.loads(t)}, []
    for i, _, t in rows:
        wanted += [(i, f"$.{k}", "required") for k in "ab" if (i, k) not in there]
        wanted += [(i, "$.a", "type")] * (json.loads(t).get("a") == "x")
    assert got == sorted(wanted, key=repr) and len(wanted) > 100
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert joins and all("place" not in line for line in joins)
    assert f", {-(-found.count() // 10)})" in plan


@pytest.mark.parametrize(
    "schema",
    [
        {"minimum": 3}, {"enum": [1]}, {"type": "text"}, {"additionalProperties": False},
        {"$ref": "#/definitions/x"}, {"$ref": "#/$defs/a", "$defs": {"a": {"$ref": "#/$defs/a"}}},
        {"anyOf": [{"properties": {}}, {"items": {}}]}, {"anyOf": [{"type": "null"}, {"pattern": "x"}]},
        {"$ref": "#/$defs/a", "$defs": {"a": {"properties": {"b": {"$ref": "#/$defs/a"}}}}},
    ],
)
def test_what_is_not_understood_is_refused(schema):
    with pytest.raises(ValueError):
        compile_schema(json.dumps(schema))
