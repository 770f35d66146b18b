import json

from pyspark.sql import types as T

from recordloom import schema
from recordloom.fields import PARTS, ROOT


def _required(node):
    own = len(node.get("required", []))
    return own + sum(_required(d) for d in node.get("$defs", {}).values())


def test_json_schema_of_the_active_record():
    exported = schema.json_schema()
    assert exported["title"] == ROOT and exported["type"] == "object"
    assert set(exported["$defs"]) == {
        "ExpertSolutionReply", "ProblemMetadata", "SystemContext", "UserProblemPost",
    }
    assert exported["required"] == ["problem_metadata", "user_problem_post", "expert_solution_reply"]
    assert exported["properties"]["problem_metadata"] == {"$ref": "#/$defs/ProblemMetadata"}
    assert _required(exported) == 19
    metadata = exported["$defs"]["ProblemMetadata"]["properties"]
    assert metadata["requires_diagnostic"] == {
        "description": "True if this problem commonly requires diagnostic commands.",
        "title": "Requires Diagnostic",
        "type": "boolean",
    }
    assert metadata["difficulty"] == {
        "description": "Estimation of the technical difficulty level.",
        "enum": ["Beginner", "Intermediate"],
        "title": "Difficulty",
        "type": "string",
    }
    assert exported["$defs"]["SystemContext"] == {
        "properties": {
            "distribution": {
                "examples": ["Ubuntu 22.04 LTS", "Fedora 39", "openSUSE Leap 15.0"],
                "title": "Distribution",
                "type": "string",
            },
            "kernel_version": {
                "description": "Output of uname -r.",
                "examples": ["5.15.0-86-generic"],
                "title": "Kernel Version",
                "type": "string",
            },
        },
        "required": ["distribution", "kernel_version"],
        "title": "SystemContext",
        "type": "object",
    }
    text = schema.json_schema_text()
    assert json.loads(text) == exported
    assert "additionalProperties" not in text and "anyOf" not in text


def test_json_schema_of_inactive_parts():
    step = schema.json_schema("StepByStepFixItem")
    assert step["required"] == ["step_number", "instruction", "explanation"]
    assert step["properties"]["step_number"] == {"title": "Step Number", "type": "integer"}
    assert step["properties"]["gui_path"] == {
        "anyOf": [{"type": "string"}, {"type": "null"}],
        "default": None,
        "description": "Path through GUI, if applicable.",
        "title": "Gui Path",
    }
    assert step["properties"]["commands"]["anyOf"][0] == {"type": "array", "items": {"type": "string"}}
    full = schema.json_schema(extended=True)
    assert set(full["$defs"]) == set(PARTS) - {ROOT}
    fix = full["$defs"]["ExpertSolutionReply"]["properties"]["step_by_step_fix"]
    assert fix["items"] == {"$ref": "#/$defs/StepByStepFixItem"} and fix["type"] == "array"


def test_spark_type_matches_leaf_paths():
    record = schema.struct_of()
    paths = schema.leaf_paths()
    assert len(paths) == 15
    for path in paths:
        at = record
        for name in path:
            at = at[name].dataType
        assert isinstance(at, (T.StringType, T.BooleanType))
    assert record["problem_metadata"].dataType["difficulty"].metadata["enum"] == [
        "Beginner", "Intermediate",
    ]
    extended = schema.struct_of(extended=True)
    steps = extended["expert_solution_reply"].dataType["step_by_step_fix"].dataType
    assert steps.elementType["step_number"].dataType == T.LongType()
    assert steps.elementType["commands"].dataType == T.ArrayType(T.StringType())
