import copy
import json
import random

import pytest

from recordloom.backends.template import template_text
from recordloom.fields import ROOT
from recordloom.functions import json_text
from recordloom.functions.rules import rules_of
from recordloom.operators import check, lists
from recordloom.schema import leaf_paths


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, generated_text string")


def _violations(spark, texts, **kw):
    rows = check.check_records(_texts(spark, texts), **kw).orderBy("id").collect()
    for r in rows:
        assert r["is_valid"] == (not r["violations"]) and (r["record"] is not None) == r["is_valid"]
    return [{(v["path"], v["rule"]) for v in r["violations"]} for r in rows]


GOOD = template_text("a prompt with ä, \"quotes\" and\nlines")
NOT_OBJECTS = [
    None, "", "  ", "[]", '""', "null", "true", "5", GOOD[:-1], GOOD + " done", GOOD + "}", GOOD + "]",
    GOOD + "," + GOOD, GOOD + GOOD, f"[{GOOD}]", GOOD.replace('"', "'"), f"```json\n{GOOD}\n```",
    '{"a":01}', '{"a":NaN}', '{"a":"x","a":"y"}', '{"a":"x\ny"}', "{a:1}", '{"a":1,}', "// x\n{}",
    GOOD + ',"0123456789abcdef0123456789abcdef"] ',
]


def test_only_one_whole_object_passes(spark):
    got = _violations(spark, NOT_OBJECTS)
    wrong = [t for t, v in zip(NOT_OBJECTS, got) if v != {("$", "json_object")}]
    assert not wrong


def test_a_text_too_long_to_read_has_a_rule_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(json_text, "LARGEST_TEXT", len(GOOD.encode()))
    assert _violations(spark, [GOOD, GOOD + " ", "x" + GOOD, "x"]) == [
        set(), {("$", "too_large")}, {("$", "too_large")}, {("$", "json_object")}
    ]


def test_white_space_and_extra_keys_are_fine(spark):
    extra = GOOD[:-1] + ',"more":{"x":null}}'
    assert _violations(spark, [GOOD, f" \n{GOOD}\t\r\n", extra]) == [set()] * 3
    keys = check.parse_text(_texts(spark, [GOOD, extra])).select(check.extra_keys().alias("k"))
    assert [r["k"] for r in keys.collect()] == [[], ["$.more"]]


def _at(record, path):
    for name in path[:-1]:
        record = record[name]
    return record


def _expected(record, part=ROOT):
    """Violations by walking the parsed record in plain Python."""
    kinds = {"text": str, "flag": bool, "part": dict}
    found = set()
    for rule in rules_of(part):
        names = rule.path[2:].split(".")
        above = record
        for name in names[:-1]:
            above = above.get(name) if isinstance(above, dict) else None
        if not isinstance(above, dict):
            continue
        if names[-1] not in above:
            found.add((rule.path, "required"))
        elif not isinstance(above[names[-1]], kinds[rule.field.kind]):
            found.add((rule.path, "type"))
        elif rule.field.choices and above[names[-1]] not in rule.field.choices:
            found.add((rule.path, "enum"))
    return found


def test_each_single_mutation_gives_its_rule(spark):
    texts, wanted = [], []
    for rule in rules_of():
        names = rule.path[2:].split(".")
        removed = json.loads(GOOD)
        del _at(removed, names)[names[-1]]
        texts.append(json.dumps(removed))
        wanted.append({(rule.path, "required")})
        for other in (None, 5, 1.5, "yes" if rule.field.kind != "text" else True, [], ["a"],
                      {} if rule.field.kind != "part" else "text"):
            changed = json.loads(GOOD)
            _at(changed, names)[names[-1]] = other
            texts.append(json.dumps(changed))
            wanted.append({(rule.path, "type")})
        if rule.field.choices:
            changed = json.loads(GOOD)
            _at(changed, names)[names[-1]] = rule.field.choices[0].lower()
            texts.append(json.dumps(changed))
            wanted.append({(rule.path, "enum")})
    assert _violations(spark, texts) == wanted


@pytest.mark.parametrize("seed", [1, 2])
def test_many_mutations_at_once(spark, seed):
    draw = random.Random(seed)
    texts, wanted = [], []
    for i in range(300):
        record = json.loads(template_text(f"prompt {i}"))
        for _ in range(draw.randint(0, 6)):
            rule = draw.choice(rules_of())
            names = rule.path[2:].split(".")
            try:
                place = _at(record, names)
                action = draw.choice(["remove", "set", "empty"])
                if action == "remove":
                    place.pop(names[-1], None)
                else:
                    place[names[-1]] = (
                        {} if action == "empty"
                        else copy.deepcopy(draw.choice([None, True, 0, -2.5, "", "Beginner", [], {"title": "x"}]))
                    )
            except (KeyError, TypeError, AttributeError):
                continue
        texts.append(json.dumps(record, ensure_ascii=bool(i % 2)))
        wanted.append(_expected(record))
    assert any(wanted) and not all(wanted)
    assert _violations(spark, texts) == wanted


def test_empty_object_reports_the_top_only(spark):
    assert _violations(spark, ["{}"]) == [
        {(f"$.{n}", "required") for n in ("problem_metadata", "user_problem_post", "expert_solution_reply")}
    ]


def test_record_and_leaves(spark):
    row = check.flatten_record(check.check_records(_texts(spark, [GOOD])), "id").first().asDict()
    source = json.loads(GOOD)
    assert len(row) == 16
    for path in leaf_paths():
        assert row["__".join(path)] == _at(source, list(path))[path[-1]]


def test_split(spark):
    checked = check.check_records(_texts(spark, [GOOD, "x", None, GOOD]))
    valid, rejected = check.split_records(checked)
    assert [r["id"] for r in valid.orderBy("id").collect()] == [0, 3]
    assert [r["id"] for r in rejected.orderBy("id").collect()] == [1, 2]


def test_extended_record(spark):
    full = json.loads(GOOD)
    full["diagnostic_reasoning_process"] = []
    reply = full["expert_solution_reply"]
    reply["relevant_expert_context"] = {"experience_snippet": "a", "effective_strategy_overview": "b"}
    reply["step_by_step_fix"] = [{"step_number": 1}]
    reply["verification_steps"] = "none"
    fix = "$.expert_solution_reply.step_by_step_fix"
    assert _violations(spark, [json.dumps(full)], extended=True) == [
        {
            ("$.expert_solution_reply.verification_steps", "type"),
            (f"{fix}[0].instruction", "required"),
            (f"{fix}[0].explanation", "required"),
        }
    ]
    reply["step_by_step_fix"] = [STEP, {"step_number": "7", "instruction": 5, "explanation": True}]
    reply["verification_steps"] = [7, {"instruction": "i"}]
    full["diagnostic_reasoning_process"] = [5, "x", {"informs_next_step_type": "Nope"}]
    steps = "$.diagnostic_reasoning_process"
    needed = ("reason_for_command", "diagnostic_command", "simulated_output", "interpretation")
    assert _violations(spark, [json.dumps(full)], extended=True) == [
        {(f"{fix}[1].{n}", "type") for n in ("step_number", "instruction", "explanation")}
        | {("$.expert_solution_reply.verification_steps[0]", "type")}
        | {(f"{steps}[0]", "type"), (f"{steps}[1]", "type")}
        | {(f"{steps}[2].{n}", "required") for n in needed}
        | {(f"{steps}[2].informs_next_step_type", "enum")}
    ]
    reply["step_by_step_fix"] = [STEP | {"more": 1}, STEP]
    full["diagnostic_reasoning_process"] = []
    keys = check.parse_text(_texts(spark, [json.dumps(full)])).select(check.extra_keys(extended=True))
    assert keys.first()[0] == [f"{fix}[0].more"]
    reply["verification_steps"] = []
    reply["alternative_solutions"] = None
    assert _violations(spark, [json.dumps(full)], extended=True) == [set()]


STEP = {"step_number": 1, "instruction": "i", "explanation": "e"}


@pytest.mark.parametrize(
    "change,wanted",
    [
        ({}, set()),
        ({"commands": None, "gui_path": None, "warning": "w"}, set()),
        ({"commands": []}, set()),
        ({"commands": ["a", None]}, {("$.commands", "type")}),
        ({"commands": ["a", 1]}, {("$.commands", "type")}),
        ({"commands": "a"}, {("$.commands", "type")}),
        ({"gui_path": 1}, {("$.gui_path", "type")}),
        ({"step_number": 1.0}, set()),
        ({"step_number": 1e2}, set()),
        ({"step_number": 1.5}, {("$.step_number", "type")}),
        ({"step_number": 2**63 - 1}, set()),
        ({"step_number": 12345678901234567890}, {("$.step_number", "range")}),
        ({"step_number": -1e300}, {("$.step_number", "range")}),
        ({"step_number": "1"}, {("$.step_number", "type")}),
        ({"step_number": True}, {("$.step_number", "type")}),
        ({"instruction": None}, {("$.instruction", "type")}),
    ],
)
def test_list_items(spark, change, wanted):
    text = json.dumps({"steps": [STEP, STEP | change]})
    items = lists.list_items(check.parse_text(_texts(spark, [text])), "$.steps", "id")
    first, second = lists.check_items(items, "StepByStepFixItem").orderBy("pos").collect()
    assert first["is_valid"] and first["record"]["commands"] == [] and first["record"]["gui_path"] is None
    assert {(v["path"], v["rule"]) for v in second["violations"]} == wanted
    if not wanted:
        assert second["record"]["commands"] == (None if "commands" in change and change["commands"] is None else [])


def test_items_that_are_no_objects_and_parents_without_items(spark):
    parsed = check.parse_text(_texts(spark, ['{"steps":[1,{"x":2}]}', '{"steps":[]}', "{}"]))
    checked = lists.check_items(lists.list_items(parsed, "$.steps", "id"), "VerificationStep")
    got = [[(v["path"], v["rule"]) for v in r["violations"]] for r in checked.orderBy("pos").collect()]
    assert got == [[("$", "json_object")], [("$.instruction", "required")]]
    outer = lists.list_items(parsed, "$.steps", "id", outer=True)
    assert outer.where("id > 0 AND pos IS NULL").count() == 2


def test_typed_lists_explode(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('xs', array('a','b')) AS record UNION ALL SELECT 2, named_struct('xs', array())")
    rows = lists.explode_records(df, "xs", "id").orderBy("id", "pos").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "a"), (1, 1, "b"), (2, None, None)]
