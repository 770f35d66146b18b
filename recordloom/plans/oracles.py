"""The queries of :mod:`recordloom.plans.queries` as SQL for DuckDB.

Written from the operators' definitions, not from the Spark expressions: JSON types come
from ``json_type``, rules are spelled out per path.
"""

from __future__ import annotations

import hashlib

from recordloom.backends.template import (
    ANSWERS,
    CHOICES,
    NO_CONTENT,
    REPEATS_PROMPT,
)
from recordloom.fields import NEXT_STEP_TYPES, ROOT, fields_of
from recordloom.functions.chat import DEFAULT_SYSTEM_TEXT
from recordloom.functions.rules import Rule, object_paths, rules_of
from recordloom.plans.queries import CUT
from recordloom.schema import json_schema_text, leaf_paths
from recordloom.sinks.jsonl import RESULT_COLUMN, SINK_COLUMN


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _listed(values: tuple[object, ...]) -> str:
    return "[" + ", ".join(quoted(v) if isinstance(v, str) else str(v).lower() for v in values) + "]"


def _template() -> str:
    """The stand-in's record as a DuckDB struct over ``prompt`` and its digest ``h``."""
    at = 1

    def fill(part: str) -> str:
        nonlocal at
        pairs = []
        for f in fields_of(part):
            if f.kind == "part":
                value = fill(f.part)
            elif f.name == REPEATS_PROMPT:
                value = "prompt"
            else:
                options = (True, False) if f.kind == "flag" else CHOICES.get(f.name) or ANSWERS[f.name]
                value = (
                    f"{_listed(options)}[1 + CAST('0x' || substr(h, {at}, 4) AS INTEGER) "
                    f"% {len(options)}]"
                )
                at += 4
            pairs.append(f"'{f.name}': {value}")
        return "{" + ", ".join(pairs) + "}"

    return fill(ROOT)


RAW = f"""
raw AS (
  SELECT doc_id, CAST(to_json({_template()}) AS VARCHAR) AS t
  FROM (SELECT doc_id, text AS prompt, sha256(text) AS h FROM documents)
)"""


def _swap(old: str, new: str) -> str:
    return f"replace(t, {quoted(old)}, {quoted(new)})"


DAMAGED = f"""{RAW},
damaged AS (
  SELECT doc_id, CASE doc_id % 16
    WHEN 0 THEN t
    WHEN 1 THEN left(t, length(t) // 2)
    WHEN 2 THEN {_swap('"user_goal":', '"aim":')}
    WHEN 3 THEN {_swap('"requires_diagnostic":', '"requires_diagnostic":"yes","was":')}
    WHEN 4 THEN {_swap('"difficulty":"', '"difficulty":"Not ')}
    WHEN 5 THEN t || ' done'
    WHEN 6 THEN NULL
    WHEN 7 THEN {_swap('"system_context":{', '"system_context":"none","was":{')}
    WHEN 8 THEN {_swap('"acknowledgement":', '"acknowledgement":null,"said":')}
    WHEN 9 THEN '[' || t || ']'
    WHEN 10 THEN t || ',' || t
    WHEN 11 THEN '  ' || t || chr(10)
    WHEN 12 THEN {_swap('"title":', '"title":5,"old_title":')}
    WHEN 13 THEN ''
    WHEN 14 THEN {_swap('"expert_solution_reply":', '"reply":')}
    WHEN 15 THEN {_swap('"simulated_source":"', '"simulated_source":"The ')}
  END AS t
  FROM raw
)"""

_PAIRS = r"\{\}|\[\]"
# The longest prefix that is JSON once its open brackets are closed, by trying all of them.
SALVAGED = f"""WITH {RAW.lstrip()},
cut AS (SELECT doc_id, left(t, CAST(64 + doc_id * 97 % 1400 AS INTEGER)) AS u FROM raw),
prefixes AS (
  SELECT doc_id, u, n, left(u, n) AS p FROM (SELECT *, unnest(range(1, length(u) + 1)) AS n FROM cut)
  WHERE substr(u, n, 1) IN ('"', '{{', '}}', '[', ']', 'e', 'l')
), outside AS (
  SELECT *, regexp_replace(p, '"(\\\\.|[^"\\\\])*"', '', 'g') AS o FROM prefixes
), brackets AS (
  SELECT *, regexp_replace(o, '[^][{{}}]', '', 'g') AS b FROM outside WHERE o NOT LIKE '%"%'
), opened AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    b, '{_PAIRS}', '', 'g'), '{_PAIRS}', '', 'g'), '{_PAIRS}', '', 'g'), '{_PAIRS}', '', 'g') AS open
  FROM brackets
), closed AS (
  SELECT doc_id, u, n, p || reverse(translate(open, '{{[', '}}]')) AS text, open = '' AS whole FROM opened
), best AS (
  SELECT doc_id, arg_max(text, n) AS text, arg_max(whole, n) AS whole, max(n) AS n
  FROM closed WHERE json_valid(text) AND json_type(text) = 'OBJECT' GROUP BY doc_id
)
SELECT doc_id, sha256(text) AS digest, whole AND trim(substr(u, n + 1)) = '' AS complete,
       (length(u) - n)::INTEGER AS n_dropped
FROM cut LEFT JOIN best USING (doc_id)"""

_IS_OBJECT = "coalesce(CASE WHEN json_valid(t) THEN json_type(t) = 'OBJECT' END, false)"
JUDGED = f"""{DAMAGED},
judged AS (SELECT doc_id, t, {_IS_OBJECT} AS ok FROM damaged),
objects AS (SELECT doc_id, t FROM judged WHERE ok)"""


def _rule_sql(rule: Rule) -> str:
    """Violations of one path among ``objects``."""
    found = f"json_type(t, '{rule.path}')"
    wanted = {"text": "'VARCHAR'", "flag": "'BOOLEAN'", "part": "'OBJECT'"}[rule.field.kind]
    above = "true" if rule.parent == "$" else f"coalesce(json_type(t, '{rule.parent}') = 'OBJECT', false)"
    cases = [
        f"WHEN {found} IS NULL AND {above} THEN 'required'",
        f"WHEN {found} IS NOT NULL AND {found} <> {wanted} THEN 'type'",
    ]
    if rule.field.choices:
        allowed = ", ".join(quoted(c) for c in rule.field.choices)
        cases.append(
            f"WHEN json_extract_string(t, '{rule.path}') NOT IN ({allowed}) THEN 'enum'"
        )
    return (
        f"SELECT doc_id, '{rule.path}' AS path, CASE {' '.join(cases)} END AS rule FROM objects"
    )


VIOLATIONS = (
    JUDGED
    + ",\nviolations AS (\n  SELECT * FROM (\n    "
    + "SELECT doc_id, '$' AS path, 'json_object' AS rule FROM judged WHERE NOT ok\n    UNION ALL "
    + "\n    UNION ALL ".join(_rule_sql(r) for r in rules_of())
    + "\n  ) WHERE rule IS NOT NULL\n)"
)

VALIDITY = (
    VIOLATIONS
    + """,
validity AS (
  SELECT d.doc_id, v.doc_id IS NULL AS is_valid
  FROM damaged d LEFT JOIN (SELECT DISTINCT doc_id FROM violations) v USING (doc_id)
)"""
)


def _extra_keys() -> str:
    parts = []
    for path, names in object_paths().items():
        known = ", ".join(quoted(n) for n in names)
        parts.append(
            f"SELECT doc_id, '{path}.' || key AS key FROM "
            f"(SELECT doc_id, unnest(json_keys(t, '{path}')) AS key FROM objects "
            f"WHERE json_type(t, '{path}') = 'OBJECT') WHERE key NOT IN ({known})"
        )
    return " UNION ALL ".join(parts)


def _leaf_columns() -> str:
    out = []
    kinds = {r.path: r.field.kind for r in rules_of()}
    for names in leaf_paths():
        path = "$." + ".".join(names)
        value = f"json_extract_string(t, '{path}')"
        if kinds[path] == "flag":
            value = f"CAST({value} AS BOOLEAN)"
        out.append(f"{value} AS {'__'.join(names)}")
    return ", ".join(out)


_LINES = "string_split(text, chr(10))"
_LIST = f"CAST(to_json({_LINES}) AS VARCHAR)"
_MESSAGES = f"""CAST(to_json([{{'role': 'system', 'content': {quoted(DEFAULT_SYSTEM_TEXT)}}},
  {{'role': 'user', 'content': text}}]) AS VARCHAR) AS messages"""
_SCHEMA_DIGEST = quoted(hashlib.sha256(json_schema_text().encode("utf-8")).hexdigest())
_SETTING = """CASE event_id % 6 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN event_type
      WHEN 2 THEN ' ' || CAST(user_id AS VARCHAR) || ' ' WHEN 3 THEN CAST(user_id AS VARCHAR) || '.5'
      WHEN 4 THEN '' ELSE '0' END"""

# Fix steps are judged on the values they were made of.
_STEPS = f"""
lines AS (
  SELECT doc_id, lang, unnest({_LINES}) AS line, generate_subscripts({_LINES}, 1) AS nr
  FROM documents
),
steps AS (
  SELECT doc_id, CAST(nr - 1 AS INTEGER) AS pos, line,
    CASE WHEN (nr - 1) % 4 <> 3 THEN CAST(nr AS BIGINT) END AS step_number
  FROM lines
)"""

_CHOICE = f"""CASE event_id % 4 WHEN 0 THEN '{NEXT_STEP_TYPES[1]}' WHEN 1 THEN '{NEXT_STEP_TYPES[0]}'
  WHEN 2 THEN '{NEXT_STEP_TYPES[2]}' ELSE event_type END"""
_NEXT = ", ".join(quoted(c) for c in NEXT_STEP_TYPES)

_FIX = "$.expert_solution_reply.step_by_step_fix"

ORACLES: dict[str, str] = {
    "prompts_from_documents": (
        "SELECT sha256(CAST(to_json([CAST(doc_id AS VARCHAR)]) AS VARCHAR)) AS prompt_id, doc_id, "
        "text AS prompt FROM documents"
    ),
    "prompt_count": "SELECT count(*) AS n FROM documents",
    "resumed_generation": """
        SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS attempt, sha256(text) AS digest
        FROM documents""",
    "salvaged_records": SALVAGED,
    "record_nodes": """
        WITH docs AS (
          SELECT doc_id, to_json({'even': doc_id % 2 = 0, 'source': source, 'size': n_chars,
            'parts': list_transform(string_split(text, chr(10)), lambda x: {'sentences':
              CASE WHEN x = '' THEN [] ELSE string_split(x, '. ') END})}) AS j
          FROM documents
        )
        SELECT doc_id, fullkey AS path, CASE type WHEN 'VARCHAR' THEN 'string'
          WHEN 'UBIGINT' THEN 'number' WHEN 'BIGINT' THEN 'number' ELSE lower(type) END AS kind,
          CASE WHEN type NOT IN ('OBJECT', 'ARRAY') THEN atom ->> '$' END AS text
        FROM docs, json_tree(j)""",
    "prompt_list_files": "SELECT doc_id, text AS prompt FROM documents WHERE text IS NOT NULL",
    "prompt_list_rows": f"""
SELECT doc_id, CAST(nr - 1 AS BIGINT) AS pos, line AS prompt
FROM (SELECT doc_id, unnest({_LINES}) AS line, generate_subscripts({_LINES}, 1) AS nr
      FROM documents)""",
    "prompt_list_check": f"""
WITH good AS (SELECT doc_id, {_LIST} AS g FROM documents),
cut AS (SELECT doc_id, g, left(g, length(g) - 1) AS b FROM good),
texts AS (
  SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN g WHEN 1 THEN b || ',3]' WHEN 2 THEN b || ',null]'
    WHEN 3 THEN '{{"a":' || g || '}}' WHEN 4 THEN b WHEN 5 THEN g || ' x' WHEN 6 THEN ' [ ] '
    WHEN 7 THEN '[' || g || ']' WHEN 8 THEN g || chr(10) END AS j
  FROM cut
)
SELECT doc_id, coalesce(CASE WHEN json_valid(j) THEN json_type(j) = 'ARRAY' AND
  len(list_filter(json_extract(j, '$[*]'), lambda x: json_type(x) <> 'VARCHAR')) = 0 END, false) AS ok
FROM texts""",
    "tolerant_setting": f"""
WITH s AS (SELECT event_id, {_SETTING} AS x FROM events)
SELECT event_id,
  CASE WHEN regexp_full_match(trim(x), '[+-]?[0-9]+') THEN nullif(CAST(trim(x) AS BIGINT), 0) END AS parsed,
  x <> '' AND NOT regexp_full_match(trim(x), '[+-]?[0-9]+') AS warned
FROM s""",
    "chat_messages": f"""
SELECT doc_id, {_MESSAGES} FROM documents""",
    "sampling_params_greedy": """
WITH d AS (SELECT doc_id, sha256(text) AS digest, CASE doc_id % 3 WHEN 0 THEN CAST(0 AS DOUBLE)
                                          WHEN 1 THEN CAST(0.7 AS DOUBLE) END AS temperature
           FROM documents)
SELECT doc_id, digest, temperature,
  CASE WHEN temperature = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END AS top_p,
  CAST(CASE WHEN temperature = 0 THEN -1 ELSE 5 END AS INTEGER) AS top_k,
  CAST(1024 AS INTEGER) AS max_tokens, false AS detokenize
FROM d""",
    "schema_on_requests": f"""
SELECT doc_id, {_SCHEMA_DIGEST} AS schema_id, sha256({quoted(json_schema_text())}) AS inline_digest,
  {_MESSAGES}
FROM documents""",
    "nested_to_json": """
SELECT o_orderkey, CAST(to_json({
  'o_orderkey': o_orderkey,
  'buyer': {'o_custkey': o_custkey, 'status': o_orderstatus},
  'tags': [o_orderstatus, o_orderpriority],
  'placed': strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
  'amount': CAST(CAST(o_custkey AS DECIMAL(12, 2)) AS VARCHAR),
  'note': CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END,
  'by_key': MAP {CAST(o_orderkey AS VARCHAR): o_orderpriority}
}) AS VARCHAR) AS j FROM orders""",
    "generate_template": f"""
WITH {RAW}
SELECT doc_id, t AS generated_text, 'stop' AS finish_reason FROM raw""",
    "carried_columns": f"""
WITH {RAW}
SELECT doc_id, lang, source, n_chars, CASE WHEN doc_id % 2 = 0 THEN n_chars END AS maybe_chars,
  sha256(t) AS digest
FROM raw JOIN documents USING (doc_id)""",
    "truncated_generations": f"""
WITH {RAW}
SELECT doc_id, CAST(least(length(t), {CUT}) AS INTEGER) AS n_chars, length(t) <= {CUT} AS is_valid
FROM raw""",
    "generation_errors": f"""
WITH {DAMAGED}
SELECT doc_id, CASE WHEN coalesce(t, '') = '' THEN '{NO_CONTENT}' END AS generation_error,
  coalesce(t, '') = '' AS empty
FROM damaged""",
    "generation_totals": f"""
WITH {DAMAGED}
SELECT count(*) AS n_requests, count(*) FILTER (WHERE coalesce(t, '') = '') AS n_failed
FROM damaged""",
    "throughput": """
SELECT count(*) AS n_requests,
  count(*) FILTER (WHERE doc_id % 7 = 0 AND source IS NOT NULL) AS n_failed,
  CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS n_output_tokens,
  CAST(sum(doc_id % 1000 + 1) AS DOUBLE) / 1000 AS model_seconds,
  CAST(sum(n_chars) AS DOUBLE) / (CAST(sum(doc_id % 1000 + 1) AS DOUBLE) / 1000)
    AS tokens_per_model_second
FROM documents""",
    "latency_quantiles": """
SELECT coalesce(source, '') AS source, rank, count(*) AS n_requests, true AS is_within,
  CASE rank WHEN 0 THEN min(doc_id * 7919 % 10007) WHEN 1 THEN max(doc_id * 7919 % 10007) END::DOUBLE
    AS extreme_ms
FROM documents, (SELECT unnest([0.0, 0.5, 0.9, 0.99, 1.0])::DOUBLE AS rank) GROUP BY 1, rank""",
    "offending_values": f"""
WITH {VIOLATIONS}
, met AS (
  SELECT path, rule, CAST(json_extract(t, path) AS VARCHAR) AS value FROM violations JOIN damaged USING (doc_id)
  WHERE rule IN ('type', 'enum', 'range')
), shown AS (
  SELECT path, rule, CASE WHEN length(value) <= 200 THEN value
    ELSE 'sha256:' || sha256(value) || ':' || length(value) END AS value
  FROM met WHERE value IS NOT NULL
)
SELECT path, rule, sum(count(*)) OVER (PARTITION BY path, rule)::BIGINT AS n, value,
  count(*) AS n_value
FROM shown GROUP BY path, rule, value""",
    "category_difficulty": f"""
WITH {RAW}
SELECT json_extract_string(t, '$.problem_metadata.category') AS category,
  json_extract_string(t, '$.problem_metadata.difficulty') AS difficulty, count(*) AS n
FROM raw GROUP BY 1, 2""",
    "staged_split": f"""
WITH {VALIDITY}
SELECT doc_id, CASE WHEN is_valid THEN 'valid' ELSE 'rejected' END AS side,
  CAST(coalesce(n, 0) AS INTEGER) AS n_violations,
  CASE WHEN is_valid THEN json_extract_string(t, '$.user_problem_post.title') END AS title
FROM validity JOIN damaged USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM violations GROUP BY doc_id) USING (doc_id)""",
    "postprocess_rows": f"WITH {RAW} SELECT t AS {RESULT_COLUMN} FROM raw",
    "sink_rows": f"WITH {DAMAGED} SELECT t AS {SINK_COLUMN} FROM damaged",
    "jsonl_round_trip": f"WITH {DAMAGED} SELECT t AS {SINK_COLUMN} FROM damaged",
    "jsonl_lines": f"""
WITH {DAMAGED}
SELECT count(*) AS n, count(*) AS n_with_key, count(*) FILTER (WHERE t IS NULL) AS n_null,
  CAST(0 AS BIGINT) AS n_non_ascii
FROM damaged""",
    "json_object_check": f"WITH {JUDGED} SELECT doc_id, ok FROM judged",
    "violations": f"WITH {VIOLATIONS} SELECT doc_id, path, rule FROM violations",
    "schema_table_violations": f"""
        WITH {VIOLATIONS} SELECT doc_id, path, rule FROM violations
        WHERE rule <> 'json_object' AND (doc_id % 3 = 0
          OR doc_id % 3 = 1 AND starts_with(path, '$.user_problem_post')
          OR doc_id % 3 = 2 AND starts_with(path, '$.expert_solution_reply'))""",
    "required_fields": f"WITH {VIOLATIONS} SELECT doc_id, path FROM violations WHERE rule = 'required'",
    "type_mismatches": f"WITH {VIOLATIONS} SELECT doc_id, path FROM violations WHERE rule = 'type'",
    "enum_mismatches": f"""
WITH {VIOLATIONS}
SELECT doc_id, path, json_extract_string(t, path) AS value
FROM violations JOIN objects USING (doc_id) WHERE rule = 'enum'""",
    "props_extra_keys": """
SELECT event_id, key FROM (SELECT event_id, unnest(json_keys(props)) AS key FROM events)
WHERE key NOT IN ('id')""",
    "record_extra_keys": f"WITH {JUDGED} {_extra_keys()}",
    "parsed_records": f"WITH {RAW} SELECT doc_id, {_leaf_columns()} FROM raw",
    "valid_split": f"WITH {VALIDITY} SELECT doc_id, is_valid FROM validity",
    "violation_summary": f"WITH {VIOLATIONS} SELECT rule, count(*) AS n FROM violations GROUP BY rule",
    "run_summary": f"""
WITH {VALIDITY}
SELECT count(*) AS n, count(*) FILTER (WHERE is_valid) AS n_valid,
  count(*) FILTER (WHERE NOT is_valid) AS n_rejected
FROM validity""",
    "optional_defaults": f"""
SELECT doc_id, true AS is_valid,
  CASE WHEN doc_id % 3 = 0 THEN {_LIST} WHEN doc_id % 5 <> 0 THEN '[]' END AS commands,
  CASE WHEN doc_id % 2 = 0 THEN source END AS gui_path, CAST(NULL AS VARCHAR) AS warning
FROM documents""",
    "fix_steps": f"""
WITH {_STEPS}
SELECT doc_id, step_number, line AS instruction FROM steps
WHERE step_number IS NOT NULL AND line <> ''""",
    "fix_step_violations": f"""
WITH {_STEPS}
SELECT doc_id, pos, '$.step_number' AS path, 'required' AS rule FROM steps WHERE step_number IS NULL
UNION ALL
SELECT doc_id, pos, '$.instruction' AS path, 'required' AS rule FROM steps WHERE line = ''""",
    "next_step_choices": f"""
WITH e AS (SELECT event_id, {_CHOICE} AS c FROM events)
SELECT event_id, c IN ({_NEXT}) AS is_valid,
  CASE WHEN c NOT IN ({_NEXT}) THEN '$.informs_next_step_type' END AS path,
  CASE WHEN c NOT IN ({_NEXT}) THEN 'enum' END AS rule
FROM e""",
    "extended_violations": f"""
WITH {_STEPS}
SELECT doc_id, path, 'required' AS rule
FROM documents, (VALUES ('$.problem_metadata'), ('$.user_problem_post'),
  ('$.diagnostic_reasoning_process'), ('$.expert_solution_reply.acknowledgement'),
  ('$.expert_solution_reply.explanation'), ('$.expert_solution_reply.root_cause_simplified'),
  ('$.expert_solution_reply.relevant_expert_context'),
  ('$.expert_solution_reply.verification_steps')) v(path)
UNION ALL
SELECT doc_id, '{_FIX}[' || pos || '].step_number' AS path, 'required' AS rule
FROM steps WHERE step_number IS NULL
UNION ALL
SELECT doc_id, '{_FIX}[' || pos || '].instruction' AS path, 'required' AS rule
FROM steps WHERE line = ''""",
    "extended_record_gaps": """
SELECT path, 'required' AS rule, (SELECT count(*) FROM documents) AS n
FROM (VALUES ('$.diagnostic_reasoning_process'), ('$.expert_solution_reply.relevant_expert_context'),
  ('$.expert_solution_reply.step_by_step_fix'), ('$.expert_solution_reply.verification_steps')) v(path)""",
}

