"""One query per operator, over the given tables.

Each takes the session and the folder of the tables and returns a DataFrame of scalar
columns.  Nothing is sampled, limited or collected; all but the counts are narrow plans
over the scan.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.backends.template import EchoBackend, template_record
from recordloom.functions import json_text
from recordloom.functions.chat import chat_messages, sampling_params
from recordloom.functions.salvage import salvaged
from recordloom.operators import check, lists, measure, profile
from recordloom.operators.generate import build_requests, generate, pending, spread
from recordloom.operators.once import once
from recordloom.operators.schema_rules import rule_table, schema_violations
from recordloom.operators.tree import nodes
from recordloom.schema import json_schema, json_schema_text, schema_id
from recordloom.sinks.jsonl import SINK_COLUMN, read_jsonl, result_rows, sink_rows, write_jsonl
from recordloom.sinks.staging import scratch_path, stage, stage_parts, staged_parts
from recordloom.sources.prompt_lists import PromptLists, write_prompt_lists
from recordloom.sources.prompts import (
    check_prompt_files,
    explode_prompt_lists,
    prompts_from_table,
    read_prompts,
)

Query = Callable[[SparkSession, str], DataFrame]

# Characters that the query on cut texts leaves of each.
CUT = 1024
BATCH = 16


# Declared, so that no job reads file footers to find the columns out.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, user_id bigint, event_type string, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}


# Session setting: tasks over which the tables' rows are dealt, for tables that are a single row
# group and would be read and worked on by one task.  Unset, a table keeps its own splits.
PARTITIONS_SETTING = "spark.recordloom.partitions"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    rows = spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")
    partitions = spark.conf.get(PARTITIONS_SETTING, None)
    return spread(rows, int(partitions) if partitions else None)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.col("text").alias("prompt"))


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """The stand-in's record text per document, built by expressions alone."""
    return documents(spark, folder).select(
        "doc_id", F.to_json(template_record("prompt")).alias("generated_text")
    )


def _swap(old: str, new: str) -> str:
    return f"replace(generated_text, '{old}', '{new}')"


# The record text with one of several defects, by document number.
_DEFECTS = [
    "generated_text",
    "left(generated_text, length(generated_text) div 2)",
    _swap('"user_goal":', '"aim":'),
    _swap('"requires_diagnostic":', '"requires_diagnostic":"yes","was":'),
    _swap('"difficulty":"', '"difficulty":"Not '),
    "concat(generated_text, ' done')",
    "NULL",
    _swap('"system_context":{', '"system_context":"none","was":{'),
    _swap('"acknowledgement":', '"acknowledgement":null,"said":'),
    "concat('[', generated_text, ']')",
    "concat(generated_text, ',', generated_text)",
    "concat('  ', generated_text, chr(10))",
    _swap('"title":', '"title":5,"old_title":'),
    "''",
    _swap('"expert_solution_reply":', '"reply":'),
    _swap('"simulated_source":"', '"simulated_source":"The '),
]


def damage() -> Column:
    cases = " ".join(f"WHEN {i} THEN {sql}" for i, sql in enumerate(_DEFECTS))
    return F.expr(f"CASE doc_id % {len(_DEFECTS)} {cases} END")


def damaged(spark: SparkSession, folder: str) -> DataFrame:
    return once(raw(spark, folder), "_text", damage()).select(
        "doc_id", F.col("_text").alias("generated_text")
    )


def _answered(texts: DataFrame, **how: str) -> DataFrame:
    """``generated_text`` taken through requests and the model step, which gives it back."""
    requests = build_requests(
        texts.withColumnRenamed("generated_text", "prompt"),
        schema_text=json_schema_text(),
        max_tokens=None,
    ).drop("prompt", "schema_id")
    return generate(requests, EchoBackend, batch_size=BATCH, **how)


def _generated(spark: SparkSession, folder: str) -> DataFrame:
    return _answered(raw(spark, folder))


def _violations(spark: SparkSession, folder: str) -> DataFrame:
    found = check.find_violations(check.parse_text(damaged(spark, folder)))
    return found.select("doc_id", check.DOCUMENT, F.explode("violations").alias("v")).select(
        "doc_id", check.DOCUMENT, "v.path", "v.rule"
    )


# Sources and settings


def prompts_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    return prompts_from_table(table(spark, folder, "documents"), "text", ["doc_id"])


def prompt_count(spark: SparkSession, folder: str) -> DataFrame:
    return prompts_from_documents(spark, folder).agg(F.count(F.lit(1)).alias("n"))


def prompt_list_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts out of JSON lists: each document's lines, written as a list."""
    listed = documents(spark, folder).select(
        "doc_id", F.to_json(F.split("prompt", "\n")).alias("text")
    )
    return explode_prompt_lists(listed, "doc_id").withColumn("pos", F.col("pos").cast("bigint"))


def prompt_list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as JSON list files, one list per task, and read back in splits.

    The number in front of each text takes the place of its position, which the tasks decide.
    """
    path = scratch_path(spark, "lists")
    numbered = F.concat_ws(" ", F.col("doc_id").cast("string"), "prompt").alias("prompt")
    write_prompt_lists(documents(spark, folder).select(numbered), path)
    lists = PromptLists(spark, path)
    check_prompt_files(spark, lists)
    at = F.instr("prompt", " ")
    return read_prompts(spark, lists).select(
        F.expr("cast(substring_index(prompt, ' ', 1) AS bigint)").alias("doc_id"),
        F.col("prompt").substr(at + 1, F.length("prompt")).alias("prompt"),
    )


def prompt_list_check(spark: SparkSession, folder: str) -> DataFrame:
    """The whole-file verdict on good and damaged lists."""
    good = F.to_json(F.split("prompt", "\n"))
    body = good.substr(F.lit(1), F.length(good) - 1)
    kind = F.col("doc_id") % 9
    text = (
        F.when(kind == 0, good)
        .when(kind == 1, F.concat(body, F.lit(",3]")))
        .when(kind == 2, F.concat(body, F.lit(",null]")))
        .when(kind == 3, F.concat(F.lit('{"a":'), good, F.lit("}")))
        .when(kind == 4, body)
        .when(kind == 5, F.concat(good, F.lit(" x")))
        .when(kind == 6, F.lit(" [ ] "))
        .when(kind == 7, F.concat(F.lit("["), good, F.lit("]")))
        .when(kind == 8, F.concat(good, F.lit("\n")))
    )
    listed = documents(spark, folder).select("doc_id", text.alias("text"))
    parsed = once(listed, "elements", json_text.prompt_list(F.col("text")))
    return parsed.select(
        "doc_id", json_text.is_string_list(F.col("text"), "elements").alias("ok")
    )


def tolerant_setting(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_id") % 6
    text = (
        F.when(kind == 0, F.col("user_id").cast("string"))
        .when(kind == 1, F.col("event_type"))
        .when(kind == 2, F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
        .when(kind == 3, F.concat(F.col("user_id").cast("string"), F.lit(".5")))
        .when(kind == 4, F.lit(""))
        .otherwise(F.lit("0"))
    )
    return table(spark, folder, "events").select(
        "event_id",
        json_text.tolerant_int(text).alias("parsed"),
        json_text.is_bad_int(text).alias("warned"),
    )


# Requests


def chat_message_rows(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(
        "doc_id", F.to_json(chat_messages(F.col("prompt"))).alias("messages")
    )


def sampling_params_greedy(spark: SparkSession, folder: str) -> DataFrame:
    warmth = F.when(F.col("doc_id") % 3 == 0, 0.0).when(F.col("doc_id") % 3 == 1, 0.7)
    params = sampling_params(warmth, max_tokens=1024, top_p=0.9, top_k=5)
    rows = documents(spark, folder).select("doc_id", "prompt", params.alias("p"))
    return rows.select(
        "doc_id", F.sha2("prompt", 256).alias("digest"), "p.temperature", "p.top_p", "p.top_k", "p.max_tokens", "p.detokenize"
    )


def schema_on_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests with the schema's digest, and its text inlined as asked."""
    return build_requests(
        documents(spark, folder), schema_text=json_schema_text(), inline_schema=True
    ).select(
        "doc_id",
        "schema_id",
        F.to_json("messages").alias("messages"),
        F.sha2("sampling_params.guided_decoding.json", 256).alias("inline_digest"),
    )


def nested_to_json(spark: SparkSession, folder: str) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    nested = table(spark, folder, "orders").select(
        "o_orderkey",
        F.struct("o_custkey", status.alias("status")).alias("buyer"),
        F.array(status, priority).alias("tags"),
        F.col("o_orderdate").alias("placed"),
        F.col("o_custkey").cast("decimal(12,2)").alias("amount"),
        F.when(F.col("o_orderkey") % 2 == 0, priority).alias("note"),
        F.create_map("o_orderkey", priority).alias("by_key"),
    )
    return nested.select("o_orderkey", json_text.json_safe(nested).alias("j"))


# Generation


def generate_template(spark: SparkSession, folder: str) -> DataFrame:
    return _generated(spark, folder).select("doc_id", "generated_text", "finish_reason")


def carried_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Input columns of several types on the far side of the model step."""
    rows = table(spark, folder, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.col("text").alias("prompt"),
        F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")).alias("maybe_chars"),
    )
    texts = rows.withColumn("generated_text", F.to_json(template_record("prompt"))).drop("prompt")
    return _answered(texts).select(
        "doc_id", "lang", "source", "n_chars", "maybe_chars",
        F.sha2("generated_text", 256).alias("digest"),
    )


def truncated_generations(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that end too early, and what the check says about them."""
    cut = raw(spark, folder).withColumn("generated_text", F.left("generated_text", F.lit(CUT)))
    return check.find_violations(check.parse_text(_answered(cut))).select(
        "doc_id", F.length("generated_text").alias("n_chars"),
        (F.size("violations") == 0).alias("is_valid"),
    )


def _with_failures(spark: SparkSession, folder: str) -> DataFrame:
    return _answered(damaged(spark, folder), on_error="record")


def generation_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Failures kept as rows: requests without content."""
    return _with_failures(spark, folder).select(
        "doc_id", "generation_error", F.col("generated_text").isNull().alias("empty")
    )


def generation_totals(spark: SparkSession, folder: str) -> DataFrame:
    return measure.throughput(_with_failures(spark, folder)).select("n_requests", "n_failed")


def throughput(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and rates from given columns: length as tokens, a number per row as milliseconds."""
    done = table(spark, folder, "documents").select(
        F.col("n_chars").alias("n_output_tokens"),
        (F.col("doc_id") % 1000 + 1).cast("double").alias("generation_ms"),
        F.when(F.col("doc_id") % 7 == 0, F.col("source")).alias("generation_error"),
    )
    return measure.throughput(done).drop("tokens_per_second")


def latency_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Latencies of three runs, sketched and saved per run and source, merged by source.

    Next to each quantile stands whether its true rank, counted over the rows, is within the
    sketch's error; least and greatest values are exact.
    """
    done = table(spark, folder, "documents").select(
        F.coalesce("source", F.lit("")).alias("source"),
        F.concat(F.lit("run"), F.col("doc_id") % 3).alias("run"),
        (F.col("doc_id") * 7919 % 10007).cast("double").alias("generation_ms"),
    )
    path = scratch_path(spark, "latencies")
    profiles = profile.latency_profile(done, F.col("run"), ["source"])
    stage(profiles, path)
    saved = spark.read.schema(profiles.schema).parquet(path)
    asked = profile.latency_quantiles(profile.merged_latencies(saved, ["source"]))
    counted = done.join(asked, "source").groupBy("source", "rank", "n_requests", "latency_ms").agg(
        F.count_if(F.col("generation_ms") < F.col("latency_ms")).alias("below"),
        F.count_if(F.col("generation_ms") <= F.col("latency_ms")).alias("up_to"),
    )
    place, slack = F.col("rank") * F.col("n_requests"), profile.QUANTILE_ERROR * F.col("n_requests") + 1
    return counted.select(
        "source", "rank", "n_requests",
        ((F.col("below") <= place + slack) & (F.col("up_to") >= place - slack)).alias("is_within"),
        F.when(F.col("rank").isin(0.0, 1.0), F.col("latency_ms")).alias("extreme_ms"),
    )


def offending_values(spark: SparkSession, folder: str) -> DataFrame:
    """Values that break a rule, by frequency: item sketches of two runs, saved and merged."""
    texts, path = damaged(spark, folder), scratch_path(spark, "offending")
    for run in range(2):
        values = profile.offending_values(texts.where(F.col("doc_id") % 2 == run))
        stage(profile.item_profile(values, f"run{run}"), f"{path}/{run}")
    saved = spark.read.parquet(f"{path}/0").unionByName(spark.read.parquet(f"{path}/1"))
    return profile.frequent_values(profile.merged_items(saved), 1_000)


def resumed_generation(spark: SparkSession, folder: str) -> DataFrame:
    """A run that stopped when a third of the prompts was answered, gone on with to the end."""
    path = scratch_path(spark, "resumed")
    prompts = documents(spark, folder)

    def answered(asked: DataFrame, attempt: int) -> DataFrame:
        requests = build_requests(asked, schema_text=json_schema_text(), max_tokens=None)
        done = generate(requests, EchoBackend, batch_size=BATCH)
        return done.withColumn("attempt", F.lit(attempt))

    stage_parts(answered(prompts.where("doc_id % 3 = 0"), 1), path)
    schema = answered(prompts, 2).schema
    rest = pending(prompts, staged_parts(spark, path, schema))
    stage_parts(answered(rest, 2), path)
    return staged_parts(spark, path, schema).select(
        "doc_id", "attempt", F.sha2("generated_text", 256).alias("digest")
    )


def salvaged_records(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of record texts that end at all kinds of places."""
    end = (F.lit(64) + F.col("doc_id") * 97 % 1400).cast("int")
    cut = raw(spark, folder).select("doc_id", F.left("generated_text", end).alias("text"))
    found = once(cut, "s", salvaged("text"))
    return found.select(
        "doc_id", F.sha2("s.text", 256).alias("digest"), "s.complete", "s.n_dropped"
    )


def category_difficulty(spark: SparkSession, folder: str) -> DataFrame:
    """From prompts through the model step and the check to a count of valid records."""
    valid, _ = check.split_records(check.check_records(_generated(spark, folder)))
    return (
        valid.select("record.problem_metadata.category", "record.problem_metadata.difficulty")
        .groupBy("category", "difficulty")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def staged_split(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides of the split, from a table generated, checked and written once."""
    checked = check.check_records(once(_generated(spark, folder), "_text", damage()), "_text")
    staged = stage(
        checked.select("doc_id", "is_valid", "violations", "record"), partition_by=["is_valid"]
    )
    valid, rejected = check.split_records(staged)
    shown = ["doc_id", F.size("violations").alias("n_violations"), "record.user_problem_post.title"]
    return valid.select(*shown, F.lit("valid").alias("side")).unionAll(
        rejected.select(*shown, F.lit("rejected").alias("side"))
    )


# Results and sink


def postprocess_rows(spark: SparkSession, folder: str) -> DataFrame:
    return result_rows(raw(spark, folder), provenance=False)


def saved_rows(spark: SparkSession, folder: str) -> DataFrame:
    return sink_rows(result_rows(damaged(spark, folder)))


def jsonl_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Sink rows written as JSON Lines to the shared folder and read back."""
    path = scratch_path(spark, "jsonl")
    write_jsonl(saved_rows(spark, folder), path)
    return read_jsonl(spark, path)


def jsonl_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The saved lines as text: one per row, ASCII only, the key there even for null."""
    path = scratch_path(spark, "jsonl")
    write_jsonl(saved_rows(spark, folder), path)
    line = F.col("value")
    return spark.read.text(path).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(line.startswith(f'{{"{SINK_COLUMN}":')).alias("n_with_key"),
        F.count_if(line == f'{{"{SINK_COLUMN}":null}}').alias("n_null"),
        F.count_if(line.rlike("[^\\x00-\\x7F]")).alias("n_non_ascii"),
    )


# Checks


def json_object_check(spark: SparkSession, folder: str) -> DataFrame:
    return check.parse_text(damaged(spark, folder)).select(
        "doc_id", check.is_one_object().alias("ok")
    )


def violations(spark: SparkSession, folder: str) -> DataFrame:
    return _violations(spark, folder).select("doc_id", "path", "rule")


def required_fields(spark: SparkSession, folder: str) -> DataFrame:
    return _violations(spark, folder).where("rule = 'required'").select("doc_id", "path")


def type_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return _violations(spark, folder).where("rule = 'type'").select("doc_id", "path")


def enum_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    """Values outside their permitted set; the path is data here, so each is asked for."""
    metadata = f"{check.RECORD}.problem_metadata"

    def text_at(name: str) -> Column:
        return F.try_variant_get(check.DOCUMENT, f"{metadata}.{name}", "string")

    value = F.when(F.col("path").endswith(".difficulty"), text_at("difficulty")).otherwise(
        text_at("simulated_source")
    )
    return (
        _violations(spark, folder)
        .where("rule = 'enum'")
        .select("doc_id", "path", value.alias("value"))
    )


def props_extra_keys(spark: SparkSession, folder: str) -> DataFrame:
    parsed = table(spark, folder, "events").select("event_id", F.try_parse_json("props").alias("v"))
    keys = check.undeclared_keys("v", "$", ["id"])
    return parsed.select("event_id", F.explode(keys).alias("key"))


def record_extra_keys(spark: SparkSession, folder: str) -> DataFrame:
    parsed = check.parse_text(damaged(spark, folder)).where(check.is_one_object())
    return parsed.select("doc_id", F.explode(check.extra_keys()).alias("key"))


def parsed_records(spark: SparkSession, folder: str) -> DataFrame:
    return check.flatten_record(check.check_records(raw(spark, folder)), "doc_id")


def valid_split(spark: SparkSession, folder: str) -> DataFrame:
    return check.check_records(damaged(spark, folder)).select("doc_id", "is_valid")


def violation_summary(spark: SparkSession, folder: str) -> DataFrame:
    return measure.violation_summary(check.check_records(damaged(spark, folder)))


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return measure.run_summary(check.check_records(damaged(spark, folder)))


# Inactive parts of the record


def _fix_step(spark: SparkSession, folder: str) -> DataFrame:
    """One fix step per document; optional fields are given, null or missing."""
    number = F.col("doc_id")
    step = F.struct(
        number.alias("step_number"),
        F.col("lang").alias("instruction"),
        F.when(number % 3 == 0, F.split("text", "\n")).alias("commands"),
        F.when(number % 2 == 0, F.col("source")).alias("gui_path"),
        F.col("text").alias("explanation"),
        F.lit(None).cast("string").alias("warning"),
    )
    with_nulls = F.to_json(step, {"ignoreNullFields": "false"})
    text = F.when(number % 5 == 0, with_nulls).otherwise(F.to_json(step))
    rows = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    return rows.select("doc_id", F.try_parse_json(text).alias("item"))


def optional_defaults(spark: SparkSession, folder: str) -> DataFrame:
    checked = lists.check_items(_fix_step(spark, folder), "StepByStepFixItem")
    return checked.select(
        "doc_id",
        "is_valid",
        F.to_json("record.commands").alias("commands"),
        "record.gui_path",
        "record.warning",
    )


def _step_lists(spark: SparkSession, folder: str) -> DataFrame:
    """A reply per document whose fix steps are the document's lines, some damaged."""
    step = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.when(i % 4 != 3, i + 1).alias("step_number"),
            F.when(line != "", line).alias("instruction"),
            F.col("lang").alias("explanation"),
        ),
    )
    reply = F.struct(F.struct(step.alias("step_by_step_fix")).alias("expert_solution_reply"))
    rows = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return check.parse_text(
        rows.select("doc_id", F.to_json(reply).alias("generated_text"))
    )


def _steps(spark: SparkSession, folder: str) -> DataFrame:
    items = lists.list_items(
        _step_lists(spark, folder), "$.expert_solution_reply.step_by_step_fix", "doc_id"
    )
    return lists.check_items(items, "StepByStepFixItem")


def fix_steps(spark: SparkSession, folder: str) -> DataFrame:
    return _steps(spark, folder).where("is_valid").select(
        "doc_id", "record.step_number", "record.instruction"
    )


def fix_step_violations(spark: SparkSession, folder: str) -> DataFrame:
    return _steps(spark, folder).select(
        "doc_id", "pos", F.explode("violations").alias("v")
    ).select("doc_id", "pos", "v.path", "v.rule")


def next_step_choices(spark: SparkSession, folder: str) -> DataFrame:
    """Diagnostic steps made of events; the event type stands in for some choices."""
    kind = F.col("event_id") % 4
    choice = (
        F.when(kind == 0, F.lit("ReadyForSolution"))
        .when(kind == 1, F.lit("RunAnotherDiagnosticCommand"))
        .when(kind == 2, F.lit("OutputNeedsUserClarification"))
        .otherwise(F.col("event_type"))
    )
    step = F.struct(
        F.col("event_type").alias("reason_for_command"),
        F.col("props").alias("diagnostic_command"),
        F.col("props").alias("simulated_output"),
        F.col("event_type").alias("interpretation"),
        choice.alias("informs_next_step_type"),
    )
    rows = table(spark, folder, "events").select("event_id", "event_type", "props")
    items = rows.select(
        "event_id", F.try_parse_json(F.to_json(step)).alias("item")
    )
    checked = lists.check_items(items, "DiagnosticStep")
    return checked.select("event_id", "is_valid", F.explode_outer("violations").alias("v")).select(
        "event_id", "is_valid", "v.path", "v.rule"
    )


def _part_schema(field: str) -> str:
    """A schema that asks for one part of the record only."""
    whole = json_schema()
    kept = {"properties": {field: whole["properties"][field]}, "required": [field]}
    return json.dumps({**whole, **kept})


def schema_table_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged records of three schemas in one table, checked by a join with the rules as rows."""
    texts = [
        json_schema_text(), _part_schema("user_problem_post"), _part_schema("expert_solution_reply"),
    ]
    which = F.array(*[F.lit(schema_id(t)) for t in texts])
    parsed = check.parse_text(damaged(spark, folder)).where(check.is_one_object())
    rows = parsed.select(
        "doc_id", F.get(which, (F.col("doc_id") % 3).cast("int")).alias("schema_id"),
        F.try_variant_get(check.DOCUMENT, check.RECORD, "variant").alias("v"),
    )
    found = nodes(rows, "v", "doc_id", "schema_id")
    return schema_violations(found, rule_table(spark, *texts), "doc_id")


def record_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as lists of lines, each a list of sentences, taken apart into nodes."""
    line = F.transform(
        F.split("text", "\n"),
        lambda x: F.struct(
            F.when(x == "", F.array().cast("array<string>"))
            .otherwise(F.split(x, "[.] ", -1)).alias("sentences"),
        ),
    )
    whole = F.struct(
        (F.col("doc_id") % 2 == 0).alias("even"), "source", F.col("n_chars").alias("size"),
        line.alias("parts"),
    )
    text = F.to_json(whole, {"ignoreNullFields": "false"})
    rows = table(spark, folder, "documents").select("doc_id", F.try_parse_json(text).alias("v"))
    return nodes(rows, "v", "doc_id").select("doc_id", "path", "kind", "text")


def extended_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Whole records with lists of records in them, each item judged where it stands."""
    found = check.find_violations(_step_lists(spark, folder), extended=True)
    return found.select("doc_id", F.explode("violations").alias("v")).select(
        "doc_id", "v.path", "v.rule"
    )


def extended_record_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """What active records lack when the inactive parts are asked for too."""
    checked = check.check_records(raw(spark, folder), extended=True)
    return (
        checked.select(F.explode("violations").alias("v"))
        .groupBy("v.path", "v.rule")
        .agg(F.count(F.lit(1)).alias("n"))
    )


QUERIES: dict[str, Query] = {
    "prompts_from_documents": prompts_from_documents,
    "prompt_count": prompt_count,
    "prompt_list_rows": prompt_list_rows,
    "prompt_list_files": prompt_list_files,
    "prompt_list_check": prompt_list_check,
    "tolerant_setting": tolerant_setting,
    "chat_messages": chat_message_rows,
    "sampling_params_greedy": sampling_params_greedy,
    "schema_on_requests": schema_on_requests,
    "nested_to_json": nested_to_json,
    "generate_template": generate_template,
    "carried_columns": carried_columns,
    "truncated_generations": truncated_generations,
    "generation_errors": generation_errors,
    "generation_totals": generation_totals,
    "throughput": throughput,
    "latency_quantiles": latency_quantiles,
    "offending_values": offending_values,
    "resumed_generation": resumed_generation,
    "salvaged_records": salvaged_records,
    "category_difficulty": category_difficulty,
    "staged_split": staged_split,
    "postprocess_rows": postprocess_rows,
    "sink_rows": saved_rows,
    "jsonl_round_trip": jsonl_round_trip,
    "jsonl_lines": jsonl_lines,
    "json_object_check": json_object_check,
    "violations": violations,
    "required_fields": required_fields,
    "type_mismatches": type_mismatches,
    "enum_mismatches": enum_mismatches,
    "props_extra_keys": props_extra_keys,
    "record_extra_keys": record_extra_keys,
    "parsed_records": parsed_records,
    "valid_split": valid_split,
    "violation_summary": violation_summary,
    "run_summary": run_summary,
    "optional_defaults": optional_defaults,
    "fix_steps": fix_steps,
    "fix_step_violations": fix_step_violations,
    "next_step_choices": next_step_choices,
    "schema_table_violations": schema_table_violations,
    "record_nodes": record_nodes,
    "extended_violations": extended_violations,
    "extended_record_gaps": extended_record_gaps,
}
