"""One run from prompts to saved records."""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime
from typing import Any

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.backends.base import BackendFactory
from recordloom.functions.chat import DEFAULT_SYSTEM_TEXT
from recordloom.operators.check import check_records
from recordloom.operators.generate import build_requests, generate, pending, spread
from recordloom.operators.measure import RULES, check_counted, counted
from recordloom.operators.profile import latency_measures
from recordloom.schema import json_schema_text
from recordloom.settings import RunConfig
from recordloom.sinks.jsonl import result_rows, run_name, sink_rows, write_jsonl
from recordloom.sinks.staging import remove, shared_folder, stage, stage_parts, staged_parts
from recordloom.sources.prompt_lists import PromptLists
from recordloom.sources.prompts import check_prompt_files, read_prompts

# Prompts of one task where they are dealt anew: what a lost task repeats at most.
ROWS_PER_TASK = 1_000


class RunError(RuntimeError):
    """A run whose counts do not agree."""


@dataclass(frozen=True)
class RunResult:
    """What a run left behind; paths are None and counts 0 when there were no prompts."""

    folder: str | None = None
    raw_path: str | None = None
    n_prompts: int = 0
    n_requests: int = 0
    n_failed: int = 0
    n_output_tokens: int = 0
    n_valid: int = 0
    n_rejected: int = 0
    violations: dict[str, int] | None = None
    n_saved: int = 0
    seconds: float = 0.0

    @property
    def output_path(self) -> str | None:
        return self.folder and f"{self.folder}/output"

    @property
    def records_path(self) -> str | None:
        return self.folder and f"{self.folder}/records"

    @property
    def latency_path(self) -> str | None:
        return self.folder and f"{self.folder}/latency"


def run(
    spark: SparkSession,
    config: RunConfig,
    factory: BackendFactory,
    *,
    prompts: DataFrame | None = None,
    partitions: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    staging_dir: str | None = None,
    system_text: str = DEFAULT_SYSTEM_TEXT,
    on_error: str = "fail",
    profile: ResourceProfile | None = None,
    moment: datetime | None = None,
    resume: str | None = None,
    keep_raw: bool = False,
) -> RunResult:
    """Read prompts, generate, stage the raw text once, check it and save everything.

    ``prompts`` (``prompt_id``, ``prompt``) replaces the configured prompt lists; such a
    table keeps its own splits unless ``partitions`` is given.  Prompts from lists are
    dealt over tasks of ``rows_per_task``, one per replica at least.  Below the run's folder::

        settings/   the run's settings, written before any model runs
        records/    checked records, partitioned by is_valid; text of rejected ones only
        output/     JSON Lines of every generated text
        latency/    one row, the sketch of the model's times (``run``, ``n_requests``, ``n_timed``,
                    ``latency``), to be merged with other runs' (operators/profile.py)

    Any failure raises; an output path that exists or cannot be written fails at once.

    The raw texts are staged task by task.  ``resume`` names the folder of a run that failed or was
    killed: prompts whose texts are staged are not asked for again, all others are, and records
    and output are written anew.  Prompts and settings have to be those of the first run.  The
    raw table is removed at the end unless ``keep_raw``; it stays after a failure.
    """
    started = time.perf_counter()
    if prompts is None:
        lists = PromptLists(spark, config.prompts_path)
        n_prompts = check_prompt_files(spark, lists).n_prompts
        prompts = read_prompts(spark, lists)
        partitions = partitions or max(config.replicas, -(-n_prompts // rows_per_task))
    else:
        n_prompts = prompts.count()
    if not n_prompts:
        return RunResult()

    if resume is None:
        moment = moment or datetime.now()
        folder = f"{config.output_dir.rstrip('/')}/{run_name(config.job_id, moment)}"
        # Staged in the folder all executors share; the output folder is shared by nature.
        base = staging_dir or shared_folder(spark) or folder
        raw_path = f"{base.rstrip('/')}/raw-{uuid.uuid4().hex}"
        _save_settings(spark, config, folder, raw_path)
    else:
        folder = resume.rstrip("/")
        raw_path = _settings_of(spark, config, folder)
    schema_text = json_schema_text()

    def answered(asked: DataFrame) -> DataFrame:
        requests = build_requests(
            spread(asked, partitions),
            system_text=system_text,
            schema_text=schema_text,
            temperature=config.temperature,
            max_tokens=config.max_new_tokens,
            top_p=config.top_p,
            top_k=config.top_k,
        )
        return generate(
            requests,
            factory,
            options=config.backend_options(),
            schema_text=schema_text,
            batch_size=config.batch_size,
            on_error=on_error,
            profile=profile,
        )

    schema = answered(prompts).schema
    done = staged_parts(spark, raw_path, schema)
    seen = Observation("generated")
    measures = [
        F.count(F.lit(1)).alias("n"),
        F.count("generation_error").alias("n_failed"),
        F.coalesce(F.sum("n_output_tokens"), F.lit(0)).alias("n_output_tokens"),
        *latency_measures(),
    ]
    answered_keys = f"{raw_path}-answered"
    asked = pending(prompts, done, answered_keys)
    stage_parts(answered(asked).observe(seen, *measures), raw_path)
    remove(spark, answered_keys)
    raw = spark.read.schema(schema).parquet(raw_path)
    # Counted on the way to the table, or from the table where an earlier run wrote to it too.
    counts = seen.get if done is None else raw.agg(*measures).first().asDict()
    if counts["n"] != n_prompts:
        raise RunError(f"{n_prompts} prompts gave {counts['n']} rows, see {raw_path}")

    _save_latency(spark, folder, counts)
    # Valid rows hold the parsed record; their text stays in the raw and the saved rows.
    rejected_text = F.when(~F.col("is_valid"), F.col("generated_text"))
    checked, checks = check_counted(
        check_records(raw).withColumn("generated_text", rejected_text), "checked"
    )
    again = resume is not None
    stage(checked, f"{folder}/records", partition_by=["is_valid"], again=again)

    saved, written = counted(sink_rows(result_rows(raw)), "saved")
    write_jsonl(saved, f"{folder}/output", again=again)
    if not keep_raw:
        remove(spark, raw_path)
    found = checks.get
    return RunResult(
        folder=folder,
        raw_path=raw_path if keep_raw else None,
        n_prompts=n_prompts,
        n_requests=counts["n"],
        n_failed=counts["n_failed"],
        n_output_tokens=counts["n_output_tokens"],
        n_valid=found["n_valid"],
        n_rejected=found["n_rejected"],
        violations={rule: found[rule] for rule in RULES},
        n_saved=written.get["n"],
        seconds=time.perf_counter() - started,
    )


def read_records(spark: SparkSession, result: RunResult) -> DataFrame:
    """The checked records of a run; filters on ``is_valid`` prune whole folders."""
    found = spark.read.parquet(result.records_path).schema
    # A folder name carries no type, so is_valid would come back as text.
    typed = [
        T.StructField(f.name, T.BooleanType()) if f.name == "is_valid" else f for f in found.fields
    ]
    return spark.read.schema(T.StructType(typed)).parquet(result.records_path)


def _settings_row(config: RunConfig) -> dict[str, str | None]:
    values: dict[str, Any] = {k: v for k, v in asdict(config).items() if k != "setting_warnings"}
    return {k: None if v is None else str(v) for k, v in values.items()}


def _save_settings(spark: SparkSession, config: RunConfig, folder: str, raw_path: str) -> None:
    row = _settings_row(config) | {"raw_path": raw_path}
    table = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    table.coalesce(1).write.mode("errorifexists").json(f"{folder}/settings")


def _save_latency(spark: SparkSession, folder: str, counts: dict[str, Any]) -> None:
    row = (folder.rsplit("/", 1)[-1], counts["n_requests"], counts["n_timed"], bytes(counts["latency"]))
    table = spark.createDataFrame([row], "run string, n_requests long, n_timed long, latency binary")
    table.coalesce(1).write.mode("overwrite").parquet(f"{folder}/latency")


def _settings_of(spark: SparkSession, config: RunConfig, folder: str) -> str:
    """The raw table of an earlier run, whose settings have to be the same."""
    row = _settings_row(config)
    names = ", ".join(f"{k} string" for k in [*row, "raw_path"])
    saved = spark.read.schema(names).json(f"{folder}/settings").first()
    other = sorted(k for k, v in row.items() if saved[k] != v)
    if other:
        raise RunError(f"{folder} was run with other settings: {', '.join(other)}")
    return saved["raw_path"]
