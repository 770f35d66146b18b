import glob
import json
import os
import time
import uuid
from collections import Counter
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark import TaskContext

from recordloom.__main__ import main
from recordloom.backends.base import Generation
from recordloom.backends.template import TemplateBackend, template_text
from recordloom.operators import profile
from recordloom.plans.run import read_records, run
from recordloom.settings import RunConfig
from recordloom.sinks.jsonl import SINK_COLUMN
from recordloom.sources.prompts import PromptFileError, prompts_from_table

MOMENT = datetime(2024, 5, 6, 7, 8, 9)


def _config(tmp_path, text, **kw):
    path = tmp_path / "prompts.json"
    path.write_text(text, encoding="utf-8")
    return RunConfig(prompts_path=str(path), output_dir=str(tmp_path / "out"), **kw)


def test_run_from_a_list(spark, tmp_path):
    prompts = ["one", "zwei ä", "drei"]
    calls = spark.sparkContext.accumulator(0)

    class Counting(TemplateBackend):
        def generate(self, batch):
            calls.add(len(batch))
            return super().generate(batch)

    config = _config(tmp_path, json.dumps(prompts), job_id="42", batch_size=2)
    result = run(spark, config, Counting, moment=MOMENT)
    assert calls.value == 3
    assert os.path.basename(result.folder) == "records_42_20240506_070809"
    assert (result.n_prompts, result.n_requests, result.n_failed, result.n_saved) == (3, 3, 0, 3)
    assert (result.n_valid, result.n_rejected) == (3, 0) and not any(result.violations.values())
    saved = []
    for part in glob.glob(f"{result.output_path}/part-*"):
        with open(part) as f:
            saved += [json.loads(line)[SINK_COLUMN] for line in f]
    assert sorted(saved) == sorted(template_text(p) for p in prompts)
    records = read_records(spark, result)
    assert sorted(r["prompt"] for r in records.where("is_valid").collect()) == sorted(prompts)
    settings = [json.loads(open(p).read()) for p in glob.glob(f"{result.folder}/settings/part-*")]
    assert settings[0]["job_id"] == "42"
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run(spark, config, Counting, moment=MOMENT)
    assert calls.value == 3  # the second run stopped before the model


def test_latencies_of_several_runs(spark, tmp_path):
    class Slow(TemplateBackend):
        def generate(self, batch):
            time.sleep(0.02)
            return super().generate(batch)

    done = [run(spark, _config(tmp_path, json.dumps(["a"] * n), job_id=str(n), batch_size=1), backend, moment=MOMENT)
            for n, backend in ((9, TemplateBackend), (3, Slow))]
    saved = spark.read.parquet(*[r.latency_path for r in done])
    assert {(r.run, r.n_requests) for r in saved.collect()} == {
        ("records_9_20240506_070809", 9), ("records_3_20240506_070809", 3)}
    rows = profile.latency_quantiles(profile.merged_latencies(saved), (0.5, 1.0)).collect()
    assert rows[0].n_timed == 12 and rows[0].latency_ms <= rows[1].latency_ms and rows[1].latency_ms >= 20


def test_run_from_a_table_with_rejected_and_failed_rows(spark, tmp_path):
    class Mixed(TemplateBackend):
        def generate(self, batch):
            kind = {"0": Generation("{}"), "1": Generation(None, error="e"), "2": Generation("nope")}
            return [kind.get(r.messages[-1]["content"]) or super(Mixed, self).generate([r])[0] for r in batch]

    table = spark.range(10).selectExpr("id", "cast(id as string) AS t")
    config = RunConfig(output_dir=str(tmp_path / "out"))
    result = run(spark, config, Mixed, prompts=prompts_from_table(table, "t", ["id"]), on_error="record",
                 staging_dir=str(tmp_path / "staged"), keep_raw=True)
    assert (result.n_requests, result.n_failed, result.n_valid, result.n_rejected) == (10, 1, 7, 3)
    assert result.violations == {
        "json_object": 2, "too_large": 0, "required": 3, "type": 0, "enum": 0, "range": 0
    }
    assert result.n_saved == 10 and result.raw_path.startswith(str(tmp_path / "staged"))
    rejected = read_records(spark, result).where("NOT is_valid")
    assert sorted(r["id"] for r in rejected.collect()) == [0, 1, 2]


def test_no_prompts_is_a_clean_no_op(spark, tmp_path):
    result = run(spark, _config(tmp_path, "[]"), TemplateBackend)
    assert result.folder is None and result.n_saved == 0
    assert not (tmp_path / "out").exists()


def test_bad_list_stops_before_anything_is_written(spark, tmp_path):
    with pytest.raises(PromptFileError):
        run(spark, _config(tmp_path, '["a", 3]'), TemplateBackend)
    assert not (tmp_path / "out").exists()


def test_unwritable_output_stops_before_the_model(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    class Counting(TemplateBackend):
        def generate(self, batch):
            calls.add(1)
            return super().generate(batch)

    (tmp_path / "out").write_text("a file where the folder should be")
    with pytest.raises(Exception):
        run(spark, _config(tmp_path, '["a"]'), Counting)
    assert calls.value == 0


def test_engine_failure_saves_nothing(spark, tmp_path):
    class Broken(TemplateBackend):
        def generate(self, batch):
            raise RuntimeError("engine down")

    with pytest.raises(Exception, match="engine down"):
        run(spark, _config(tmp_path, '["a"]'), Broken, moment=MOMENT)
    assert not glob.glob(str(tmp_path / "out" / "*" / "output"))
    assert not glob.glob(str(tmp_path / "out" / "*" / "records"))


def test_tasks_follow_the_number_of_prompts(spark, tmp_path):
    class Partition(TemplateBackend):
        def generate(self, batch):
            return [Generation(str(TaskContext.get().partitionId())) for _ in batch]

    config = _config(tmp_path, json.dumps([f"p{i}" for i in range(50)]))
    result = run(spark, config, Partition, rows_per_task=10, keep_raw=True)
    tasks = spark.read.parquet(result.raw_path).groupBy("generated_text").count().collect()
    assert len(tasks) == 5 and max(t["count"] for t in tasks) <= 12


def _logging(log, broken=None):
    """A backend that leaves a file per prompt that it was asked for; it fails on ``broken``."""

    class Logging(TemplateBackend):
        def generate(self, batch):
            for request in batch:
                prompt = request.messages[-1]["content"]
                if prompt == broken:
                    time.sleep(4)  # the other tasks are done by then
                    raise RuntimeError("engine down")
                open(os.path.join(log, f"{prompt}-{uuid.uuid4().hex}"), "w").close()
            return super().generate(batch)

    return Logging


def _asked(folder):
    return sorted(name.rsplit("-", 1)[0] for name in os.listdir(folder))


def test_a_failed_run_goes_on(spark, tmp_path):
    prompts = [f"p{i}" for i in range(37)] + ["same"] * 3
    config = _config(tmp_path, json.dumps(prompts), batch_size=2)
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    os.mkdir(first), os.mkdir(second)
    with pytest.raises(Exception, match="engine down"):
        run(spark, config, _logging(first, "p20"), rows_per_task=5, moment=MOMENT)
    [folder] = glob.glob(str(tmp_path / "out" / "*"))
    raw = json.loads(open(glob.glob(f"{folder}/settings/part-*")[0]).read())["raw_path"]
    staged = [r["prompt"] for r in spark.read.parquet(raw).collect()]
    assert 20 <= len(staged) < 40 and set(staged) <= set(_asked(first))
    result = run(spark, config, _logging(second), rows_per_task=5, resume=folder)
    assert _asked(second) == sorted((Counter(prompts) - Counter(staged)).elements())
    assert (result.n_requests, result.n_saved, result.n_valid) == (40, 40, 40)
    found = [r["prompt"] for r in read_records(spark, result).collect()]
    assert sorted(found) == sorted(prompts)
    assert not os.path.exists(raw.removeprefix("file:"))
    with pytest.raises(Exception, match="other settings: batch_size"):
        run(spark, replace(config, batch_size=3), _logging(second), resume=folder)


def test_a_finished_stage_is_not_asked_again(spark, tmp_path):
    log = str(tmp_path / "log")
    os.mkdir(log)
    config = _config(tmp_path, '["a", "b"]')
    done = run(spark, config, _logging(log), moment=MOMENT, keep_raw=True)
    again = run(spark, config, _logging(log), resume=done.folder)
    assert _asked(log) == ["a", "b"] and again.n_saved == 2 and again.raw_path is None


def test_program(spark, tmp_path, monkeypatch):
    backend = "recordloom.backends.template:TemplateBackend"
    for name, text in {"good": '["a", "b"]', "none": "[]", "bad": "[1]"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    monkeypatch.setenv("OUTPUT_DIR_ENV", str(tmp_path / "out"))
    for name, code in {"good": 0, "none": 0, "bad": 1, "missing": 1}.items():
        monkeypatch.setenv("PROMPTS_FILE_ENV", str(tmp_path / f"{name}.json"))
        assert main([backend], spark) == code
    assert len(glob.glob(str(tmp_path / "out" / "*" / "output"))) == 1
    assert main(["recordloom"], spark) == 1 and main(["no.such:thing"], spark) == 1
    assert main([], spark) == 2
    monkeypatch.setenv("TEMPERATURE", "warm")
    assert main([backend], spark) == 1
