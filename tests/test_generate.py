import os
import tracemalloc
import uuid

import pyarrow as pa
import pyarrow.dataset as ds
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from recordloom.backends.base import Generation
from recordloom.backends.template import EchoBackend, TemplateBackend, template_record, template_text
from recordloom.operators import generate as generate_module
from recordloom.operators.generate import (
    _Task,
    _to_python,
    build_requests,
    generate,
    pending,
    spread,
)
from recordloom.operators.pieces import PIECE_BYTES, pieces
from recordloom.sinks.staging import stage, stage_parts


def _prompts(spark, n, partitions=3):
    return spark.range(n, numPartitions=partitions).select(
        F.col("id"), F.concat(F.lit("prompt "), F.col("id")).alias("prompt")
    )


def _counting(calls):
    class Counting(TemplateBackend):
        def generate(self, batch):
            calls.add(len(batch))
            return super().generate(batch)

    return Counting


def _sizes():
    class Sizes(TemplateBackend):
        def generate(self, batch):
            return [Generation(str(len(batch)), "stop", 1) for _ in batch]

    return Sizes


def _broken(word, as_row):
    class Broken(TemplateBackend):
        def generate(self, batch):
            if as_row:
                return [
                    Generation(None, error="no") if word in r.messages[-1]["content"] else Generation("x")
                    for r in batch
                ]
            if any(word in r.messages[-1]["content"] for r in batch):
                raise RuntimeError("boom")
            return [Generation("x") for _ in batch]

    return Broken


def test_batches_never_exceed_the_size(spark):
    done = generate(build_requests(_prompts(spark, 100)), _sizes(), batch_size=8)
    sizes = [int(r["generated_text"]) for r in done.collect()]
    assert len(sizes) == 100 and max(sizes) == 8


def test_staged_result_is_generated_once(spark):
    calls = spark.sparkContext.accumulator(0)
    staged = stage(generate(build_requests(_prompts(spark, 50)), _counting(calls)))
    assert calls.value == 50
    assert staged.where(F.get_json_object("generated_text", "$.problem_metadata").isNotNull()).count() == 50
    assert staged.where("finish_reason = 'length'").count() == 0
    assert calls.value == 50


def test_filters_stay_above_the_model_step(spark):
    calls = spark.sparkContext.accumulator(0)
    done = generate(build_requests(_prompts(spark, 40)), _counting(calls))
    done.where("id < 5 AND generated_text LIKE '%Boot%'").collect()
    assert calls.value == 40


def test_columns_come_through_unchanged(spark):
    df = spark.sql(
        "SELECT 'p' AS prompt, CAST(NULL AS INT) AS a, 7 AS b, DATE'2024-02-03' AS c, "
        "CAST(1.20 AS DECIMAL(5,2)) AS d, array(1, NULL) AS e, X'00FF' AS f "
        "UNION ALL SELECT 'q', 3, NULL, NULL, NULL, NULL, NULL"
    )
    names = ["prompt", "a", "b", "c", "d", "e", "f"]
    done = generate(build_requests(df), TemplateBackend)
    assert sorted(done.select(names).collect(), key=str) == sorted(df.collect(), key=str)
    assert [done.schema[n].dataType for n in names] == [df.schema[n].dataType for n in names]
    assert "messages" not in done.columns
    assert "messages" in generate(build_requests(df), TemplateBackend, keep_requests=True).columns


@pytest.mark.parametrize("as_row", [True, False])
def test_failure_stops_or_is_recorded(spark, as_row):
    requests = build_requests(_prompts(spark, 20))
    backend = _broken("prompt 13", as_row)
    with pytest.raises(Exception, match="no|boom"):
        generate(requests, backend).collect()
    kept = generate(requests, backend, on_error="record").collect()
    failed = [r["id"] for r in kept if r["generation_error"]]
    assert failed == [13] and len(kept) == 20
    assert all(r["generated_text"] == "x" for r in kept if r["id"] != 13)


def _noting(folder, bad=()):
    """A backend that notes the size of every batch in a file name and fails on ``bad`` prompts."""

    class Sizes(TemplateBackend):
        def generate(self, batch):
            open(os.path.join(folder, f"{len(batch)}-{uuid.uuid4().hex}"), "w").close()
            if any(r.messages[-1]["content"] in bad for r in batch):
                raise RuntimeError("boom")
            return [Generation(r.messages[-1]["content"]) for r in batch]

    return Sizes


def test_batches_are_full_whatever_the_arrow_limit(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        requests = build_requests(_prompts(spark, 100, 1))
        rows = generate(requests, _noting(str(tmp_path)), batch_size=16).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["id"] for r in rows] == list(range(100))
    assert all(r["generated_text"] == r["prompt"] for r in rows)
    sizes = sorted(int(n.split("-")[0]) for n in os.listdir(tmp_path))
    assert sizes == [4] + [16] * 6


def test_a_task_holds_a_piece_of_an_arrow_batch_as_python_objects():
    messages = [[{"role": "user", "content": f"{i} " + "x" * 4000}] for i in range(8000)]
    given = pa.RecordBatch.from_pydict({"id": range(8000), "messages": messages, "sampling_params": [{"top_k": 1}] * 8000})
    del messages
    ids = []
    task = _Task(EchoBackend, {}, 16, "fail", True)
    tracemalloc.start()
    try:
        for rows in task(iter([given])):
            ids += rows.column("id").to_pylist()
            assert rows.column("generated_text")[0].as_py().startswith(f"{ids[-rows.num_rows]} ")
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert ids == list(range(8000))
    assert most < 8 * PIECE_BYTES < given.nbytes / 3


def test_pieces_are_bounded_and_keep_every_row():
    texts = ["", "x" * 3 * PIECE_BYTES, None, *["y" * 1000] * 5000, "ä"]
    batch = pa.RecordBatch.from_pydict({"t": texts, "n": [[i] for i in range(len(texts))]}).slice(1)
    found = list(pieces(batch))
    assert pa.Table.from_batches(found).to_pydict() == batch.to_pydict()
    assert all(p.num_rows == 1 or p.nbytes <= PIECE_BYTES for p in found) and len(found) > 5
    assert [p.num_rows for p in pieces(batch.slice(0, 0))] == [0]


def test_bad_requests_are_found_by_halving(spark, tmp_path):
    requests = build_requests(_prompts(spark, 64, 1))
    backend = _noting(str(tmp_path), bad=("prompt 13", "prompt 40"))
    rows = generate(requests, backend, batch_size=64, on_error="record").collect()
    assert sorted(r["id"] for r in rows if r["generation_error"]) == [13, 40]
    assert all(r["generated_text"] == r["prompt"] for r in rows if not r["generation_error"])
    assert len(os.listdir(tmp_path)) <= 2 * 2 * 6 + 1


def test_short_answer_is_an_error_even_when_recording(spark):
    class Short(TemplateBackend):
        def generate(self, batch):
            return []

    with pytest.raises(Exception, match="answered 0 of"):
        generate(build_requests(_prompts(spark, 2)), Short, on_error="record").collect()


def test_a_backend_is_built_once_per_worker(spark):
    built = spark.sparkContext.accumulator(0)

    class Built(TemplateBackend):
        def __init__(self, options):
            super().__init__(options)
            built.add(1)

    requests = build_requests(_prompts(spark, 400, 80))
    assert len(generate(requests, Built).collect()) == 400
    assert 1 <= built.value <= spark.sparkContext.defaultParallelism


def test_a_lost_task_is_repeated_whole(spark):
    class FailsOnce(TemplateBackend):
        def generate(self, batch):
            if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
                raise RuntimeError("lost")
            return super().generate(batch)

    staged = stage(generate(build_requests(_prompts(spark, 30)), FailsOnce))
    assert sorted(r["id"] for r in staged.select("id").collect()) == list(range(30))


def test_backend_gets_options_and_schema(spark):
    class Tells(TemplateBackend):
        def __init__(self, options):
            self.options = options

        def generate(self, batch):
            return [Generation(f"{self.options['model']} {self.options['json_schema']}") for _ in batch]

    done = generate(build_requests(_prompts(spark, 1)), Tells, options={"model": "m"}, schema_text="{}")
    assert done.first()["generated_text"] == "m {}"


def test_bad_arguments(spark):
    requests = build_requests(_prompts(spark, 1))
    with pytest.raises(ValueError):
        generate(requests, TemplateBackend, on_error="ignore")
    with pytest.raises(ValueError):
        generate(requests, TemplateBackend, batch_size=0)
    with pytest.raises(ValueError, match="finish_reason"):
        generate(requests.withColumn("finish_reason", F.lit(1)), TemplateBackend)


def test_standin_has_one_text_in_both_forms(spark):
    prompts = ["", "plain", 'quote " and \\ slash', "new\nline\ttab", "ä € 😀", "x" * 5000]
    df = spark.createDataFrame([(p,) for p in prompts], "prompt string")
    native = [r[0] for r in df.select(F.to_json(template_record("prompt"))).collect()]
    assert native == [template_text(p) for p in prompts]


def test_spreading(spark):
    one = _prompts(spark, 100, 1)
    assert spread(one, None) is one
    sizes = [len(p) for p in spread(one, 5).rdd.glom().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    # Equal prompts do not meet in one task.
    equal = spark.range(100, numPartitions=1).select(F.lit("same").alias("prompt"))
    assert max(len(p) for p in spread(equal, 5).rdd.glom().collect()) <= 21


@pytest.mark.parametrize(
    "rows",
    [
        [None, [], [{"a": 1}, None, {"a": None}]],
        [None, {"a": [1, None]}, {"a": None}],
        [{"a": {"b": "x"}}, {"a": None}, {"a": {"b": None}}],
        ["x", None],
        [],
    ],
)
def test_nested_columns_become_python_rows(rows):
    column = pa.array(rows)
    for start in range(len(rows) + 1):
        part = column.slice(start)
        assert _to_python(part) == part.to_pylist()


PROMPT_ROWS = "id long, prompt string, x double, raw binary, row string"


def _prompt_rows(copies):
    kinds = [
        (1, "a", 0.0, b"x", "r"),
        (1, "a", None, b"x", "r"),
        (1, None, float("nan"), None, None),
        (None, "a", 0.0, b"", "r"),
        (2, "", 1.5, b"x", ""),
        (2, "b" * 5000, 1.5, b"x", "r"),
        (None, None, None, None, None),
    ]
    return [row for row, n in zip(kinds, copies) for _ in range(n)]


@pytest.mark.parametrize("most", [None, 0])
@pytest.mark.parametrize(
    "asked, answered",
    [
        ([1, 1, 1, 1, 1, 1, 1], [1, 0, 1, 0, 1, 0, 1]),
        ([3, 2, 4, 1, 5, 6, 3], [1, 2, 3, 0, 7, 2, 1]),
        ([2, 0, 0, 2, 0, 2, 0], [0, 1, 1, 0, 1, 0, 1]),
        ([1, 2, 3, 1, 2, 3, 1], [0] * 7),
        ([0] * 7, [1, 2, 0, 0, 0, 0, 1]),
    ],
)
def test_pending_counts_equal_rows(spark, monkeypatch, asked, answered, most):
    """The same rows as ``exceptAll``, by a broadcast of the keys or by a shuffle."""
    if most is not None:
        monkeypatch.setattr(generate_module, "BROADCAST_KEYS", most)
    prompts = spark.createDataFrame(_prompt_rows(asked), PROMPT_ROWS).repartition(3)
    minus = F.when(F.col("x") == 0, F.lit(-0.0)).otherwise(F.col("x"))
    done = spark.createDataFrame(_prompt_rows(answered), PROMPT_ROWS).withColumn("x", minus)
    done = done.withColumn("generated_text", F.lit("t"))
    rest = pending(prompts, done)
    assert rest.columns == prompts.columns
    assert sorted(map(str, rest.collect())) == sorted(
        map(str, prompts.exceptAll(done.select(*prompts.columns)).collect())
    )
    assert pending(prompts, None) is prompts


@pytest.mark.parametrize("most", [None, 0])
def test_pending_holds_no_texts(spark, monkeypatch, most):
    """Prompts stream past the keys that have answers; they are neither aggregated nor sorted."""
    if most is not None:
        monkeypatch.setattr(generate_module, "BROADCAST_KEYS", most)
    prompts = _prompts(spark, 60)
    rest = pending(prompts, prompts.where("id % 3 = 0").withColumn("generated_text", F.lit("t")))
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Aggregate", "Sort", "Window", "Generate"))
    assert ("ShuffledHashJoin" if most == 0 else "BroadcastHashJoin") in plan
    assert sorted(r["id"] for r in rest.collect()) == [i for i in range(60) if i % 3]


def test_a_task_holds_a_small_row_group_of_the_raw_table(spark, tmp_path):
    """A task writes its texts as it goes, not up to 128 MiB of them at once."""
    noise = F.expr("array_join(transform(sequence(1, 400), i -> sha2(concat(id, ' ', i), 256)), '')")
    stage_parts(spark.range(2_000, numPartitions=1).select("id", noise.alias("text")), str(tmp_path / "t"))
    [file] = ds.dataset(str(tmp_path / "t"), format="parquet").get_fragments()
    sizes = [group.total_byte_size for group in file.row_groups]
    assert len(sizes) > 1 and max(sizes) < 48 << 20
    assert spark.read.parquet(str(tmp_path / "t")).distinct().count() == 2_000
