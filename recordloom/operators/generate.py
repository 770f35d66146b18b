"""Requests from prompts, and the model step over them."""

from __future__ import annotations

import time
import uuid
from collections import deque
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.backends.base import Backend, BackendFactory, Generation, Request
from recordloom.functions.chat import DEFAULT_SYSTEM_TEXT, chat_messages, sampling_params
from recordloom.operators.pieces import pieces
from recordloom.schema import schema_id
from recordloom.shipping import ship_package
from recordloom.sinks.staging import stage

GENERATED_FIELDS = (
    T.StructField("generated_text", T.StringType()),
    T.StructField("finish_reason", T.StringType()),
    T.StructField("n_output_tokens", T.IntegerType()),
    T.StructField("generation_ms", T.DoubleType()),
    T.StructField("generation_error", T.StringType()),
)
REQUEST_COLUMNS = ("messages", "sampling_params")
# Keys of answered rows up to this number are broadcast (about 200 bytes each, so 50 MB).
BROADCAST_KEYS = 250_000


class GenerationFailed(RuntimeError):
    """The backend failed for a request and the run asked to stop on failure."""


def build_requests(
    prompts: DataFrame,
    *,
    prompt: str = "prompt",
    system_text: str = DEFAULT_SYSTEM_TEXT,
    schema_text: str | None = None,
    inline_schema: bool = False,
    **sampling: Any,
) -> DataFrame:
    """Add ``messages``, ``sampling_params`` and ``schema_id`` to a prompt table.

    A projection, put after any exchange so that only the prompts themselves move.  The
    schema text rides on every row only with ``inline_schema``; otherwise rows carry its
    digest and :func:`generate` hands the text to the backend once per worker process.
    """
    return prompts.withColumns(
        {
            "messages": chat_messages(F.col(prompt), system_text),
            "sampling_params": sampling_params(
                **sampling, schema_text=schema_text if inline_schema else None
            ),
            "schema_id": F.lit(schema_id(schema_text) if schema_text else None).cast("string"),
        }
    )


def spread(prompts: DataFrame, partitions: int | None) -> DataFrame:
    """Deal rows out evenly over ``partitions`` tasks, whatever their keys.

    None keeps the scan's own splits and costs no exchange: right for a large, splittable
    table.  A number is for prompts that come from few files.  Rows are dealt round
    robin, so equal prompts do not meet in one task.
    """
    return prompts if partitions is None else prompts.repartition(partitions)


def _row_key(prompts: DataFrame) -> Column:
    """What tells rows apart, with SHA-256 digests in place of texts."""
    digested = (T.StringType(), T.BinaryType())
    return F.struct(
        *[
            (F.unhex(F.sha2(f.name, 256)) if f.dataType in digested else F.col(f.name)).alias(f"k{i}")
            for i, f in enumerate(prompts.schema.fields)
        ]
    )


def pending(prompts: DataFrame, done: DataFrame | None, path: str | None = None) -> DataFrame:
    """The prompts that have no answer in ``done``, which holds all of their columns.

    By rows and their number, not by id alone: equal prompts may share an id.  Rows are counted
    by their keys, and the keys that have answers are staged at ``path`` (a fresh one if not
    given), so no map or sort holds texts: prompts stream past a broadcast of the keys or, where
    they are many, past a hash table of each partition's.  Only copies of a row that has fewer
    answers than copies are sorted, to be numbered.
    """
    if done is None:
        return prompts
    key = _row_key(prompts)
    asked = prompts.select(F.struct(*prompts.columns).alias("row"), key.alias("key"))
    both = prompts.select(key.alias("key"), F.lit(0).alias("answers")).unionAll(
        done.select(key.alias("key"), F.lit(1))
    )
    found = both.groupBy("key").agg(
        F.sum("answers").alias("answers"), F.count_if(F.col("answers") == 0).alias("copies")
    )
    answered = stage(found.where("answers > 0"), path, again=True)
    open_ones = answered.where("copies > answers")
    n, n_open = answered.agg(F.count(F.lit(1)), F.count_if(F.col("copies") > F.col("answers"))).first()

    def small(keys: DataFrame, n_keys: int) -> DataFrame:
        kinds = [f.dataType for f in keys.schema["key"].dataType.fields]
        bounded = all(isinstance(k, T.AtomicType) and not isinstance(k, T.StringType) for k in kinds)
        fits = bounded and n_keys <= BROADCAST_KEYS
        return F.broadcast(keys) if fits else keys.hint("shuffle_hash")

    rest = asked.join(small(answered.select("key"), n), "key", "left_anti").select("row.*")
    if n_open:
        copy = F.row_number().over(Window.partitionBy("key").orderBy("key"))
        numbered = asked.join(small(open_ones, n_open), "key").withColumn("copy", copy)
        rest = rest.unionAll(numbered.where("copy <= copies - answers").select("row.*"))
    return rest


def _to_python(column: pa.Array) -> list[Any]:
    """``column.to_pylist()`` for nested columns, several times faster.

    Converts the flat children as a whole and puts the rows together from them.
    """
    if pa.types.is_struct(column.type):
        names = [f.name for f in column.type]
        children = [_to_python(child) for child in column.flatten()]
        rows: list[Any] = [dict(zip(names, values)) for values in zip(*children)]
        if column.null_count:
            rows = [row if there else None for row, there in zip(rows, column.is_valid().to_pylist())]
        return rows
    if pa.types.is_list(column.type):
        values, out, start = _to_python(column.flatten()), [], 0
        for length in column.value_lengths().to_pylist():
            end = start + (length or 0)
            out.append(None if length is None else values[start:end])
            start = end
        return out
    return column.to_pylist()


# The backend of this worker process and the model step it belongs to.  Spark reuses worker
# processes, so a model is built once per worker and step instead of once per task; a step
# with another model takes the place of the last one.
_built: dict[str, Backend] = {}


class _Task:
    """The function one task runs: take the worker's backend, feed it batches."""

    def __init__(
        self, factory: BackendFactory, options: dict[str, Any], batch_size: int, on_error: str,
        drop_requests: bool,
    ):
        self.factory = factory
        self.options = options
        self.batch_size = batch_size
        self.on_error = on_error
        self.drop_requests = drop_requests
        self.step = uuid.uuid4().hex

    def _backend(self) -> Backend:
        if self.step not in _built:
            _built.clear()
            _built[self.step] = self.factory(self.options)
        return _built[self.step]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Arrow batches (bounded in rows and bytes by the session) in, their rows out in pieces.

        Model batches go on over the borders of pieces, so all but the last of a task are
        full.  What waits for answers are fewer requests than a model batch holds, and the
        pieces that they came in.
        """
        held: deque[pa.RecordBatch] = deque()
        waiting: list[Request] = []
        answers: deque[tuple[Generation, float]] = deque()
        for rows in (piece for batch in batches for piece in pieces(batch)):
            held.append(rows)
            columns = [_to_python(rows.column(name)) for name in REQUEST_COLUMNS]
            waiting += [Request(messages, sampling) for messages, sampling in zip(*columns)]
            full = len(waiting) - len(waiting) % self.batch_size
            answers += self._answers(waiting[:full])
            del waiting[:full]
            while held and len(answers) >= held[0].num_rows:
                yield self._with_answers(held.popleft(), answers)
        answers += self._answers(waiting)
        while held:
            yield self._with_answers(held.popleft(), answers)

    def _answers(self, requests: list[Request]) -> list[tuple[Generation, float]]:
        """Answers with their share of the time of their batch."""
        out: list[tuple[Generation, float]] = []
        for start in range(0, len(requests), self.batch_size):
            backend = self._backend()
            started = time.perf_counter()
            answered = self._call(backend, requests[start : start + self.batch_size])
            share = (time.perf_counter() - started) * 1000.0 / len(answered)
            out += [(answer, share) for answer in answered]
        return out

    def _with_answers(
        self, rows: pa.RecordBatch, answers: deque[tuple[Generation, float]]
    ) -> pa.RecordBatch:
        """The rows with the first of the answers."""
        own = [answers.popleft() for _ in range(rows.num_rows)]
        if self.drop_requests:
            rows = rows.drop_columns(list(REQUEST_COLUMNS))
        added = [
            pa.array([a.text for a, _ in own], pa.string()),
            pa.array([a.finish_reason for a, _ in own], pa.string()),
            pa.array([a.n_output_tokens for a, _ in own], pa.int32()),
            pa.array([share for _, share in own], pa.float64()),
            pa.array([a.error for a, _ in own], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(
            rows.columns + added, names=rows.schema.names + [f.name for f in GENERATED_FIELDS]
        )

    def _call(self, backend: Backend, requests: list[Request]) -> list[Generation]:
        try:
            answers = backend.generate(requests)
        except Exception as problem:
            if self.on_error == "fail":
                raise
            if len(requests) == 1:
                return [Generation(None, error=f"{type(problem).__name__}: {problem}")]
            # Only the requests that fail on their own shall carry the error.  Halving finds k of
            # n in about 2 k log2(n / k) calls.
            half = len(requests) // 2
            return self._call(backend, requests[:half]) + self._call(backend, requests[half:])
        if len(answers) != len(requests):
            raise GenerationFailed(
                f"backend answered {len(answers)} of {len(requests)} requests"
            )
        if self.on_error == "fail":
            for answer in answers:
                if answer.error is not None:
                    raise GenerationFailed(answer.error)
        return answers


def generate(
    requests: DataFrame,
    factory: BackendFactory,
    *,
    options: dict[str, Any] | None = None,
    schema_text: str | None = None,
    batch_size: int = 16,
    on_error: str = "fail",
    keep_requests: bool = False,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Run the model over the requests; input columns stay, generation columns are added.

    The step is an Arrow map over each partition: input columns pass through as they came,
    and the planner never repeats it or moves a filter below it, as it would with a scalar
    UDF.  It still runs once per consumer of the lazy result, so stage the result
    (:func:`recordloom.sinks.staging.stage`) before using it more than once.

    ``on_error='record'`` fills ``generation_error`` instead of failing the run.
    ``keep_requests`` keeps the messages and sampling columns.  ``profile`` asks for
    accelerators per task (passed through, untested here).
    """
    if on_error not in ("fail", "record"):
        raise ValueError(f"on_error must be 'fail' or 'record', not {on_error!r}")
    if batch_size < 1:
        raise ValueError(f"batch_size must be positive, not {batch_size}")
    settings = dict(options or {})
    if schema_text is not None:
        settings["json_schema"] = schema_text
    kept = [
        f for f in requests.schema.fields if keep_requests or f.name not in REQUEST_COLUMNS
    ]
    taken = {f.name for f in kept} & {f.name for f in GENERATED_FIELDS}
    if taken:
        raise ValueError(f"columns {sorted(taken)} would be overwritten; rename them first")
    schema = T.StructType(kept + list(GENERATED_FIELDS))
    task = _Task(factory, settings, batch_size, on_error, not keep_requests)
    ship_package(requests.sparkSession)
    return requests.mapInArrow(task, schema, profile=profile)
