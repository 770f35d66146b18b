"""Lists read in byte ranges against Python's own reader."""

import json
import random
import tracemalloc

import pyarrow as pa
import pytest
from conftest import SMALL
from oracle_compare import connect, difference
from pyspark.sql import functions as F

from recordloom.operators.pieces import PIECE_BYTES
from recordloom.plans.oracles import ORACLES
from recordloom.plans.queries import QUERIES
from recordloom.sources.prompt_lists import PromptLists, _list_lines, _segments, write_prompt_lists
from recordloom.sources.prompts import check_prompt_files, read_prompts

PIECES = ['"', "\\", '\\"', "\\\\", ",", "[", "]", " ", "ä", "\n", "x" * 40, "", '","', "\U0001f600"]


@pytest.fixture
def narrow(spark):
    """Splits of 150 bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name in settings:
        spark.conf.unset(name)


def _random_list(rng):
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 9))) for _ in range(rng.randint(0, 25))]


def _texts():
    rng = random.Random(7)
    for i in range(6):
        found = _random_list(rng)
        yield found, json.dumps(found, ensure_ascii=i % 2 == 0, indent=i % 3 or None)


def test_any_split_gives_the_same_list(narrow, tmp_path):
    texts = dict(enumerate(_texts()))
    for i, (_, text) in texts.items():
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    lists = PromptLists(narrow, str(tmp_path))
    assert check_prompt_files(narrow, lists) == (len(texts), sum(len(p) for p, _ in texts.values()))
    got = {i: {} for i in texts}
    for r in read_prompts(narrow, lists).collect():
        got[int(r.path.split("/")[-1].split(".")[0])][r.pos] = r.prompt
    for i, (prompts, _) in texts.items():
        assert got[i] == dict(enumerate(prompts))


def test_verdict_on_damaged_lists(narrow, tmp_path):
    rng = random.Random(11)
    wanted = {}
    for i in range(40):
        text = json.dumps(_random_list(rng)[:8])
        at = rng.randrange(len(text))
        change = rng.choice(["", '"', "\\", ",", "]", "1", "[", "\t", "null", "é"])
        text = text[:at] + change + text[at + rng.randint(0, 2) :]
        try:
            found = json.loads(text)
            ok = isinstance(found, list) and all(isinstance(p, str) for p in found)
        except ValueError:
            ok = False
        wanted[f"{i}.json"] = ok
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    files = PromptLists(narrow, str(tmp_path)).files.collect()
    assert {r.path.split("/")[-1]: r.ok for r in files} == wanted
    assert 3 < sum(wanted.values()) < 37


def test_one_file_is_read_by_many_tasks(narrow, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([f"prompt {i}" for i in range(200)]))
    path = str(tmp_path / "one.json")
    lists = PromptLists(narrow, path)
    assert lists.prompts().count() == 200
    assert lists._lines().where("raw LIKE 'prompt%'").select(F.spark_partition_id()).distinct().count() >= 8


def test_written_lists_are_lists(spark, tmp_path):
    prompts = [(p,) for p in ("a", 'q"q', "", "line\nbreak", "ä", None)]
    write_prompt_lists(spark.createDataFrame(prompts, "prompt string").repartition(2), str(tmp_path / "l"))
    found = [p for f in (tmp_path / "l").glob("part-*") for p in json.loads(f.read_text())]
    assert sorted(found) == sorted(p for (p,) in prompts if p is not None)
    assert sorted(r.prompt for r in read_prompts(spark, str(tmp_path / "l")).collect()) == sorted(found)


@pytest.mark.parametrize("size", [1, 4000])
def test_a_task_holds_a_piece_of_its_lines_as_python_objects(size):
    n = 24_000_000 // (size + 500)
    texts = pa.array([f"{i} " + "x" * size for i in range(n)])
    place = [pa.array(["file:/lists/part-0"] * n), pa.array([0] * n), pa.array([n * size] * n)]
    lines = pa.RecordBatch.from_arrays([*place, texts.cast(pa.binary())], names=["path", "start", "size", "value"])
    listed = pa.RecordBatch.from_arrays([texts], names=["value"])
    found, written, edges = 0, 0, []
    tracemalloc.start()
    try:
        for rows in _segments(iter([lines])):
            assert rows.column("raw").equals(lines.column("value").slice(found, rows.num_rows))
            edges += [found + i for i, edge in enumerate(rows.column("edge").to_pylist()) if edge]
            found += rows.num_rows
        for rows in _list_lines(iter([listed])):
            written += rows.num_rows
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (found, written, edges) == (n, n + 2, [0, n - 1])
    assert most < 8 * PIECE_BYTES


def test_query_reads_lists_from_files(spark):
    name = "prompt_list_files"
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None
