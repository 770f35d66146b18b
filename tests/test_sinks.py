import glob
import json

import pytest
from pyspark.errors import AnalysisException

from recordloom.operators.measure import counted, preview, throughput, violation_summary
from recordloom.sinks.jsonl import RESULT_COLUMN, SINK_COLUMN, read_jsonl, result_rows, sink_rows, write_jsonl
from recordloom.sinks.staging import scratch_path, shared_folder, stage

TEXTS = ["plain", "zwei ä", "😀 €  ", 'quote " \\ \n', "", None]


def _generated(spark):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(TEXTS)], "prompt_id string, generated_text string")


def _lines(path):
    out = []
    for part in glob.glob(f"{path}/part-*"):
        with open(part, "rb") as f:
            out += f.read().decode("ascii").splitlines()
    return out


def test_result_rows(spark):
    assert result_rows(_generated(spark)).columns == ["prompt_id", RESULT_COLUMN]
    assert result_rows(_generated(spark), provenance=False).columns == [RESULT_COLUMN]
    assert sink_rows(_generated(spark)).collect() == [(None,)] * len(TEXTS)


def test_lines_are_ascii_and_keep_null(spark, tmp_path):
    rows, seen = counted(sink_rows(result_rows(_generated(spark))), "saved")
    write_jsonl(rows, str(tmp_path / "out"))
    assert seen.get["n"] == len(TEXTS)
    lines = [json.loads(x) for x in _lines(tmp_path / "out")]
    assert all(list(x) == [SINK_COLUMN] for x in lines)
    assert sorted((x[SINK_COLUMN] for x in lines), key=str) == sorted(TEXTS, key=str)
    back = [r[0] for r in read_jsonl(spark, str(tmp_path / "out")).collect()]
    assert sorted(back, key=str) == sorted(TEXTS, key=str)


def test_existing_path_is_an_error(spark, tmp_path):
    rows = sink_rows(result_rows(_generated(spark)))
    write_jsonl(rows, str(tmp_path / "out"), single_file=True)
    assert len(glob.glob(str(tmp_path / "out" / "part-*"))) == 1
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_jsonl(rows, str(tmp_path / "out"))


def test_failed_write_leaves_no_result(spark, tmp_path):
    rows = spark.range(10).selectExpr(f"if(id = 7, raise_error('late'), 'x') AS {SINK_COLUMN}")
    with pytest.raises(Exception, match="late"):
        write_jsonl(rows, str(tmp_path / "out"))
    assert not glob.glob(str(tmp_path / "out" / "_SUCCESS")) and not glob.glob(str(tmp_path / "out" / "part-*"))


def test_staging_uses_the_shared_folder(spark):
    folder = shared_folder(spark)
    if folder:
        assert scratch_path(spark, "x").startswith(folder.rstrip("/"))
    staged = stage(_generated(spark))
    assert sorted(r["prompt_id"] for r in staged.collect()) == [str(i) for i in range(len(TEXTS))]


def test_measures(spark):
    df = spark.sql(
        "SELECT 10 AS n_output_tokens, 500D AS generation_ms, CAST(NULL AS STRING) AS generation_error "
        "UNION ALL SELECT NULL, 500D, 'e'"
    )
    row = throughput(df, wall_seconds=2.0).first()
    assert (row["n_requests"], row["n_failed"], row["n_output_tokens"]) == (2, 1, 10)
    assert (row["tokens_per_model_second"], row["tokens_per_second"]) == (10.0, 5.0)
    assert throughput(df.limit(0)).first()["tokens_per_model_second"] is None
    rules = spark.sql("SELECT array(named_struct('path','$','rule','type'), named_struct('path','$.a','rule','type')) AS violations")
    assert [tuple(r) for r in violation_summary(rules).collect()] == [("type", 2)]
    assert len(list(preview(spark.range(100), 3))) == 3
