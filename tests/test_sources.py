import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from recordloom.sources.prompts import (
    PromptFileError,
    check_prompt_files,
    prompts_from_table,
    read_prompt_lines,
    read_prompts,
)

GOOD = {
    "plain": ('["one", "zwei ä"]', ["one", "zwei ä"]),
    "newline": ('["a"]\n', ["a"]),
    "empty": ("[]", []),
    "blank": (" [ ]\r\n", []),
    "escapes": (r'["ä\n\"q\" ]", "", "[x]"]', ['ä\n"q" ]', "", "[x]"]),
}
BAD = {
    "number": '["one", 3]',
    "null": '["one", null]',
    "nested": '[["a"]]',
    "object": '{"a": 1}',
    "text": '"a"',
    "cut": '["a",',
    "cut_nested": '[["a"]',
    "trailing": '["a"] x',
    "two": '["a"],["b"]',
    "comma": '["a",]',
    "quotes": "['a']",
    "control": '["a\tb"]',
    "comment": '["a"/*b*/]',
    "nothing": "",
    "blanks": "  \n",
}


def _write(folder, files):
    for name, text in files.items():
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize("name", GOOD)
def test_good_list(spark, tmp_path, name):
    text, prompts = GOOD[name]
    path = _write(tmp_path, {name: text})
    assert check_prompt_files(spark, path) == (1, len(prompts))
    rows = read_prompts(spark, path).orderBy("pos").collect()
    assert [r["prompt"] for r in rows] == prompts
    assert [r["pos"] for r in rows] == list(range(len(prompts)))


def test_directory_and_stable_ids(spark, tmp_path):
    path = _write(tmp_path, {n: t for n, (t, _) in GOOD.items()})
    assert check_prompt_files(spark, path) == (len(GOOD), sum(len(p) for _, p in GOOD.values()))
    once = {r["prompt_id"]: r["prompt"] for r in read_prompts(spark, path).collect()}
    spread = {r["prompt_id"]: r["prompt"] for r in read_prompts(spark, path, 6).collect()}
    assert once == spread and len(once) == sum(len(p) for _, p in GOOD.values())
    assert read_prompts(spark, path, 6).rdd.getNumPartitions() == 6


def _named(spark, error):
    paths = [r["path"] for r in spark.read.parquet(error.table).collect()]
    assert len(paths) == error.n_files
    return sorted(p.split("/")[-1].removesuffix(".json") for p in paths)


def test_every_bad_file_is_named(spark, tmp_path):
    many = {f"bad{i}": "{}" for i in range(30)}
    path = _write(tmp_path, {**BAD, **many, "fine": '["a"]'})
    with pytest.raises(PromptFileError) as caught:
        check_prompt_files(spark, path)
    assert _named(spark, caught.value) == sorted([*BAD, *many])


def test_empty_file_is_named(spark, tmp_path):
    path = _write(tmp_path, {"nothing": "", "fine": '["a"]'})
    with pytest.raises(PromptFileError) as caught:
        check_prompt_files(spark, path)
    assert _named(spark, caught.value) == ["nothing"]


def test_ids_tell_nulls_and_separators_apart(spark):
    rows = [("x", None), (None, "x"), ("a\x1fb", None), ("a", "b"), ('a","b', None), (None, None)]
    table = spark.createDataFrame([(*r, "t") for r in rows], "a string, b string, t string")
    ids = prompts_from_table(table, "t", ["a", "b"])
    assert ids.select("prompt_id").distinct().count() == len(rows)


def test_invalid_utf8_is_rejected(spark, tmp_path):
    (tmp_path / "f.json").write_bytes(b'["\xff\xfe"]')
    with pytest.raises(PromptFileError):
        check_prompt_files(spark, str(tmp_path))


@pytest.mark.parametrize("name", ["number", "trailing"])
def test_reading_a_bad_file_fails(spark, tmp_path, name):
    path = _write(tmp_path, {name: BAD[name]})
    with pytest.raises(Exception, match="is not a JSON list of strings"):
        read_prompts(spark, path).count()


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        check_prompt_files(spark, str(tmp_path / "none"))


def test_large_list_beyond_one_variant(spark, tmp_path):
    # 20 MB, above the size at which a single VARIANT value used to end.
    text = "[" + ",".join(f'"{i:07d}{"x" * 1000}"' for i in range(20_000)) + "]"
    path = _write(tmp_path, {"large": text})
    prompts = read_prompts(spark, path)
    assert prompts.agg(F.count_distinct("prompt_id")).first()[0] == 20_000


def test_table_of_prompts(spark):
    table = spark.createDataFrame([(1, "a"), (2, "a")], "k bigint, t string")
    rows = prompts_from_table(table, "t", ["k"]).collect()
    assert [(r["k"], r["prompt"]) for r in rows] == [(1, "a"), (2, "a")]
    assert rows[0]["prompt_id"] != rows[1]["prompt_id"]
    with pytest.raises(TypeError):
        prompts_from_table(table, "k")
    with pytest.raises(Exception, match="holds NULL"):
        prompts_from_table(spark.createDataFrame([(None,)], "t string"), "t").collect()
    with pytest.raises(Exception, match="holds NULL"):
        prompts_from_table(spark.createDataFrame([(1, None)], "k int, t string"), "t", ["k"]).count()


def test_prompt_lines(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text('{"prompt": "a"}\n{"prompt": "3"}\n')
    assert sorted(r["prompt"] for r in read_prompt_lines(spark, str(tmp_path)).collect()) == ["3", "a"]


@pytest.mark.parametrize(
    "line",
    [
        '{"prompt": 3}', '{"prompt": null}', '{"other": "a"}', '{"prompt":"a"} junk', "x", '"a"',
        '[{"prompt":"b"},{"prompt":"c"}]', '{"prompt":"d","prompt":"e"}', '{"prompt":"a"',
    ],
)
def test_bad_prompt_lines(spark, tmp_path, line):
    (tmp_path / "bad.jsonl").write_text('{"prompt": "a"}\n\n' + line + "\n")
    with pytest.raises(Exception, match="holds NULL"):
        read_prompt_lines(spark, str(tmp_path)).count()
