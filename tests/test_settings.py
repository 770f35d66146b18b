import pytest

from recordloom.functions.json_text import is_bad_int, tolerant_int
from recordloom.settings import RunConfig, SettingError, from_env


def test_defaults():
    config = from_env({})
    assert config == RunConfig()
    assert (config.batch_size, config.max_new_tokens, config.temperature) == (16, 512, 0.5)
    assert (config.top_p, config.top_k, config.max_model_len) == (1.0, -1, None)


def test_typed_values():
    config = from_env(
        {"TEMPERATURE": "0.7", "TOP_P": ".9", "TOP_K": "5", "RAY_DATA_BATCH_SIZE": "8",
         "PIPELINE_PARALLEL_SIZE_ENV": "2", "MAX_MODEL_LEN_ENV": "2048", "SLURM_JOB_ID": "17"}
    )
    assert (config.temperature, config.top_p, config.top_k) == (0.7, 0.9, 5)
    assert (config.batch_size, config.replicas, config.max_model_len) == (8, 2, 2048)
    assert config.job_id == "17"
    assert config.backend_options()["max_model_len"] == 2048
    assert "max_model_len" not in RunConfig().backend_options()


@pytest.mark.parametrize("name,text", [("TOP_K", "1.5"), ("TEMPERATURE", "warm"), ("MAX_NEW_TOKENS", "")])
def test_bad_text_names_the_setting(name, text):
    with pytest.raises(SettingError, match=name):
        from_env({name: text})


@pytest.mark.parametrize("text", ["abc", "1.5"])
def test_tolerant_length_warns(text):
    with pytest.warns(UserWarning, match="MAX_MODEL_LEN_ENV"):
        config = from_env({"MAX_MODEL_LEN_ENV": text})
    assert config.max_model_len is None and config.setting_warnings


@pytest.mark.parametrize("text", ["", "0"])
def test_unset_length_is_silent(text, recwarn):
    assert from_env({"MAX_MODEL_LEN_ENV": text}).max_model_len is None
    assert not recwarn.list


def test_tolerant_column(spark):
    from pyspark.sql import functions as F

    rows = [("abc",), ("2048",), (" 7 ",), ("1.5",), ("",), ("0",), (None,)]
    got = spark.createDataFrame(rows, "x string").select(
        tolerant_int(F.col("x")).alias("n"), is_bad_int(F.col("x")).alias("bad")
    ).collect()
    assert [tuple(r) for r in got] == [
        (None, True), (2048, False), (7, False), (None, True), (None, False), (None, False), (None, False),
    ]
