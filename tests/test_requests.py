import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from recordloom.functions.chat import DEFAULT_SYSTEM_TEXT, chat_messages, sampling_params
from recordloom.functions.json_text import json_safe
from recordloom.operators.generate import build_requests
from recordloom.schema import json_schema_text, schema_id


def test_messages(spark):
    df = spark.createDataFrame([("hi",)], "p string")
    own, given = df.select(chat_messages(F.col("p")), chat_messages(F.col("p"), "be brief")).first()
    assert [(m["role"], m["content"]) for m in own] == [("system", DEFAULT_SYSTEM_TEXT), ("user", "hi")]
    assert given[0]["content"] == "be brief"


def test_greedy_rule(spark):
    df = spark.createDataFrame([(0.0,), (0.7,), (None,)], "t double")
    got = df.select(sampling_params(F.col("t"), 100, 0.9, 5).alias("s")).select("s.*").collect()
    assert [(r["top_p"], r["top_k"]) for r in got] == [(1.0, -1), (0.9, 5), (0.9, 5)]
    assert all(r["max_tokens"] == 100 and r["detokenize"] is False for r in got)


def test_schema_stays_off_the_rows_unless_asked(spark):
    df = spark.createDataFrame([("x",)], "prompt string")
    text = json_schema_text()
    light = build_requests(df, schema_text=text).first()
    assert light["schema_id"] == schema_id(text)
    assert light["sampling_params"]["guided_decoding"]["json"] is None
    heavy = build_requests(df, schema_text=text, inline_schema=True).first()
    assert heavy["sampling_params"]["guided_decoding"]["json"] == text
    assert build_requests(df).first()["schema_id"] is None


def test_json_safe(spark):
    row = (1, [1.5], {2: Decimal("3.10")}, datetime(2024, 1, 2, 3, 4, 5), None, (Decimal("1"), "ä"))
    df = spark.createDataFrame(
        [row],
        "a int, b array<double>, c map<int,decimal(5,2)>, d timestamp_ntz, e string, "
        "f struct<x:decimal(3,0),y:string>",
    )
    got = json.loads(df.select(json_safe(df)).first()[0])
    assert got == {
        "a": 1, "b": [1.5], "c": {"2": "3.10"}, "d": "2024-01-02 03:04:05", "e": None,
        "f": {"x": "1", "y": "ä"},
    }
