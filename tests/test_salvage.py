"""Cut records against a plain Python version, at every position."""

import json
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from recordloom.functions.salvage import salvaged
from recordloom.plans.queries import damage, raw

RECORDS = [
    '{"a":"x","b":true,"c":[1,2.5,-3e2,{"d":null}],"e":{"f":[],"g":{}},"h":"q\\"\\\\\\u00e4 z"}',
    ' { "ä" : [ "1" , [ [ ] , "}" ] ] , "n" : 0 , "m" : -0.5E+1 } \n',
    '{"a":{"b":{"c":{"d":"{[\\"]}"}}},"t":"\U0001f600"}',
]
WRONG = [
    "", " ", "[1]", '"a"', "x", "{", "{}", "{} x", '{"a"}', '{"a":1,}', '{"a":1]', '{"a":01}', '{"a":tru}',
    '{"a":1}}', '{"a":1,"b":"\t"}', '{"a":1,"b":"\\x"}', '{"a":12', '{"a":12 ', '{"a":1.', '{,}', '{"a":[1,]}',
    '{"a" "b"}', '{"a":"b" "c":1}', '{"a":1 2}', '{"a":-}', "{'a':1}", '{"a":1/*x*/}', '{"a":"\\',
]

NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?\Z")
STRING = re.compile(r'"(?:[^"\\\x00-\x1f]|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*"')
TOKEN = re.compile(r"[-0-9][-+.0-9eE]*|[A-Za-z]+")


def plain(text):
    """The longest part that can be closed: (text, complete, number of characters left out)."""
    if text is None:
        return None
    best, stack, wanted, at = None, [], "root", 0
    while True:
        while at < len(text) and text[at] in " \t\n\r":
            at += 1
        if at == len(text):
            break
        c = text[at]
        value = wanted in ("value", "item")
        if c == '"':
            found = STRING.match(text, at)
            if not found or wanted in ("root", "colon", "next", "none"):
                break
            at = found.end()
            if value:
                wanted, best = "next", (at, "".join(reversed(stack)))
            else:
                wanted = "colon"
            continue
        found = TOKEN.match(text, at)
        word = found.group() if found else c
        end = at + len(word)
        if word == "{" and (value or wanted == "root"):
            stack.append("}")
            wanted = "field"
        elif word == "[" and value:
            stack.append("]")
            wanted = "item"
        elif word in ("}", "]") and stack and stack[-1] == word and wanted in (
            "next", "field" if word == "}" else "item"):
            stack.pop()
            wanted = "next" if stack else "none"
        elif word == "," and wanted == "next":
            wanted, at = ("name" if stack[-1] == "}" else "value"), end
            continue
        elif word == ":" and wanted == "colon":
            wanted, at = "value", end
            continue
        elif value and (word in ("true", "false", "null") or (NUMBER.match(word) and end < len(text))):
            wanted = "next"
        else:
            break
        at, best = end, (end, "".join(reversed(stack)))
    if best is None:
        return None
    at, closers = best
    return text[:at] + closers, not closers and not text[at:].strip(" \t\n\r"), len(text) - at


def _found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", salvaged("t").alias("s")).collect()
    return {r.i: None if r.s is None else tuple(r.s) for r in rows}


@pytest.mark.parametrize("n", range(len(RECORDS)))
def test_cut_at_every_position(spark, n):
    record = RECORDS[n]
    texts = [record[:i] for i in range(len(record) + 1)]
    found = _found(spark, texts)
    for i, text in enumerate(texts):
        assert found[i] == plain(text), text
        if found[i]:
            json.loads(found[i][0])
    assert found[len(record)][1]


def test_wrong_texts(spark):
    texts = [*WRONG, None]
    found = _found(spark, texts)
    assert {t: found[i] for i, t in enumerate(texts)} == {t: plain(t) for t in texts}


def test_damaged_records(spark):
    rows = raw(spark, SMALL).select("generated_text", damage().alias("t")).select(
        "t", salvaged("t").alias("s")
    )
    for r in rows.collect():
        assert (None if r.s is None else tuple(r.s)) == plain(r.t)


def test_a_long_text_with_many_marks(spark):
    text = '{"a":["' + '\\"' * 20_000 + '",' + ",".join(f'"{i}"' for i in range(20_000)) + ',"x'
    [row] = spark.createDataFrame([(text,)], "t string").select(salvaged("t").alias("s")).collect()
    assert json.loads(row.s.text)["a"][-1] == "19999" and row.s.n_dropped == 3
    assert spark.range(1).select(F.lit(None).cast("string").alias("t")).select(
        salvaged("t").isNull().alias("n")
    ).first().n
