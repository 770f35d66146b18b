"""Shapes that the plans must keep."""

import pytest

from conftest import SMALL
from recordloom.operators import check
from recordloom.plans.queries import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts") / "t")
    QUERIES["generate_template"](spark, SMALL).select("doc_id", "generated_text").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "shape",
    [
        lambda c: c,
        lambda c: check.split_records(c)[0],
        lambda c: check.split_records(c)[1].select("doc_id"),
        lambda c: c.where("record.problem_metadata.category = 'Boot'").select("record.user_problem_post.title"),
    ],
)
def test_text_is_parsed_once_in_the_jvm(texts, shape):
    plan = _plan(shape(check.check_records(texts)))
    assert plan.count("parseJson") == 1
    assert "Exchange" not in plan and "Python" not in plan and "MapInArrow" not in plan


def test_model_step_is_not_repeated_and_only_needed_columns_are_read(spark):
    plan = _plan(QUERIES["category_difficulty"](spark, SMALL))
    assert plan.count("MapInArrow") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_counts_aggregate_before_the_exchange(spark):
    plan = _plan(QUERIES["violation_summary"](spark, SMALL))
    assert plan.count("HashAggregate") == 2 and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_joins_or_limits(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for shape in ("CartesianProduct", "NestedLoop", "Limit", "BatchEvalPython", "ArrowEvalPython"):
        assert shape not in plan
