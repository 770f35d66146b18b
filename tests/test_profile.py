import bisect
import collections
import random

from conftest import SMALL
from pyspark.sql import functions as F

from recordloom.operators import profile
from recordloom.plans import queries


def times(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "generation_ms double")


def test_merged_quantiles_are_within_their_error(spark):
    draw = random.Random(1)
    runs = [[draw.lognormvariate(4, 1.5) for _ in range(n)] for n in (20_000, 500, 60_000)]
    profiles = None
    for i, run in enumerate(runs):
        one = profile.latency_profile(times(spark, run), f"run{i}")
        profiles = one if profiles is None else profiles.unionByName(one)
    ranks = tuple(i / 50 for i in range(51))
    found = profile.latency_quantiles(profile.merged_latencies(profiles), ranks).collect()
    every = sorted(v for run in runs for v in run)
    assert found[0].n_requests == found[0].n_timed == len(every)
    assert found[0].latency_ms == every[0] and found[-1].latency_ms == every[-1]
    for row in found:
        at = bisect.bisect(every, row.latency_ms) / len(every)
        assert abs(at - row.rank) <= 2 * profile.QUANTILE_ERROR


def test_profile_of_odd_runs(spark):
    silent = profile.latency_profile(times(spark, [None, None]), "silent")
    mixed = profile.latency_profile(times(spark, [None, 5.0]), "mixed")
    both = silent.unionByName(mixed)
    rows = {(r.run, r.rank): r for r in profile.latency_quantiles(both, (0.5,)).collect()}
    assert rows["silent", 0.5].latency_ms is None and rows["silent", 0.5].n_requests == 2
    assert rows["mixed", 0.5].latency_ms == 5.0 and rows["mixed", 0.5].n_timed == 1
    merged = profile.latency_quantiles(profile.merged_latencies(both), (0.0, 1.0)).collect()
    assert [r.latency_ms for r in merged] == [5.0, 5.0]
    assert profile.latency_profile(times(spark, []), "none").count() == 0


def items(spark, values, run):
    table = spark.createDataFrame([("$.a", "enum", v) for v in values], "path string, rule string, value string")
    return profile.item_profile(table, run, 64)


def test_frequent_values_beyond_the_sketch(spark):
    """More different values than are tracked: the frequent ones are found, counts off by the bound."""
    draw = random.Random(2)
    runs = [["hot"] * 3_000 + ["warm"] * 1_500 + [f"v{draw.randrange(2_000)}" for _ in range(2_500)] for _ in "ab"]
    profiles = items(spark, runs[0], "a").unionByName(items(spark, runs[1], "b"))
    found = {r.value: r for r in profile.frequent_values(profile.merged_items(profiles, 64), 2).collect()}
    exact = collections.Counter(runs[0] + runs[1])
    assert set(found) == {"hot", "warm"}
    bound = 3.5 / 64 * sum(exact.values())
    assert all(abs(r.n_value - exact[v]) <= bound and r.n == sum(exact.values()) for v, r in found.items())


def test_long_values_stay_apart(spark):
    """Record texts of a query, with titles that are no strings: long ones stand as digests."""
    texts = queries.raw(spark, SMALL).limit(8)
    for length, shown in ((50, "["), (6_000, "sha256:")):
        title = F.concat(F.lit('"title":["' + "é" * length), F.col("doc_id") % 2, F.lit('"],"was":'))
        broken = texts.select(F.replace("generated_text", F.lit('"title":'), title).alias("generated_text"))
        found = profile.offending_values(broken).collect()
        assert len(found) == 8 and {r.path for r in found} == {"$.user_problem_post.title"}
        assert len({r.value for r in found}) == 2
        assert all(r.value.startswith(shown) and len(r.value) < 100 for r in found)


def test_texts_without_values(spark):
    texts = spark.createDataFrame([(None,), ("",), ("{",), ("{}",)], "generated_text string")
    assert profile.offending_values(texts).count() == 0
    assert profile.item_profile(profile.offending_values(texts), "none").count() == 0
