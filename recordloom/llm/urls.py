"""URL filtering: rules first, gradient-boosted trees on lexical features for the rest.

Rules name a host (with all its subdomains) and the beginning of a path; the longest rule
that fits decides.  URLs that a rule decides are the labelled ones: from a sample of at most
about ``SAMPLE`` of them, chosen by a hash, the trees learn to judge URLs that no rule covers.
Features are length, depth, digit ratio, entropy of the characters, number of parameters,
host labels and the block rates of the host's last label and last two labels.  These rates are
counted over all labelled URLs, in ``BINS`` hash classes, so the table that is broadcast has
``2 * BINS`` rows at most.

Defined results: null or a URL without `://` has an empty host and path, is covered by no rule
and is judged by the trees like any other; without labelled URLs of both kinds the verdict
is the only kind seen, or `allow`; repeated rows are judged alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import keep, without
from recordloom.operators.once import once

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
SAMPLE = 5_000
BINS = 2_048
TREES = 10
DEPTH = 3
FEATURES = [
    "_length", "_depth", "_digits", "_entropy", "_params", "_labels", "_host_length",
    "_path_length", "_hyphens", "_secure", "_rate1", "_rate2",
]
ADDED = ["host", "path", "rule", "verdict"]
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*+", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_of(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, _, start = rule.partition("/")
        fits = (host == name) | F.endswith(host, F.lit("." + name))
        found = F.when(fits & F.startswith(path, F.lit("/" + start)), F.lit(rule)).otherwise(found)
    return found


def _count(text: Column, what: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, what, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    shares = F.transform(F.array_distinct(F.split(text, "")), share)
    bits = F.aggregate(
        F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda acc, p: acc - p * F.log2(p)
    )
    return F.when(n > 0, bits).otherwise(0.0)


def _lexical(df: DataFrame, url: Column) -> DataFrame:
    url = F.coalesce(url, F.lit(""))
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    n = F.greatest(F.length(url), F.lit(1))
    return df.select(
        "*",
        F.length(url).cast("double").alias("_length"),
        _count(path, "/").alias("_depth"),
        (_count(url, "[0-9]") / n).alias("_digits"),
        _entropy(url).alias("_entropy"),
        (_count(query, "&") + (F.length(query) > 0).cast("double")).alias("_params"),
        (_count(host, "[.]") + 1).alias("_labels"),
        F.length(host).cast("double").alias("_host_length"),
        F.length(path).cast("double").alias("_path_length"),
        _count(url, "-").alias("_hyphens"),
        F.startswith(url, F.lit("https://")).cast("double").alias("_secure"),
        *[
            (F.pmod(F.xxhash64(F.substring_index(host, ".", -k)), F.lit(BINS)) + (k - 1) * BINS)
            .cast("int").alias(f"_bin{k}")
            for k in (1, 2)
        ],
    )


def _rates(labelled: DataFrame) -> DataFrame:
    """Smoothed block rate per suffix class; at most 2 * BINS rows."""
    bins = labelled.select(F.explode(F.array("_bin1", "_bin2")).alias("bin"), "_label")
    rate = (F.sum("_label") + 1.0) / (F.count("*") + 2.0)
    return keep(bins.groupBy("bin").agg(rate.alias("rate")))


def judge(
    df: DataFrame,
    url_col: str = "url",
    id_col: str = "page_id",
    rules: dict[str, str] = RULES,
    sample: int = SAMPLE,
) -> DataFrame:
    """The rows with host, path, rule and verdict."""
    df = without(df, [*ADDED, *FEATURES, "_bin1", "_bin2", "_label", "_x", "_said", "_p", "_raw"])
    host, path = split_url(F.col(url_col))
    rows = df.select("*", host.alias("host"), path.alias("path"))
    rows = once(rows, "rule", rule_of(F.col("host"), F.col("path"), list(rules)))
    blocked = F.col("rule").isin([r for r, v in rules.items() if v == "block"])
    rows = rows.withColumn("_label", F.when(F.col("rule").isNotNull(), blocked.cast("double")))
    seen = rows.agg(F.count("_label"), F.sum("_label")).first()
    n, n_blocked = seen[0], int(seen[1] or 0)
    names = [F.col(f"`{c}`") for c in df.columns]
    by_rule = F.when(F.col("_label") == 1, "block").when(F.col("_label") == 0, "allow")
    if n_blocked in (0, n):
        only = "block" if n_blocked else "allow"
        return rows.select(
            *names, "host", "path", "rule", F.coalesce(by_rule, F.lit(only)).alias("verdict")
        )
    lexical = _lexical(rows, F.col(url_col))
    rates = F.broadcast(_rates(lexical.where("_label IS NOT NULL")))
    full = lexical
    for k in (1, 2):
        side = rates.select(F.col("bin").alias(f"_bin{k}"), F.col("rate").alias(f"_rate{k}"))
        full = full.join(F.broadcast(side), f"_bin{k}", "left")
        full = full.withColumn(f"_rate{k}", F.coalesce(f"_rate{k}", F.lit(0.5)))
    space = 1 << 30
    part = math.ceil(space * min(1.0, sample / n))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col), F.col(url_col)), F.lit(space)) < part
    learned = keep(full.where(F.col("_label").isNotNull() & drawn).select(*FEATURES, "_label"))
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="_x", handleInvalid="keep")
    trees = GBTClassifier(
        featuresCol="_x", labelCol="_label", predictionCol="_said",
        maxIter=TREES, maxDepth=DEPTH, seed=1, checkpointInterval=-1,
    )
    trees.setProbabilityCol("_p").setRawPredictionCol("_raw")
    model = trees.fit(assemble.transform(learned).select("_x", "_label"))
    said = model.transform(assemble.transform(full))
    by_trees = F.when(F.col("_said") == 1, "block").otherwise("allow")
    return said.select(
        *names, "host", "path", "rule", F.coalesce(by_rule, by_trees).alias("verdict")
    )
