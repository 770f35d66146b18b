r"""Personal data: validated patterns as seeds, and bootstrapped contexts that find more.

Seeds are e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers.  The text
just before and after a seed gives lexical patterns of one to ``CONTEXT`` words of any length,
with up to six other characters beside and between them, such as ``contact `` on the left or
`` or call`` on the right.  The same is taken for every
identifier-like word, at least ``LEAST`` letters, digits, ``_`` and ``-`` with two digits or more, outside the seeds.
Patterns and instances form a graph whose edges count occurrences.  Scores go round it
``ROUNDS`` times: seeds score 1 and stay so, a pattern in which at least ``SUPPORT`` different
seeds stand scores the mean of its occurrences' instances, and an instance that is no seed
scores the mean of its occurrences' patterns.  Patterns with fewer seeds say nothing, as sides
without a word do; an instance without any other pattern has no score.  Instances that end
at ``THRESHOLD`` or above are found, wherever they occur, as spans of kind ``id``.

Everything is DataFrame functions.  Texts are read once; what is staged afterwards are
spans and contexts.  Expressions are possessive, so that time is linear in the text: a run
of name characters, digits or labels is walked over once.

Defined results: null text counts as empty and has no spans; found spans never overlap seeds;
offsets count code points, the end is exclusive; repeated rows get a result each; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import keep
from recordloom.operators.once import once

LEAST = 6
ROUNDS = 3
SUPPORT = 3
THRESHOLD = 0.8
CONTEXT = 3
KINDS = ("email", "ip", "card", "phone")
FOUND = "id"

_LOCAL = r"A-Za-z0-9._%+-"
# Matching starts at the beginning of a run or where the previous match ended: from the
# middle of a run nothing can match that does not match from there.
PATTERNS = {
    "email": (
        rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must contain to be searched at all.
_NEEDS = {"email": "%@%", "ip": "%.%.%.%", "card": "%", "phone": "%+%"}
_IDENTIFIER = (
    r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9][A-Za-z_-]*+[0-9])"
    rf"[A-Za-z0-9_-]{{{LEAST},}}+"
)
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})?"
_BLOCK = 256
# The nearest words of a gap between spans, up to CONTEXT on a side, with what lies between.
_LETTERS, _BETWEEN, _BESIDE = r"\p{L}++", r"[^\p{L}]{1,6}+", r"[^\p{L}]{0,6}+"
_TAIL = rf"((?:(?<!\p{{L}}){_LETTERS}{_BETWEEN}){{0,{CONTEXT - 1}}}(?<!\p{{L}}){_LETTERS}{_BESIDE})$"
_HEAD = rf"^({_BESIDE}{_LETTERS}(?:{_BETWEEN}{_LETTERS}){{0,{CONTEXT - 1}}})"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def _spans(text: str, pattern: str, needs: str) -> str:
    """SQL for all matches, from the matches and the gaps between: start, end, text, and what
    stands next to it in the gaps before and after.

    Starts are running sums, formed over blocks so that many matches stay affordable.
    """
    return f"""
    CASE WHEN {text} LIKE '{needs}' AND {text} RLIKE '[0-9@]' THEN
    transform(array(named_struct('m', regexp_extract_all({text}, {_quoted(pattern)}, 0),
                                 'g', split({text}, {_quoted(pattern)}, -1))), w ->
    transform(array(named_struct('m', w.m, 'g', w.g, 'l', transform(w.m, (x, i) ->
        cast(length(x) + length(w.g[i]) AS bigint)))), w ->
    transform(array(named_struct('m', w.m, 'g', w.g, 'l', w.l, 'b',
        CASE WHEN size(w.l) < {_BLOCK} THEN cast(array() AS array<bigint>) ELSE
        transform(sequence(0, size(w.l) div {_BLOCK} - 1), j ->
            aggregate(slice(w.l, j * {_BLOCK} + 1, {_BLOCK}), 0L, (a, y) -> a + y)) END)), w ->
    transform(w.m, (x, i) -> transform(array(
        aggregate(slice(w.b, 1, i div {_BLOCK}), 0L, (a, y) -> a + y)
        + aggregate(slice(w.l, (i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK}), 0L, (a, y) -> a + y)
        + length(w.g[i])), s -> named_struct('s', s, 'e', s + length(x), 't', x,
            'p', regexp_extract(w.g[i], {_quoted(_TAIL)}, 1),
            'n', regexp_extract(w.g[i + 1], {_quoted(_HEAD)}, 1)))[0]))[0])[0])[0]
    ELSE cast(array() AS array<struct<s: bigint, e: bigint, t: string, p: string, n: string>>) END
    """


def _digits(t: str) -> str:
    return f"regexp_replace({t}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """Whether the check digit of a string of digits is right."""
    value = f"cast(substring({digits}, -p, 1) AS int)"
    doubled = f"(CASE WHEN {value} > 4 THEN {value} * 2 - 9 ELSE {value} * 2 END)"
    term = f"CASE WHEN p % 2 = 0 THEN {doubled} ELSE {value} END"
    return f"aggregate(sequence(1, length({digits})), 0, (a, p) -> a + {term}) % 10 = 0"


_VALID = {
    "email": "true",
    "ip": rf"v.t RLIKE r'^{_BYTE}(?:\.{_BYTE}){{3}}$'",
    "card": f"length({_digits('v.t')}) BETWEEN 13 AND 19 AND {_luhn(_digits('v.t'))}",
    "phone": f"length({_digits('v.t')}) BETWEEN 9 AND 15",
}


def _occurrence(span: Column) -> Column:
    """A span with its patterns: on each side the nearest words and what lies between."""
    patterns = []
    for n in range(CONTEXT):
        left = F.regexp_extract(
            span["p"], rf"((?:(?<!\p{{L}}){_LETTERS}{_BETWEEN}){{{n}}}(?<!\p{{L}}){_LETTERS}{_BESIDE})$", 1
        )
        right = F.regexp_extract(span["n"], rf"^({_BESIDE}{_LETTERS}(?:{_BETWEEN}{_LETTERS}){{{n}}})", 1)
        patterns.append(F.concat(F.lit("< "), F.lower(left)))
        patterns.append(F.concat(F.lit("> "), F.lower(right)))
    return F.struct(
        span["s"].alias("s"), span["e"].alias("e"), span["t"].alias("t"),
        F.array(*patterns).alias("patterns"),
    )


def extract(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, a row number, validated spans per kind and identifier-like words with contexts."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    for kind in KINDS:
        found = F.expr(
            f"filter({_spans('text', PATTERNS[kind], _NEEDS[kind])}, v -> {_VALID[kind]})"
        )
        rows = once(rows, kind, found)
    rows = once(rows, "words", F.expr(_spans("text", _IDENTIFIER, "%")))
    seeds = F.concat(*KINDS)
    outside = F.filter(
        "words", lambda w: ~F.exists(seeds, lambda b: (w["s"] < b["e"]) & (b["s"] < w["e"]))
    )
    return keep(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "id",
            *[F.transform(k, lambda v: v.dropFields("t", "p", "n")).alias(k) for k in KINDS],
            F.transform(seeds, _occurrence).alias("seeds"),
            F.transform(outside, _occurrence).alias("words"),
        )
    )


def _edges(rows: DataFrame, column: str, seed: bool) -> DataFrame:
    met = rows.select(F.explode(column).alias("o"))
    met = met.select(F.col("o.t").alias("instance"), F.explode("o.patterns").alias("pattern"))
    # An empty side, at the edge of a text or next to no word, says nothing.
    met = met.where(F.length("pattern") > 2)
    return met.groupBy("pattern", "instance").agg(F.count("*").alias("n")).select(
        "*", F.lit(seed).alias("seed")
    )


def confident(rows: DataFrame) -> DataFrame:
    """Instances outside the seeds that end with a high score."""
    edges = keep(_edges(rows, "seeds", True).union(_edges(rows, "words", False)))
    score = None
    for _ in range(ROUNDS):
        own = F.when(F.col("seed"), 1.0)
        if score is None:
            rated = edges.withColumn("score", F.coalesce(own, F.lit(0.0)))
        else:
            rated = edges.join(score, "instance", "left").withColumn(
                "score", F.coalesce(own, F.col("score"), F.lit(0.0))
            )
        # An edge is one pattern and one instance, so counting seeds counts different ones.
        patterns = keep(
            rated.groupBy("pattern").agg(
                (F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("mean"),
                F.count_if("seed").alias("support"),
            )
        )
        trusted = patterns.where(F.col("support") >= SUPPORT).select("pattern", "mean")
        score = keep(
            edges.where("NOT seed").join(trusted, "pattern")
            .groupBy("instance")
            .agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("score"))
        )
    return score.where(F.col("score") >= THRESHOLD).select("instance")


def _named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda v: F.concat_ws(":", F.lit(kind), v["s"], v["e"]))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, counts per kind, digest of the base spans and all spans, one row per row."""
    rows = extract(df, id_col, text_col)
    words = rows.select("row", F.explode("words").alias("w"))
    words = words.select("row", F.col("w.s").alias("s"), F.col("w.e").alias("e"),
                         F.col("w.t").alias("instance"))
    more = words.join(confident(rows), "instance", "left_semi")
    more = more.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("more"))
    base = F.concat(*[_named(k, F.col(k)) for k in KINDS])
    spans = F.concat(base, F.coalesce(_named(FOUND, F.col("more")), F.array().cast("array<string>")))
    return rows.join(more, "row", "left").select(
        F.col("id").alias(id_col),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(spans, ",").alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_id"),
    )
