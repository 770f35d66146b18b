"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations.

Every source has a target of words.  All its documents get the same expected number of
copies, target / size; the whole part is certain and the fractional part is rounded by
pairs: two open documents move word mass between them, at random and without changing their
sum or either expectation, until one of them has a whole number of copies.  The other
one stays open and meets the next.  So a source's mix misses its target by half the
size of one document at most, whatever the number of documents.

The pairing is a reduction tree: rounding runs inside groups of about ``FAN`` open
documents, each group hands one open document on, and these form the groups of the next
level, until one per source is left and is rounded to the nearer side.  Long documents come
first in a group, so that the one left open tends to be short.  Groups are small by construction,
also in a source that holds most rows.  Each level is staged.  All random numbers are
hashes of ids, so reruns agree.

Targets: water filling.  Sources in code point order (null last) weigh 1, 2, 3, repeating;
a source whose share is above ``CEILING`` times its size stops there and its excess goes to
the others by weight.  One row per source takes part in that step.

Defined results: null text has size 0; documents of size 0 take 0 words; an empty table
gives an empty result; repeated rows are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import keep, without, word_count

WEIGHTS = 3
CEILING = 3
FAN = 64
PART = 4_096
# Sources up to this number are broadcast (one row of about 60 bytes each, so 6 MB).
BROADCAST_SOURCES = 100_000
_EXACT = 1e-9


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: source_size, target, copies expected per document, number of documents."""
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum((F.col("size") > 0).cast("long")).alias("n_open"),
    )
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = (F.row_number().over(order) - 1) % WEIGHTS + 1
    per = per.select("*", weight.cast("double").alias("weight"))
    # In the order in which sources reach their ceiling; `level` is the words per weight that
    # would be left if all before were at theirs: it rises up to the first source that it does
    # not fill and falls from there, so the largest is the level at which all words are dealt.
    per = per.withColumn("ceiling", F.col("source_size") * CEILING)
    fills = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    rest = fills.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (
        F.sum("source_size").over(whole) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    ) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    per = per.withColumn("level", F.max("level").over(whole))
    target = F.least(F.col("ceiling").cast("double"), F.col("level") * F.col("weight"))
    per = per.withColumn("target", F.coalesce(target, F.col("ceiling").cast("double")))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    return per.select(
        "source", "source_size", "target", "n_open", F.coalesce(share, F.lit(0.0)).alias("share")
    )


# One step of the fold: `acc.open` meets `x`.  `give` is what x can hand to open, `take` the
# other way round; with probability take / (give + take) x gives.
_STEP = f"""
transform(array(named_struct(
    'o', acc.open, 'x', x,
    'give', least(acc.open.size * (1 - acc.open.p), x.size * x.p),
    'take', least(acc.open.size * acc.open.p, x.size * (1 - x.p)))), s ->
transform(array(named_struct(
    'o', s.o, 'x', s.x,
    'd', CASE WHEN shiftrightunsigned(xxhash64(s.o.h, s.x.h, {{level}}), 11)
                   / 9007199254740992D * (s.give + s.take) < s.take
              THEN s.give ELSE -s.take END)), t ->
transform(array(named_struct(
    'o', t.o, 'x', t.x,
    'po', t.o.p + t.d / t.o.size, 'px', t.x.p - t.d / t.x.size)), r ->
    CASE WHEN r.po < {_EXACT} OR r.po > 1 - {_EXACT}
    THEN named_struct(
        'open', named_struct('first', r.x.first, 'h', r.x.h, 'id', r.x.id, 'key', r.x.key, 'size', r.x.size,
                             'p', r.px),
        'done', array(named_struct('id', r.o.id, 'key', r.o.key, 'size', r.o.size,
                                   'up', r.po > 0.5)))
    ELSE named_struct(
        'open', named_struct('first', r.o.first, 'h', r.o.h, 'id', r.o.id, 'key', r.o.key, 'size', r.o.size,
                             'p', r.po),
        'done', array(named_struct('id', r.x.id, 'key', r.x.key, 'size', r.x.size,
                                   'up', r.px > 0.5)))
    END)[0])[0])[0]
"""


def _fold(level: int) -> str:
    """The group's documents one after the other; the decided ones are gathered in `done`."""
    step = _STEP.format(level=level)
    return f"""
    aggregate(slice(open, 2, size(open) - 1),
        named_struct('open', open[0],
                     'done', cast(array() AS array<struct<id: bigint, key: bigint,
                                                          size: bigint, up: boolean>>)),
        (acc, x) -> transform(array({step}),
            n -> named_struct('open', n.open, 'done', concat(acc.done, n.done)))[0])
    """


def _numbered(sizes: DataFrame) -> DataFrame:
    """The rows with ``copy``, a number that tells rows apart that are equal in all else.

    Equal rows are counted and the counts are dealt out again in parts of ``PART``, so that a
    row that occurs very often is neither sorted nor written out by one task.
    """
    same = ["id", "key", "source", "size"]
    counted = keep(sizes.groupBy(*same).agg(F.count("*").alias("times")))
    once = counted.where("times = 1").select(*same, F.lit(0).cast("long").alias("copy"))
    parts = F.explode(F.expr(f"sequence(0L, (times - 1) div {PART})")).alias("part")
    many = counted.where("times > 1").select(*same, "times", parts)
    many = many.repartition("id", "key", "part").select(
        *same, F.explode(F.expr(f"sequence(part * {PART}, least(times, (part + 1) * {PART}) - 1)")).alias("copy")
    )
    return once.unionByName(many)


def round_copies(
    sizes: DataFrame, id_col: str = "doc_id", fan: int = FAN
) -> DataFrame:
    """Adds to id, key, source, size: source_size, target, copies (0 to the ceiling).

    ``key`` is a hash of id, text and source, which tells rows with the same id apart.
    """
    sizes = keep(_numbered(sizes.select(F.col(id_col).alias("id"), "key", "source", "size")))
    per = keep(targets(sizes))
    n_sources, most = per.agg(F.count("*"), F.max("n_open")).first()
    side = F.broadcast(per) if n_sources <= BROADCAST_SOURCES else per
    rows = sizes.alias("d").join(side.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    whole = F.floor(F.col("share") + F.lit(_EXACT))
    rows = rows.select(
        "id", "key", "copy", "d.source", "size", "source_size", "target", "n_open",
        whole.cast("long").alias("whole"),
        F.greatest(F.lit(0.0), F.col("share") - whole).alias("p"),
    )
    carried = ["source", "source_size", "target", "whole", "n_open"]
    settled = (F.col("size") == 0) | (F.col("p") < _EXACT)
    done = [
        rows.where(settled).select(
            "id", "key", "size", F.lit(False).alias("up"), *carried
        )
    ]
    h = F.xxhash64("id", "key", "copy")
    groups = F.ceil(F.col("n_open") / F.lit(float(fan)))
    level_rows = rows.where(~settled).select(
        *carried, F.pmod(h, groups).alias("slot"),
        F.struct(
            (-F.col("size")).alias("first"), F.xxhash64(h, F.lit(1)).alias("h"),
            "id", "key", "size", "p",
        ).alias("doc"),
    )
    n, level = most or 0, 0
    while n:
        n = -(-n // fan) if n > 1 else 0
        level += 1
        folded = keep(
            level_rows.groupBy(*carried, "slot")
            .agg(F.sort_array(F.collect_list("doc")).alias("open"))
            .withColumn("out", F.expr(_fold(level)))
            .select(*carried, "slot", "out.open", "out.done")
        )
        done.append(
            folded.select(F.explode("done").alias("d"), *carried).select("d.*", *carried)
        )
        if n == 1:
            n = 0
        if not n:
            last = F.col("open.p") >= 0.5
            done.append(
                folded.select(
                    "open.id", "open.key", "open.size", last.alias("up"), *carried
                )
            )
        level_rows = folded.select(
            *carried, F.floor(F.col("slot") / fan).alias("slot"), F.col("open").alias("doc")
        )
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(
        F.col("id").alias(id_col), "key", "source", "size", "source_size", "target",
        (F.col("whole") + F.col("up").cast("long")).alias("copies"),
    )


def row_key(id_col: str, text_col: str, source_col: str) -> Column:
    # A hash passes over nulls; the mark keeps a null text and a null source apart.
    return F.xxhash64(id_col, text_col, F.col(text_col).isNull(), source_col)


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The plan of the mix, one row per row of the table."""
    sizes = df.select(
        F.col(id_col), row_key(id_col, text_col, source_col).alias("key"),
        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
    )
    return round_copies(sizes, id_col)


def mixed_rows(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The mix itself: every row as many times as the plan says."""
    plan = mix(df, id_col, text_col, source_col)
    # Repeated rows share a key: their copies are added up and one of the rows stands for all.
    plan = plan.groupBy(
        F.coalesce(F.col(id_col), F.lit(0)).alias("_plan_id"), F.col("key").alias("_key")
    ).agg(F.sum("copies").alias("_copies"))
    rows = without(df, ["_plan_id", "_key", "_copies"]).select(
        "*",
        F.coalesce(F.col(id_col), F.lit(0)).alias("_plan_id"),
        row_key(id_col, text_col, source_col).alias("_key"),
    )
    joined = rows.dropDuplicates(["_plan_id", "_key"]).join(
        plan.where("_copies > 0"), ["_plan_id", "_key"]
    )
    names = [F.col(f"`{c}`") for c in df.columns]
    return joined.select(*names, F.explode(F.expr("sequence(1L, _copies)"))).select(*names)
