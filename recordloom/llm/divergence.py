"""How far the sources of one language lie apart, by their words, on a cube of tasks.

Every language keeps the V terms that occur in at least ``LEAST_DOCUMENTS`` of its documents.
A group (language, source) that has n of its N occurrences of kept terms on a term holds it with
weight p = 1 + floor(10**9 * (n + 1) / (N + V)), and so does the language as a whole.  The
divergence of a group from another one with weights q is the sum of floor((p - q)**2 / q) over
all kept terms of their language.

Counting: one pass over the texts counts terms within tasks, then by (language, source, term).
Kept terms, N, V and the weights are joins and sums over that table.

The cube: the groups of a language are dealt into blocks of about ``GROUP_BLOCK`` by hash, its
terms into blocks of about ``TERM_BLOCK``.  A task owns a cell (group block, group block, term
block): every group's slice of a term block is sent to the cells of all pairs its block belongs
to.  A cell computes, for all ordered pairs of its groups, the partial divergence over the terms
that its slices hold; the partial results are summed along the term axis.  Terms that neither
block holds have the groups' weights for n = 0, so their share is the same for each of them: the
cells add what their terms differ from that share, and the cells of term block 0 add V times the
share.  A cell holds two slices at most, whatever the size of the corpus, and a group that owns
a third of all rows is dealt over all term blocks like any other.

All arithmetic is exact: weights are divided as decimals, and a square of at most 10**18 fits a
long.

Defined results: null text, language and source count as '' and '' is a language and a source
like others; letters A-Z are folded; repeated rows are documents of their own; groups without
terms take part with n = 0; without kept terms all divergences are 0; a language of one source
has no pairs; ties go by the order of UTF-8 bytes; other columns are not read, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import discard, keep
from recordloom.shipping import ship_package

LEAST_DOCUMENTS = 3
TOP = 200
GROUP_BLOCK = 32
TERM_BLOCK = 2_048
WHOLE = 1_000_000_000
_FLUSH = 300_000

# Bytes of a term: letters and everything beyond ASCII; A-Z are folded, the rest separates.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERM_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents by (lang, source, term); a row without term for each group."""
    found: dict[tuple[str, str], tuple[Counter[bytes], Counter[bytes]]] = defaultdict(
        lambda: (Counter(), Counter())
    )

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, documents) in found.items():
            names = [None, *n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(names), pa.string()),
                    pa.array([source] * len(names), pa.string()),
                    pa.array(names, pa.binary()).view(pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *(documents[t] for t in n)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "documents"],
            )
        found.clear()

    held = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = batch.column(2).cast(pa.binary())
        for lang, source, text in zip(langs, sources, texts):
            n, documents = found[lang or "", source or ""]
            held -= len(n)
            words = Counter(terms(text.as_py()))
            n.update(words)
            documents.update(words.keys())
            held += len(n)
            if held > _FLUSH:
                yield from out()
                held = 0
    yield from out()


def weight(n: Column | str, total: Column | str, kept: Column | str) -> Column:
    """1 + floor(10**9 * (n + 1) / (total + kept)), exactly; 1 where nothing is kept."""
    return F.expr(
        f"CASE WHEN {kept} = 0 THEN 1L ELSE 1L + (cast({WHOLE} AS decimal(10,0)) * "
        f"cast({n} + 1 AS decimal(20,0))) div cast({total} + {kept} AS decimal(20,0)) END"
    )


def _share(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _cell(key: tuple, table: pa.Table) -> pa.Table:
    """Partial divergences of one cell's ordered pairs of groups."""
    lang, low, high, term_block = (k.as_py() for k in key)
    is_base = pc.is_null(table["term"])
    base, held = table.filter(is_base), table.filter(pc.invert(is_base))
    sources = base["source"].to_pylist()
    at = {s: i for i, s in enumerate(sources)}
    block = base["block"].to_numpy()
    zero = base["p"].to_numpy().astype(np.int64)
    kept = base["kept"].to_numpy()
    coded = held["term"].combine_chunks().dictionary_encode()
    width = len(coded.dictionary)
    weights = np.repeat(zero[:, None], width, axis=1)
    rows = np.array([at[s] for s in held["source"].to_pylist()], dtype=np.int64)
    weights[rows, coded.indices.to_numpy(zero_copy_only=False)] = held["p"].to_numpy()
    first, second, partial = [], [], []
    for i, source in enumerate(sources):
        others = np.flatnonzero(block != block[i]) if low != high else np.arange(len(sources))
        others = others[others != i]
        if not len(others):
            continue
        same = _share(zero[i], zero[others])
        found = _share(weights[i], weights[others]).sum(axis=1) - width * same
        if term_block == 0:
            found += kept[i] * same
        first += [source] * len(others)
        second += [sources[j] for j in others]
        partial += found.tolist()
    return pa.table(
        {
            "lang": pa.array([lang] * len(first), pa.string()),
            "source": pa.array(first, pa.string()),
            "item": pa.array(second, pa.string()),
            "partial": pa.array(partial, pa.int64()),
        }
    )


def _blocks(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("int")


def _dealt(term: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(term), blocks).cast("int")


def _ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def audit(
    df: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP,
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair``: the divergence from each other source of the language.  Part ``term``: the
    ``top`` terms that the group uses more than its language does.
    """
    ship_package(df.sparkSession)
    chosen = df.select(
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
        F.col(text_col).alias("text"),
    )
    partial = chosen.mapInArrow(
        _count, "lang string, source string, term string, n long, documents long"
    )
    counts = keep(
        partial.groupBy("lang", "source", "term").agg(
            F.sum("n").alias("n"), F.sum("documents").alias("documents")
        )
    )
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("documents").alias("documents")
    )
    kept = keep(kept.where(F.col("documents") >= least_documents).drop("documents"))
    entries = keep(counts.drop("documents").join(kept, ["lang", "term"]))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = keep(
        counts.where("term IS NULL").select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .withColumn("total", F.coalesce("total", F.lit(0)))
    )
    discard(counts)
    sizes = groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.count("*").alias("n_groups")
    )
    sizes = sizes.join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left")
    sizes = sizes.withColumn("kept", F.coalesce("kept", F.lit(0))).select(
        "lang", "lang_total", "kept", _blocks(F.col("n_groups"), group_block).alias("n_blocks"),
        _blocks(F.col("kept"), term_block).alias("n_slices"),
    )
    groups = keep(
        groups.join(sizes, "lang").withColumn(
            "block", F.pmod(F.xxhash64("source"), F.col("n_blocks")).cast("int")
        )
    )
    weighed = keep(
        entries.join(groups, ["lang", "source"]).select(
            "lang", "source", "term", "block", "n_blocks", "kept",
            _dealt(F.col("term"), F.col("n_slices")).alias("slice"),
            weight("n", "total", "kept").alias("p"),
            weight("lang_n", "lang_total", "kept").alias("q"),
        )
    )
    discard(entries)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sent = ["lang", "source", "term", "block", "kept", "p", "n_blocks", "slice"]
    base = groups.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), "block", "kept",
        weight("0", "total", "kept").alias("p"), "n_blocks", every("n_slices").alias("slice"),
    )
    cells = base.unionByName(weighed.select(*sent)).select("*", every("n_blocks").alias("other"))
    cells = cells.select(
        "lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "slice", "source", "term", "block", "kept", "p",
    )
    found = cells.groupBy("lang", "low", "high", "slice").applyInArrow(
        _cell, "lang string, source string, item string, partial long"
    )
    pairs = found.groupBy("lang", "source", "item").agg(F.sum("partial").alias("value"))
    usual = weighed.where("p > q").select(
        "lang", "source", F.col("term").alias("item"),
        F.expr("((p - q) * (p - q)) div q").alias("value"),
    )
    shown = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", "rank"]
    return _ranked(pairs).select(*shown("pair")).unionByName(
        _ranked(usual, top).select(*shown("term"))
    )


_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _weight_sql(n: str, total: str) -> str:
    return f"1 + ({WHOLE}::HUGEINT * ({n} + 1)) // ({total} + kept)"


OP11_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_FOLD}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents
), flat AS (SELECT r, lang, source, unnest(ws) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM flat GROUP BY lang, term
  HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM flat JOIN kept USING (lang, term)
  GROUP BY lang, source, term
), langs AS (
  SELECT lang, coalesce(sum(lang_n), 0) AS lang_total, count(term) AS kept
  FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang
), grps AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source)
  GROUP BY lang, source
), weights AS (
  SELECT grps.lang, source, kept.term, coalesce(counts.n, 0) AS n,
         {_weight_sql("coalesce(counts.n, 0)", "total")} AS p,
         {_weight_sql("lang_n", "lang_total")} AS lang_p
  FROM grps JOIN langs USING (lang) JOIN kept USING (lang)
  LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM weights a JOIN weights b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - lang_p) * (p - lang_p) // lang_p
  FROM weights WHERE n > 0 AND p > lang_p
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found)
WHERE part = 'pair' OR rank <= {TOP}
"""
