"""Exact deduplication with two-pass Bloom filtering, in DataFrame operations alone.

Pass one reads every text once, stages (id, digest) and builds a blocked Bloom filter of
the digests that occur more than once: a digest sets three bits in one 64-bit word; a
(word, bits) pair that is counted twice goes into the filter.  Pass two looks every row up
in the filter.  A row that the filter does not hold has no equal and passes straight
through; only the others shuffle, by their full digest, so false positives cost time and
never change the result.

The filter has one word per eight rows, at most ``MAX_WORDS``, and only non-empty words are
broadcast: 16 bytes each, so 256 MB at the very most.  Beyond 130 million rows the filter
fills up and more rows shuffle; the result stays the same.

Defined results: null text counts as empty; of equal texts the smallest id stays, null ids
come last; of repeated rows (same id, same text) one stays; an empty table gives an empty
result; further columns pass through, except that columns with the names this operator
adds are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import SPACE, keep, without

ROWS_PER_WORD = 8
MAX_WORDS = 1 << 24
# Parts that the rows of one digest are dealt to.
SALTS = 256


def digest(text: Column) -> Column:
    """SHA-256 of the text with every run of white space replaced by one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ").cast("binary"), 256)


def _word(sha: Column, n_words: int) -> Column:
    return F.xxhash64(sha).bitwiseAND(F.lit(n_words - 1))


def _bits(sha: Column) -> Column:
    """Three of 64 bits, from other parts of the hash than the word."""
    one, h = F.lit(1).cast("long"), F.xxhash64(sha)
    places = [F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int") for at in (26, 38, 50)]
    shifted = [F.call_function("shiftleft", one, p) for p in places]
    return shifted[0].bitwiseOR(shifted[1]).bitwiseOR(shifted[2])


class ExactDedup:
    """The two passes over one table."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.df, self.id_col, self.text_col = df, id_col, text_col
        self.hashes = keep(
            df.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("sha"))
        )
        rows = self.hashes.count()
        self.n_words = 1 << 10
        while self.n_words < min(rows // ROWS_PER_WORD, MAX_WORDS):
            self.n_words *= 2
        self.filter = keep(self._repeated())
        self._decisions = keep(self._decide())

    def _repeated(self) -> DataFrame:
        sha = F.col("sha")
        seen = self.hashes.select(
            _word(sha, self.n_words).alias("word"), _bits(sha).alias("bits")
        )
        twice = seen.groupBy("word", "bits").count().where("count > 1")
        return twice.groupBy(F.col("word").alias("_f_word")).agg(F.bit_or("bits").alias("_f_held"))

    def _flag(self, df: DataFrame, sha: Column) -> DataFrame:
        """Adds ``_f_maybe``: whether the filter holds the digest."""
        probe = df.withColumn("_f_at", _word(sha, self.n_words))
        found = probe.join(F.broadcast(self.filter), F.col("_f_at") == F.col("_f_word"), "left")
        bits = _bits(sha)
        maybe = F.coalesce(F.col("_f_held").bitwiseAND(bits) == bits, F.lit(False))
        return found.withColumn("_f_maybe", maybe).drop("_f_at", "_f_word", "_f_held")

    def _decide(self) -> DataFrame:
        """Id, digest, row count, smallest id and group size of rows that may have an equal."""
        rows = (
            self._flag(self.hashes, F.col("sha"))
            .where("_f_maybe")
            .groupBy("sha", "id")
            .agg(F.count("*").alias("m"))
            .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        )
        parts = rows.groupBy("sha", "salt").agg(F.min("id").alias("id"), F.sum("m").alias("m"))
        groups = parts.groupBy("sha").agg(
            F.min("id").alias("keep_id"),
            F.sum("m").alias("group_size"),
            F.collect_list("salt").alias("salts"),
        )
        per_part = groups.select("sha", "keep_id", "group_size", F.explode("salts").alias("salt"))
        return rows.join(per_part, ["sha", "salt"]).drop("salt")

    def decisions(self) -> DataFrame:
        """One row per row of the table: id, keep_id, group_size, kept, text_sha256."""
        plain = self._flag(self.hashes, F.col("sha")).where("NOT _f_maybe")
        plain = plain.select(
            "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
        )
        several = self._decisions.withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
        several = several.select(
            "id", "keep_id", "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
        return plain.unionByName(several).withColumnRenamed("id", self.id_col)

    def survivors(self) -> DataFrame:
        """The rows that stay, with all their columns."""
        df = without(self.df, ["_sha", "_keep_sha", "_keep_id", "_f_at", "_f_word", "_f_held", "_f_maybe"])
        rows = self._flag(
            df.withColumn("_sha", digest(F.col(self.text_col))), F.col("_sha")
        )
        kept = self._decisions.where("id <=> keep_id")
        kept = kept.select(F.col("sha").alias("_keep_sha"), F.col("id").alias("_keep_id"))
        own = F.col(self.id_col).eqNullSafe(F.col("_keep_id"))
        several = (
            rows.where("_f_maybe")
            .join(kept, (F.col("_sha") == F.col("_keep_sha")) & own, "left_semi")
            .dropDuplicates(["_sha"])
        )
        return rows.where("NOT _f_maybe").unionByName(several).select(
            *[F.col(f"`{c}`") for c in df.columns]
        )


OP6_SQL = r"""
WITH h AS (
  SELECT doc_id,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) AS n
  FROM h
)
SELECT doc_id, keep_id, group_size, n = 1 AS kept, text_sha256 FROM g
"""
