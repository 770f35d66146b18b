"""Language-model scoring by cross-entropy difference.

Two bigram models of the same form share one vocabulary, every word of the corpus, and a mark
for the start of a text.  The target model is counted on the target documents, the background
model on all documents.  Both mix the bigram estimate with an add-one unigram estimate over the
vocabulary; after a word that a model has not seen the unigram counts alone.  A document's score
is its mean loss per word under the target minus that under the background model (natural
logarithms); lower means closer to the target.

Counts cover every word of every document and grow with the corpus; none come to the driver.
Texts are dealt into chunks of ``CHUNK`` words (longer texts over several) and encoded by a
list of the chunk's words, one staged row per chunk.  A chunk counts its bigrams and words
(of the latter also how often they precede a word) once, under 64-bit keys, and sends them as packed
arrays, sorted by key, to key ranges of about ``RANGE`` words; a key comes at most once from a
chunk, so no hot word fills a range.  A range adds up its keys and answers every chunk with the sums in
the order of the keys that it sent.  Chunks and answers meet by chunk, where losses are summed
per text.

Defined results: null or empty text has 0 words and null losses and score; words are
folded to lower case for A-Z only; a target without documents gives the uniform model;
repeated rows are counted and scored as rows of their own; rows with a null id are never
targets; ids may have any type, and only the id and the columns named here come out; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from recordloom.llm.common import keep
from recordloom.shipping import ship_package

BIGRAM_WEIGHT = 0.7
CHUNK = 1 << 19
RANGE = 1 << 21
# Target ids of up to so many bytes go to every executor, more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
# What a key counts; the last bit of the key.
_BIGRAM, _WORD = 0, 1
_START = b""
_COUNTS = "bucket long, chunk long, size long, keys binary, counts binary"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, compressed byte by byte: all last bytes, then all bytes before them."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    width = 1 + max((i for i in range(8) if planes[i].any()), default=0)
    return zstandard.compress(planes[:width].tobytes(), 1)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(-1, max(1, n))
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(planes)] = planes.T[:n]
    return out.view("<u8").ravel()


class _Chunk:
    """Texts, or parts of them, of ``size`` words at most."""

    def __init__(self, number: int):
        self.number = number
        self.index: dict[bytes, int] = {}
        self.ids, self.rows, self.aimed, self.lengths, self.coded = [], [], [], [], []
        self.filled = 0

    def add(self, id_: object, row: int | None, aimed: bool, before: bytes, part: list[bytes]) -> int:
        """Add a part of a text, which follows the word ``before``; the row's number."""
        index = self.index
        numbers = [index.setdefault(w, len(index)) for w in (before, *part)]
        row = (self.number << 20) + len(self.rows) if row is None else row
        self.ids.append(id_)
        self.rows.append(row)
        self.aimed.append(aimed)
        self.lengths.append(len(part))
        self.coded.append(np.array(numbers, dtype="<u4"))
        # A text without words counts too, so that the number of texts is bounded.
        self.filled += max(1, len(part))
        return row

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.index], dtype="<u8")
        values = [
            self.number, self.ids, self.rows, self.aimed, self.lengths,
            _packed(np.concatenate(self.coded)), hashes.tobytes(),
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema
        )


def _chunker(schema: pa.Schema, size: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 20
        chunk = _Chunk(base)
        for batch in batches:
            for id_, text, aimed in zip(*(column.to_pylist() for column in batch.columns)):
                left, before, row = words(text), _START, None
                while True:
                    part = left[: size - chunk.filled]
                    row = chunk.add(id_, row, aimed, before, part)
                    left = left[len(part) :]
                    if chunk.filled >= size:
                        yield chunk.batch(schema)
                        chunk = _Chunk(chunk.number + 1)
                    if not left:
                        break
                    before = part[-1]
        if chunk.rows:
            yield chunk.batch(schema)

    return deal


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit key of two hashes; the constants are those of the splitmix64 generator."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _typed(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (_mixed(hashes, np.full(len(hashes), kind, np.uint64)) & ~np.uint64(1)) | np.uint64(kind)


class _Counts:
    """The bigrams of a chunk: which one stands where; their keys and the words', sorted.

    ``counts`` has a column per key: how often it occurs, the same in target documents, and for
    words how often they precede a word, the same in target documents.
    """

    def __init__(self, row: dict):
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        # Every part is led by the word before it.
        starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        coded = _unpacked(row["coded"], int(self.lengths.sum()) + len(starts)).astype(np.int64)
        hashes = np.frombuffer(row["words"], "<u8")
        width = len(hashes)
        now = np.delete(np.arange(len(coded)), starts)
        cells, self.at = np.unique(coded[now - 1] * width + coded[now], return_inverse=True)
        self.before, self.word = cells // width, cells % width
        aimed = np.repeat(np.array(row["aimed"], dtype=bool), self.lengths)
        counts = np.zeros((4, len(cells) + width), dtype=np.int64)
        for i, at in enumerate((self.at, self.at[aimed])):
            n = np.bincount(at, minlength=len(cells))
            counts[i, : len(cells)] = n
            counts[i, len(cells) :] = np.bincount(self.word, n, width)
            counts[i + 2, len(cells) :] = np.bincount(self.before, n, width)
        keys = np.concatenate([
            _typed(_mixed(hashes[self.before], hashes[self.word]), _BIGRAM), _typed(hashes, _WORD)
        ])
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.counts = keys[self.order], counts[:, self.order]

    def losses(self, model: int, counts: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
        """Minus log probability of each bigram by the sums over all chunks."""
        there = np.empty_like(counts)
        there[:, self.order] = counts
        k = len(self.word)
        single = (there[model, k:][self.word] + 1) / (total + vocabulary)
        follows = there[model + 2, k:][self.before]
        weight = np.where(follows > 0, BIGRAM_WEIGHT, 0.0)
        return -np.log(weight * there[model, :k] / np.maximum(follows, 1) + (1 - weight) * single)

    def sums(self, losses: np.ndarray) -> np.ndarray:
        """Losses added up over each text's words."""
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        return np.bincount(owner, losses[self.at], len(self.lengths))


def _rows(data: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    for i in range(data.num_rows):
        yield data.slice(i, 1).to_pylist()[0]


def _slices(keys: np.ndarray, borders: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *borders.tolist(), len(keys)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def _counts_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        names=["bucket", "chunk", "size", "keys", "counts"],
    )


def _counter(buckets: int):
    """Counts of every chunk, cut by ranges of their keys."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                chunk = _Counts(row)
                bucket = ((chunk.keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                yield _counts_batch([
                    (int(bucket[a]), row["chunk"], b - a,
                     _packed(np.diff(chunk.keys[a:b], prepend=np.uint64(0))),
                     _packed(chunk.counts[:, a:b].ravel()))
                    for a, b in _slices(chunk.keys, np.flatnonzero(np.diff(bucket)) + 1)
                ])

    return count


def _add_up(table: pa.Table) -> pa.Table:
    """Sums over one range's keys for every chunk; the number of words (chunk -1)."""
    bucket, chunks, sizes, keys, counts = (c.to_pylist() for c in table.columns)
    keys = np.concatenate([
        np.cumsum(_unpacked(k, n), dtype=np.uint64) for k, n in zip(keys, sizes)
    ])
    counts = np.concatenate(
        [_unpacked(c, 4 * n).reshape(4, n).astype(np.int64) for c, n in zip(counts, sizes)], axis=1
    )
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    own = np.empty(len(keys), dtype=np.int64)
    own[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    sums = np.add.reduceat(counts[:, order], first, axis=1)
    n_words = np.count_nonzero((keys[first] & np.uint64(1) == _WORD) & (sums[0] > 0))
    ends = np.cumsum(sizes)
    out = [
        (bucket[0], chunk, n, None, _packed(sums[:, own[end - n : end]].ravel()))
        for chunk, n, end in zip(chunks, sizes, ends)
    ]
    out.append((bucket[0], -1, 1, None, _packed(np.array([n_words]))))
    return pa.Table.from_batches([_counts_batch(out)])


def _rater(schema: pa.Schema, total: int, total_target: int, vocabulary: int):
    def rate(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in _rows(chunks):
            chunk = _Counts(row)
            parts = answers.sort_by("bucket").select(["size", "counts"]).to_pylist()
            sums = np.concatenate(
                [_unpacked(p["counts"], 4 * p["size"]).reshape(4, -1) for p in parts], axis=1
            ).astype(np.int64)
            target, background = (
                chunk.sums(chunk.losses(model, sums, n, vocabulary))
                for model, n in ((1, total_target), (0, total))
            )
            values = [row["ids"], row["rows"], row["lengths"], target, background]
            out.append(pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema
            ))
        return pa.Table.from_batches(out, schema=schema)

    return rate


def score(
    df: DataFrame,
    target_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    key_range: int = RANGE,
) -> DataFrame:
    """Id, n_words, target_loss, background_loss and score of every row.

    ``target_ids`` has one column, the ids of the target documents.
    """
    spark = df.sparkSession
    ship_package(spark)
    aims = keep(target_ids.toDF("target").where("target IS NOT NULL").distinct())
    measured = aims.agg(F.sum(F.octet_length(F.col("target").cast("string")) + 16)).first()[0]
    if (measured or 0) <= BROADCAST_BYTES:
        aims = F.broadcast(aims)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(aims, rows["id"] == aims["target"], "left").select(
        "id", "text", F.col("target").isNotNull().alias("aimed")
    )
    kind = rows.schema["id"].dataType
    staged = T.StructType.fromDDL(
        "chunk long, ids array<string>, rows array<long>, aimed array<boolean>, "
        "lengths array<long>, coded binary, words binary"
    )
    staged["ids"].dataType = T.ArrayType(kind)
    chunks = keep(
        rows.mapInArrow(_chunker(to_arrow_schema(staged), chunk), staged),
        # A row is some megabytes: the writer has to look at sizes more often.
        {"parquet.block.size.row.check.min": "4", "parquet.block.size": str(32 << 20)},
    )
    longs = F.lit(0).cast("long")
    sizes = chunks.select(
        F.explode(F.arrays_zip("lengths", "aimed")).alias("t")
    ).agg(
        F.coalesce(F.sum("t.lengths"), longs).alias("n"),
        F.coalesce(F.sum(F.when(F.col("t.aimed"), F.col("t.lengths"))), longs).alias("n_target"),
    ).first()
    buckets = max(1, -(-sizes["n"] // key_range))
    counted = chunks.select("chunk", "aimed", "lengths", "coded", "words").mapInArrow(
        _counter(buckets), _COUNTS
    )
    answers = keep(counted.groupBy("bucket").applyInArrow(_add_up, _COUNTS))
    found = answers.where("chunk = -1").select("counts").mapInArrow(_numbers, "n long")
    vocabulary = found.agg(F.coalesce(F.sum("n"), longs)).first()[0]
    parts = T.StructType.fromDDL(
        "id string, row long, n_words long, target_loss double, background_loss double"
    )
    parts["id"].dataType = kind
    rated = (
        chunks.groupBy("chunk")
        .cogroup(answers.where("chunk >= 0").groupBy("chunk"))
        .applyInArrow(_rater(to_arrow_schema(parts), sizes["n"], sizes["n_target"], vocabulary), parts)
    )
    # Texts longer than a chunk have several parts.
    added = rated.groupBy("row").agg(
        F.first("id").alias("id"), F.sum("n_words").alias("n_words"),
        *[F.sum(c).alias(c) for c in ("target_loss", "background_loss")],
    )
    target, background = (
        F.try_divide(c, F.col("n_words")) for c in (F.col("target_loss"), F.col("background_loss"))
    )
    return added.select(
        F.col("id").alias(id_col), "n_words", target.alias("target_loss"),
        background.alias("background_loss"), (target - background).alias("score"),
    )


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [int(_unpacked(v.as_py(), 1)[0]) for v in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64())], names=["n"])


_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SIDES = {"t": "WHERE aimed", "b": ""}


def _model_sql(name: str, where: str) -> str:
    return f"""
, {name}_uni AS (SELECT w, count(*) AS n FROM bigrams {where} GROUP BY w)
, {name}_bi AS (SELECT h, w, count(*) AS n FROM bigrams {where} GROUP BY h, w)
, {name}_h AS (SELECT h, count(*) AS n FROM bigrams {where} GROUP BY h)
, {name}_all AS (SELECT count(*) AS n FROM bigrams {where})
"""


def _p_sql(name: str) -> str:
    """Probability of a bigram of the table ``cells``."""
    single = f"(coalesce({name}_uni.n, 0) + 1) / ({name}_all.n + vocab_size.n)::DOUBLE"
    return (
        f"CASE WHEN {name}_h.n IS NULL THEN {single} ELSE {BIGRAM_WEIGHT} * "
        f"coalesce({name}_bi.n, 0) / {name}_h.n::DOUBLE + (1 - {BIGRAM_WEIGHT}::DOUBLE) * {single} END"
    )


def _joins_sql(name: str) -> str:
    return f"""
  LEFT JOIN {name}_uni ON {name}_uni.w = cells.w
  LEFT JOIN {name}_bi ON {name}_bi.h = cells.h AND {name}_bi.w = cells.w
  LEFT JOIN {name}_h ON {name}_h.h = cells.h, {name}_all
"""


OP1_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS ws,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0) AS aimed
  FROM documents
), flat AS (
  SELECT r, aimed, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM docs
), vocab_size AS (SELECT count(DISTINCT word) AS n FROM flat
), bigrams AS (
  SELECT r, aimed, word AS w, coalesce(lag(word) OVER (PARTITION BY r ORDER BY i), '') AS h
  FROM flat
), cells AS (SELECT DISTINCT h, w FROM bigrams)
{"".join(_model_sql(n, w) for n, w in _SIDES.items())}
, rated AS (
  SELECT cells.h, cells.w, -ln({_p_sql("t")}) AS t, -ln({_p_sql("b")}) AS b
  FROM cells {"".join(_joins_sql(n) for n in _SIDES).replace(", t_all", "").rstrip()}, t_all, vocab_size
), means AS (
  SELECT r, avg(t) AS t, avg(b) AS b FROM bigrams JOIN rated USING (h, w) GROUP BY r
)
SELECT doc_id, coalesce(len(ws), 0)::BIGINT AS n_words,
       round(t, 6) AS target_loss, round(b, 6) AS background_loss, round(t - b, 6) AS score
FROM docs LEFT JOIN means USING (r)
"""
