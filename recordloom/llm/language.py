"""Language identification in two steps: the family first, then the language within it.

Features are counts of letter sequences of length one to three over the whole text, folded
to lower case, hashed into ``DIM`` classes, square-rooted and scaled to length one.  The
family is chosen by one-versus-rest linear support vector machines; inside a family every
pair of languages has a linear support vector machine of its own and the most votes win.

The classifier learns from a sample of at most about ``SAMPLE`` labelled documents per
language, chosen by a hash of id and text, so the driver holds ``languages * SAMPLE * DIM``
numbers.  Sampled texts are turned into features on the executors; prediction is a narrow
map over all documents, with the model (a few hundred kB) in its closure.

Defined results: `und` with score 0 for null text, text without a letter, or where nothing
could be learned; one learned language is predicted always; ties go to the first name in
code point order; null languages are not learned from; repeated rows are rows of their own;
an empty table gives an empty result; columns with the added names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import without
from recordloom.shipping import ship_package

DIM = 4_096
SAMPLE = 500
UNKNOWN = "und"
ADDED = ["lang_pred", "score"]
# Families of common written languages; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi mr ne bn ur pa gu",
    "semitic": "ar he mt am",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
_CHUNK = 1 << 20


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0], lang)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Hashed counts of the sequences of one to three characters, in bounded memory.

    Every character that is no letter counts as a blank.
    """
    total = np.zeros(DIM)
    tail = np.empty(0, dtype=np.uint32)
    for start in range(0, len(text), _CHUNK):
        piece = np.frombuffer(
            text[start : start + _CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32
        )
        letter = ((piece >= 97) & (piece <= 122)) | (piece >= 0xAA)
        piece = np.where(letter, piece, 32).astype(np.uint32)
        codes = np.concatenate([tail, piece])
        old = len(tail)
        h = np.zeros(len(codes), dtype=np.uint32)
        for n in (1, 2, 3):
            if len(codes) < n:
                break
            h = (h[: len(codes) - n + 1] if n == 1 else h[:-1]) * np.uint32(0x01000193)
            h = (h ^ codes[n - 1 :]) * np.uint32(0x9E3779B1)
            mixed = (h ^ (h >> np.uint32(15))) & np.uint32(DIM - 1)
            # Only sequences that end in this piece; earlier ones are counted already.
            new = mixed[max(0, old - n + 1) :]
            total += np.bincount(new, minlength=DIM)
        tail = codes[-2:]
    total = np.sqrt(total)
    norm = np.sqrt((total * total).sum())
    return (total / norm if norm else total).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, c: float = 30.0, steps: int = 150) -> np.ndarray:
    """Weights (bias last) of a linear squared-hinge machine, by accelerated descent."""
    bias = x.shape[1]
    w = np.zeros(bias + 1)
    v = w.copy()
    # Rows have length sqrt(2) at most, so this bounds the curvature.
    rate = 1.0 / (1.0 + 2 * c * 2)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    gradient = np.empty(bias + 1)
    for k in range(steps):
        # Products in the rows' own precision: no second copy of them in the driver.
        margins = (x @ v[:bias].astype(x.dtype)).astype(np.float64) + v[bias]
        pull = weight * y * np.maximum(0.0, 1 - y * margins)
        gradient[:bias] = x.T @ pull.astype(x.dtype)
        gradient[bias] = pull.sum()
        new = v - rate * (v - 2 * c * gradient)
        v = new + (k / (k + 3)) * (new - w)
        w = new
    return w.astype(np.float32)


@dataclass
class Model:
    """Family machines and, per family, its languages and their pair machines."""

    families: list[str]
    family_weights: np.ndarray
    languages: dict[str, list[str]]
    pairs: dict[str, dict[tuple[int, int], np.ndarray]]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        x = np.append(x, np.float32(1))
        margins = self.family_weights @ x
        chosen = int(np.argmax(margins))
        name = self.families[chosen]
        certainty = 1.0
        if len(self.families) > 1:
            e = np.exp(2 * (margins - margins.max()))
            certainty = float(e[chosen] / e.sum())
        languages = self.languages[name]
        votes = np.zeros(len(languages))
        sure = np.zeros(len(languages))
        for (i, j), w in self.pairs[name].items():
            p = 1 / (1 + np.exp(-2 * float(w @ x)))
            votes[i if p >= 0.5 else j] += 1
            sure[i] += p
            sure[j] += 1 - p
        best = int(np.argmax(votes))
        if len(languages) > 1:
            certainty *= sure[best] / (len(languages) - 1)
        return languages[best], float(min(1.0, max(0.0, certainty)))


def fit(langs: list[str], x: np.ndarray) -> Model | None:
    if not langs:
        return None
    lang = np.array(langs, dtype=object)
    names = sorted(set(langs))
    families = sorted({family(n) for n in names})
    of = np.array([family(n) for n in langs], dtype=object)
    family_weights = np.stack(
        [svm(x, np.where(of == f, 1.0, -1.0)) for f in families]
        if len(families) > 1
        else [np.zeros(x.shape[1] + 1, dtype=np.float32)]
    )
    languages = {f: [n for n in names if family(n) == f] for f in families}
    pairs: dict[str, dict[tuple[int, int], np.ndarray]] = {}
    for f, members in languages.items():
        pairs[f] = {}
        for i, j in combinations(range(len(members)), 2):
            chosen = (lang == members[i]) | (lang == members[j])
            pairs[f][i, j] = svm(x[chosen], np.where(lang[chosen] == members[i], 1.0, -1.0))
    return Model(families, family_weights, languages, pairs)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [features(t).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(vectors, pa.binary())], names=["lang", "x"]
        )


def train(
    df: DataFrame, lang_col: str, text_col: str, id_col: str, sample: int = SAMPLE
) -> Model | None:
    """Learn from about ``sample`` documents per language of ``df``, chosen by a hash of id and text."""
    ship_package(df.sparkSession)
    usable = df.where(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
    )
    counts = usable.groupBy(F.col(lang_col).alias("lang")).count().collect()
    share = F.lit(0.0)
    for lang, n in counts:
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    h = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col), F.col(text_col)), F.lit(1 << 20)) / F.lit(1 << 20)
    chosen = usable.where(h < share).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    rows = chosen.mapInArrow(_feature_batches, "lang string, x binary").orderBy("lang", "x")
    table = rows.toArrow()
    langs = table.column("lang").to_pylist()
    x = np.empty((len(langs), DIM), np.float32)
    at = 0
    for chunk in table.column("x").chunks:
        for vector in chunk:
            x[at] = np.frombuffer(vector.as_buffer(), np.float32)
            at += 1
    del table
    return fit(langs, x)


def predict(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Adds lang_pred and score; nothing but the text is looked at."""
    ship_package(df.sparkSession)
    df = without(df, ADDED)
    place = df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields]).add("lang_pred", "string").add("score", "double")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(place):
                text = text.as_py()
                if model is None or text is None or not has_letter(text):
                    found.append((UNKNOWN, 0.0))
                else:
                    found.append(model.predict(features(text)))
            arrays = [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], names=[*batch.schema.names, *ADDED]
            )

    return df.mapInArrow(add, schema)


def held_out(id_col: str) -> Column:
    """Documents that are never learned from."""
    rest = F.crc32(F.col(id_col).cast("string")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def identify(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Learn from the documents that are not held out and predict all of them."""
    model = train(df.where(~held_out(id_col)), lang_col, text_col, id_col)
    return predict(df, model, text_col)
