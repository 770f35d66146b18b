"""Operators 11 to 13 against SQL and brute force, and on odd tables."""

import collections
import math

import numpy as np
import pytest
from oracle_compare import connect, difference
from pyspark.sql import functions as F

from recordloom.llm import debruijn, divergence, language, negatives, neighbours, packing

SMALL = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, term string, n long, row long, id long"
LONG = "lorem ipsum dolor " * 9_000


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], ODD)


@pytest.fixture(scope="module")
def odd(spark):
    words = " ".join(f"w{i}" for i in range(80))
    return _docs(spark, [
        (1, words, "en", "a"), (2, words, "en", "a"), (2, words, "en", "a"), (3, None, None, None),
        (4, "", "de", None), (None, words, "en", "b"), (5, LONG, "fr", "b"), (6, LONG + "end", "fr", "b"),
        (7, "Ärger ärger 12 34", "de", "c"), (7, "x " + words, "en", ""), (8, " \t\n", "en", "zero"),
        (0, words[4:], "en", "c"), (9, "same " * 300, "en", "d"), (10, "same " * 200, "en", "d"),
    ])


def _plain_audit(rows, top=200):
    """Contract of the audit with Python's whole numbers."""
    terms = [
        (lang or "", source or "", "".join(
            chr(ord(c) + 32) if "A" <= c <= "Z" else c if c.islower() and c < "\x7f" or ord(c) > 127 else " "
            for c in text or "").split(" "))
        for _, text, lang, source in rows
    ]
    documents, counts, by_lang = (collections.defaultdict(collections.Counter) for _ in range(3))
    groups = {(lang, source) for lang, source, _ in terms}
    for lang, source, words in terms:
        words = [w for w in words if w]
        documents[lang].update(set(words))
        counts[lang, source].update(words)
        by_lang[lang].update(words)
    out = []
    for lang, source in groups:
        kept = [t for t, n in documents[lang].items() if n >= 3]
        weights = lambda c: {
            t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        p, q = weights(counts[lang, source]), weights(by_lang[lang])
        pairs = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                r = weights(counts[lang, other])
                pairs.append((sum((p[t] - r[t]) ** 2 // r[t] for t in kept), other))
        usual = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, math.inf), ("term", usual, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, t, v, i) for i, (v, t) in enumerate(found, 1) if i <= most]
    return sorted(out)


def _audited(df, **how):
    return sorted(tuple(r) for r in divergence.audit(df, **how).collect())


def test_audit_of_odd_tables(odd):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in odd.collect()]
    assert _audited(odd) == _plain_audit(rows)
    assert _audited(odd, group_block=1, term_block=7) == _plain_audit(rows)
    assert divergence.audit(odd.limit(0)).count() == 0


def test_audit_in_small_cells_equals_its_sql(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = divergence.audit(docs, group_block=3, term_block=50)
    assert difference(found, connect(SMALL), divergence.OP11_SQL) is None


def test_audit_beyond_64_bits(spark):
    """Counts whose products with a thousand million fit no long."""
    df = spark.createDataFrame([(20_000_000_000, 30_000_000_000, 5)], "n long, total long, kept long")
    found = df.select(divergence.weight("n", "total", "kept").alias("p")).first().p
    assert found == 1 + 10**9 * 20_000_000_001 // 30_000_000_005


def _plain_spans(rows, k):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, words in split:
        for i in range(len(words) - k + 1) if d is not None else ():
            w = tuple(words[i : i + k])
            first[w] = min(first.get(w, d), d)
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - k + 1) if d is not None else ():
            if first[tuple(words[i : i + k])] < d:
                gone.update(range(i, i + k))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((d, len(words), len(gone), b" ".join(kept).decode()))
    return sorted(out, key=repr)


def _cut(df, **how):
    found = debruijn.remove_repeated_spans(df, **how)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()), key=repr)


def test_spans_of_odd_tables(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert _cut(odd) == _plain_spans(rows, debruijn.K)
    assert debruijn.remove_repeated_spans(odd.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_spans_of_tangled_texts(spark, seed):
    """Few words, so that paths branch, cross, loop and repeat inside one text."""
    rng = np.random.RandomState(seed)
    passages = [rng.choice(list("abc"), rng.randint(3, 30)).tolist() for _ in range(6)]
    rows = []
    for _ in range(60):
        words = sum((passages[i] for i in rng.randint(0, 6, rng.randint(1, 5))), [])
        words[rng.randint(len(words))] = rng.choice(list("abcd"))
        rows.append((int(rng.randint(0, 50)) if rng.rand() < 0.95 else None, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _cut(df, k=8, seed_words=3) == _plain_spans(rows, 8)


def test_spans_tell_where_they_were(spark):
    words = " ".join(f"w{i}" for i in range(120))
    rows = [("b", f"x y {words} z"), ("a", words)]
    found = debruijn.remove_repeated_spans(spark.createDataFrame(rows, "doc_id string, text string"))
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in found.collect()}
    assert spans == {"a": [], "b": [(2, 120)]}


def test_copies_travel_as_one_path(spark):
    """Compaction: a passage in n documents is one path, not one row per window."""
    words = " ".join(f"w{i}" for i in range(1_000))
    df = spark.createDataFrame([(i, words) for i in range(20)], "id long, text string")
    texts = df.select("id", F.xxhash64("text").alias("h"), "text")
    schema = "id long, h long, p long, n long, m long, c1 long, c2 long, next long"
    found = texts.mapInArrow(debruijn._piece_batches(50, 16), schema)
    assert found.count() > 20 * 40
    [path] = debruijn.paths(found).collect()
    assert (path["first"], path["n"]) == (0, 951)


def _plain_mine(rows, k=5, top=3):
    used = []
    for i, (d, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not v:
            continue
        label = (label + 1) % 10 if d is not None and d % 7 == 0 else label
        used.append((i, d, label, [math.floor(256 * x) for x in v]))
    out = []
    for i, d, label, v in used:
        if d is None or d % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), e is None, e or 0, l == label)
            for j, e, l, w in used if j != i and len(w) == len(v)
        ]
        scored.sort()
        for ps, none, e, _ in [s for s in scored if s[3]][:k]:
            negative = [s for s in scored if not s[3] and -50 * ps <= -100 * s[0] <= -95 * ps][:top]
            out += [(d, None if none else e, r, None if s[1] else s[2], -ps, -s[0])
                    for r, s in enumerate(negative, 1)]
    return sorted(out, key=repr)


def _mined(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, label int, row int, score double")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.mine(df, F.col("vec_id") % 50 == 0, label)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_negatives_of_odd_tables(spark):
    rng = np.random.RandomState(1)
    rows = [(int(i), rng.randn(5).tolist(), int(rng.randint(3))) for i in range(0, 600, 5)]
    rows += [(i, [1.0, 0.5, 0.0, 0.0, 0.25], i % 3) for i in range(1000, 1100)]  # ties
    rows += [
        (None, [1.0, 1.0, 0.0, 0.0, 0.0], 1), (50, [0.0] * 5, 1), (100, rng.randn(5).tolist(), 0),
        (150, None, 1), (200, [float("nan")] + [1.0] * 4, 1), (250, [None] + [1.0] * 4, 1),
        (300, [1.0, 2.0], 1), (301, [1.0, 2.5], 1), (302, [1.0, 1.9], 2), (350, [], 1), (400, [1.0] * 5, None),
        (450, [float("inf")] + [1.0] * 4, 1),
    ]
    assert _mined(spark, rows) == _plain_mine(rows)
    assert _mined(spark, []) == []


def test_negatives_of_large_numbers(spark):
    rng = np.random.RandomState(2)
    rows = [(int(i), (rng.randn(4) * 1e6).tolist(), int(rng.randint(2))) for i in range(100)]
    rows += [(int(i), (rng.randn(4) * 200).tolist(), int(rng.randint(2))) for i in range(100, 200)]
    assert _mined(spark, rows) == _plain_mine(rows)


def test_intervals_hold_the_scores():
    rng = np.random.RandomState(3)
    for dim in (1, 7, 64, 100):
        x = np.floor(rng.randn(300, dim) * 100)
        coded = negatives.encode(x)
        block = collections.namedtuple("B", "codes ones align rest")(
            coded.codes.transpose(0, 2, 1).copy(),
            np.bitwise_count(coded.codes).sum(axis=2, dtype=np.int64),
            coded.align * coded.norm, (coded.rest + negatives._SLACK) * coded.norm,
        )
        width = []
        for anchor in negatives.anchors(np.floor(rng.randn(5, dim) * 100)):
            found = negatives.Interval(anchor, block, 0, len(x), np.ones(len(x), dtype=bool))
            for level in range(negatives.LEVELS):
                low, high = found.narrow(level)
                true = x @ anchor.vector
                assert (low <= true).all() and (true <= high).all()
                width.append((high - low).mean())
        assert dim == 1 or width[negatives.LEVELS - 1] < 0.5 * width[0]


def test_neighbours_keep_vectors_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.1]), (0, [1.0, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df.where("embedding[1] != 0.2"), F.col("vec_id") == 0).orderBy("rank")
    assert [(r.vec_id, round(r.score, 3)) for r in found.collect()] == [(1, 0.995), (1, 0.0)]
    both = neighbours.nearest(df, F.col("vec_id") == 0, k=2).collect()
    assert sorted((r.rank, r.vec_id) for r in both) == [(1, 1), (1, 1), (2, 0), (2, 0)]


def test_language_of_documents_without_id(spark):
    texts = {"en": "the cat sat on the mat and looked at {}", "de": "der Hund lief durch den Wald und sah {}"}
    rows = [(None, t.format(i), lang) for lang, t in texts.items() for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.identify(df)
    assert found.where("lang = lang_pred").count() == len(rows)


def test_bounds_of_long_documents_are_their_lengths(spark):
    rows = [(i, "w " * n) for i, n in enumerate([20_001] * 8 + [5, 6, 7] * 4)]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.bucket_length == r.length for r in found)


def test_bounds_of_many_lengths_are_the_best():
    rng = np.random.RandomState(4)
    for _ in range(20):
        lengths = np.unique(rng.randint(0, 400, 60))
        counts = rng.randint(1, 1000, len(lengths))
        k = int(rng.randint(1, 9))
        # Plain dynamic programming over all cuts.
        n = len(lengths)
        cost = lambda i, j: int((counts[i : j + 1] * (lengths[j] - lengths[i : j + 1])).sum())
        best = [cost(0, j) for j in range(n)]
        for _ in range(k - 1):
            best = [min([best[j]] + [best[i] + cost(i + 1, j) for i in range(j)]) for j in range(n)]
        bounds = np.array(packing.best_bounds(lengths, counts, k))
        padding = int((counts * (bounds[np.searchsorted(bounds, lengths)] - lengths)).sum())
        assert len(bounds) <= k and padding == best[-1]
