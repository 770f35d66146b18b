"""Every operator against SQL, brute force or held-out accuracy, and on odd tables."""

import collections
import hashlib
import itertools
import re

import numpy as np
import pytest
from conftest import SMALL
from oracle_compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from recordloom.llm import mixing, neighbours, packing, pii, repeats, scoring, simhash, urls
from recordloom.llm import queries as llm
from recordloom.llm.exact_dedup import ExactDedup
from recordloom.llm.language import identify

SCHEMA = "doc_id long, text string, lang string, source string, kept string, size long, word string"
LONG = "lorem ipsum " * 20_000
ODD = [
    (1, "one two  three\tfour five six", "en", "a", "x", 1, "w"),
    (2, "one two three four five six", "en", "a", "x", 1, "w"),
    (2, "one two three four five six", "en", "a", "x", 1, "w"),
    (3, None, None, None, None, None, None),
    (4, "", "de", None, "x", 1, "w"),
    (None, " \t ", "de", "b", "x", 1, "w"),
    (5, LONG, "fr", "b", "x", 1, "w"),
    (6, LONG + "end", "fr", "b", "x", 1, "w"),
    (7, "1234 5678", "es", "c", "x", 1, "w"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    return connect(SMALL).execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(llm.QUERIES[name](spark, SMALL), connect(SMALL), llm.ORACLES[name]) is None


def test_scoring_of_odd_tables(spark, odd, empty):
    target = spark.createDataFrame([(1,)], "doc_id long")
    rows = scoring.score(odd, target).collect()
    assert len(rows) == len(ODD)
    assert all((r.score is None) == (r.n_words == 0) for r in rows)
    assert scoring.score(empty, target).count() == 0


def test_scoring_in_small_chunks(spark, texts):
    """Texts over several chunks, counts over many ranges: the figures of one chunk."""
    documents = spark.createDataFrame(texts[:60] + texts[:3] + [(None, "a b"), (-1, None)], "doc_id long, text string")
    target = documents.where("doc_id % 3 = 0").select("doc_id")

    def rows(**sizes):
        found = scoring.score(documents, target, **sizes).collect()
        return sorted(tuple(r) if r.score is None else (*r[:2], *(round(x, 9) for x in r[2:])) for r in found
                      if r.doc_id is not None)

    assert rows(chunk=13, key_range=500) == rows() and len(rows()) == 64


def test_rare_words_tell_documents_apart(spark):
    """Two words that occur once each, one of them in the target, among 3,000 others."""
    many = " ".join(f"w{i} w{i}" for i in range(3_000))
    rows = [(0, many), (1, "w1 rare w2"), (2, "w1 rare w2"), (3, "w1 other w2")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    target = documents.where("doc_id = 1").select(F.col("doc_id").cast("string"))
    strings = documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    found = {r.doc_id: r.score for r in scoring.score(strings, target).collect()}
    assert found["1"] == found["2"] < found["3"]


def test_mix_meets_targets_and_bounds(spark):
    rows = llm.op2_pivotal_mix(spark, SMALL).collect()
    again = llm.op2_pivotal_mix(spark, SMALL).collect()
    assert sorted(rows) == sorted(again)
    assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in rows)
    by_target = collections.defaultdict(list)
    for r in rows:
        by_target[r.source_size, r.target].append(r)
    for (size, target), group in by_target.items():
        assert target <= 3 * size + 1e-6
        assert abs(sum(r.taken for r in group) - target) <= max(r.size for r in group)
    assert sum(t for _, t in by_target) == pytest.approx(sum(s for s, _ in by_target))


def test_targets_are_dealt_anew_above_the_ceiling(spark):
    sizes = spark.createDataFrame(
        [("a", 1000), ("b", 10), ("c", 10), (None, 100)], "source string, size long"
    )
    found = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert found["b"] == found["c"] == 30 and found["a"] + found[None] == pytest.approx(1060)
    assert found[None] == 300 and found["a"] == pytest.approx(760)


def test_mix_of_odd_tables(odd, empty):
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(empty).count() == 0
    assert mixing.mixed_rows(odd).columns == odd.columns and mixing.mixed_rows(empty).count() == 0


def test_neighbours_against_brute_force(spark):
    found = collections.defaultdict(list)
    for r in llm.op3_collision_counting(spark, SMALL).orderBy("rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    rows = connect(SMALL).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    hits = []
    for q in np.flatnonzero(ids % 50 == 0):
        cosine = x @ x[q]
        cosine[q] = -9
        best = ids[np.lexsort((ids, -cosine))[:5]]
        hits += [b in [v for v, _ in found[ids[q]]] for b in best]
        assert all(abs(cosine[np.flatnonzero(ids == v)[0]] - s) < 1e-9 for v, s in found[ids[q]])
    assert np.mean(hits) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]),
            (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [3.0, 0.0]), (8, [1.0]), (1, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [1, 7, 2] and found[0].score == 1.0
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_bounds_are_the_best():
    rng = np.random.RandomState(3)
    classes, counts = np.unique(rng.randint(1, 60, 12)), None
    counts = rng.randint(1, 20, len(classes))
    cost = lambda bs: sum(c * (min(b for b in bs if b >= v) - v) for v, c in zip(classes, counts))
    for k in (1, 2, 3, 5):
        mine = packing.best_bounds(classes, counts, k)
        options = itertools.combinations(classes[:-1].tolist(), min(k, len(classes)) - 1)
        assert cost(mine) == min(cost([*o, classes[-1]]) for o in options)


def test_batches_keep_to_the_budget(spark, odd, empty):
    rows = llm.op4_length_buckets(spark, SMALL).collect()
    batches = collections.defaultdict(list)
    for r in rows:
        assert r.length <= r.bucket_length
        batches[r.batch_id].append(r)
    for group in batches.values():
        assert len(group) * group[0].bucket_length <= packing.TOKEN_BUDGET or len(group) == 1
        assert sorted(r.slot for r in group) == list(range(len(group)))
    assert packing.pack(odd).count() == len(ODD) and packing.pack(empty).count() == 0


def test_language_of_held_out_texts(spark, odd, empty):
    found = llm.op5_hierarchical_language(spark, "/root/testdata/sf0.01").where("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.join(truth, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")))
    assert right.first()[0] > 0.95
    rows = {r.doc_id: r for r in identify(odd).collect()}
    assert rows[3].lang_pred == rows[4].lang_pred == rows[7].lang_pred == "und"
    assert identify(empty).count() == 0


def test_exact_dedup_of_odd_tables(odd, empty):
    rows = ExactDedup(odd).decisions().collect()
    assert sum(r.kept for r in rows) == 6 and len(rows) == len(ODD)
    assert {r.keep_id for r in rows if r.doc_id == 2} == {1}
    kept = ExactDedup(odd).survivors()
    assert kept.columns == odd.columns and kept.count() == 6
    assert ExactDedup(empty).decisions().count() == 0


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, found):
    digits = [int(c) for c in re.sub("[^0-9]", "", found)]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


TRICKY = [
    (1, "a@b.c_x@d.e a@b.c..d@e.f x@@y.z a@b@c.d 😀 1.2.3.4.5.6.7.8 999.1.1.1 0001.0.0.255"),
    (2, "4111 1111-1111 1111 +1 (2) 3456789-0 +12  3 1-2-3 it's"),
    (3, "x@" + "b." * 20_000 + "c " + "9" * 3_000 + " " + "1.2.3.4 " * 600),
    (4, "call 1.2.3.4 call 1.2.3.5 call 1.2.3.6 call AB-99-12x"),
    (5, None),
    (6, ""),
]


def test_personal_data_against_plain_expressions(spark, texts):
    rows = [*TRICKY, *[(d + 1000, t) for d, t in texts]]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        base = [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items()
                for m in re.finditer(p, text or "") if _valid(k, m[0])]
        row = found[doc_id]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert row.spans.startswith(",".join(base))
    assert found[4].spans.endswith(",id:44:53") and found[4].n_id == 1


def test_identifier_in_running_text(spark):
    rows = [(i, f"please call 1.2.3.{i} now") for i in range(6)]
    rows += [(10, "they call AB-99-12x tomorrow"), (11, "release AB-11-12x came"), (12, "CD-11-12x")]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[10].spans == "id:10:19" and found[10].n_id == 1
    assert found[11].n_id == found[12].n_id == 0


def test_identifier_after_long_words(spark):
    """Contexts are taken by words, however long: three words of 300 letters, which differ in the first."""
    near = " ".join(["b" * 300, "c" * 300, ""])
    rows = [(i, f"{'a' * 300} {near}1.2.3.{i} {near}end") for i in range(6)]
    rows += [(i, f"{'x' * 300} {near}note, {near}AB-{i}-12x") for i in range(20, 24)]
    rows += [(10, f"{'a' * 300} {near}AB-99-12x {near}end"), (11, f"no{near}AB-11-12x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    contexts = {r.id: set(r.words[0].patterns) for r in pii.extract(df).collect() if r.words}
    assert f"< {'a' * 300} {near}" in contexts[10] and f">  {near}end" in contexts[10]
    assert f"< no{near}" in contexts[11] and f"< {near}" not in contexts[11]
    found = {r.doc_id: r for r in pii.find(df).collect()}
    assert found[10].n_id == 1


def test_urls(spark):
    rows = [(i, u) for i, u in enumerate([
        "http://A.example.NET/en/x", "https://example.net/de/1", "http://example.com/de/2?x",
        "http://www.org/fr/", "http://org/fr", "http://notexample.com/de/3", None, "nothing", "",
        "http://a.net?x=/en/", "http://b.org/x://c.net/en/",
    ])]
    df = spark.createDataFrame(rows, "page_id long, url string")
    found = {r.page_id: r for r in urls.judge(df).collect()}
    rules = [found[i].rule for i, _ in rows]
    assert rules == ["example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None,
                     None, None, None, None]
    assert (found[9].host, found[9].path) == ("a.net", "") and found[10].path == "/x://c.net/en/"
    assert all(r.verdict in ("allow", "block") for r in found.values())
    assert found[6].host == found[6].path == "" and urls.judge(df.limit(0)).count() == 0


def test_repeats_against_counting(spark, texts):
    rows = [*texts, (9001, None), (9002, ""), (9003, "a" * 2000), (9004, "ab" * 150), (9005, "q" * 201),
            (9006, "x" + "ab" * 300 + "é" * 120), (9007, "z" * 199), (9007, "z" * 199)]
    n, seen = repeats.LENGTH, collections.Counter()
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        seen.update(b[p : p + n] for p in range(len(b) - n + 1))
    wanted = []
    for d, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                gone[p : p + n] = b"\1" * n
        runs = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        rest = bytes(c for c, g in zip(b, gone) if not g)
        wanted.append((d, len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)


def test_near_duplicates_against_all_pairs(spark):
    rows = connect("/root/testdata/sf0.01").execute("SELECT doc_id, text FROM documents").fetchall()
    rows += [(5001, None), (5002, ""), (5003, "a b c d e"), (5004, "A b  c d e")]
    marks = {d: simhash.fingerprint(t) for d, t in rows}
    group = {d: d for d in marks}
    values, ids = np.array(list(marks.values()), dtype=np.uint64), list(marks)

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for d, v in marks.items():
        for i in np.flatnonzero(np.bitwise_count(values ^ np.uint64(v)) <= simhash.MAX_BITS):
            a, b = root(d), root(ids[i])
            group[max(a, b)] = min(a, b)
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {d: root(d) for d in marks}


def test_near_dedup_decides_by_row(spark):
    # Letters are folded, so these are near copies of one fingerprint and no exact ones.
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [(1, text("a")), (None, text("A")), (None, text("b")), (None, text("c")),
            (None, text("C")), (2, text("d")), (3, text("D")), (3, text("e"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.near_dedup(spark, df, "").collect()]
    c = [r for r in kept if r[1].lower().startswith("c0 ")]
    assert len(c) == 1 and c[0] in rows
    assert {r for r in kept if r not in c} == {rows[i] for i in (0, 2, 5, 7)} and len(kept) == 5


def test_dense_lists_yield_few_links():
    rng = np.random.RandomState(5)
    fps = np.unique([np.uint64(1) << np.uint64(a) | np.uint64(1) << np.uint64(b)
                     for a, b in rng.randint(46, 64, (300, 2))]).astype(np.uint64)
    assert len(simhash._links(fps, 0)) <= len(fps) - 1


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = corpus_pipeline.run(spark, SMALL)
    assert set(docs.columns) <= set(rows.columns) and rows.count() > 0
    assert rows.join(docs, "doc_id", "left_anti").count() == 0


def test_pipeline_of_odd_tables(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= 0
