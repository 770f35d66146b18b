"""Every stage of the pipeline against a plain Python version, on planted rows."""

import collections
import re

import pytest

import corpus_pipeline
from recordloom.llm import simhash
from recordloom.llm.packing import ADDED

# Names that operators use inside, as columns of the user.
CLASHES = ["row", "_row", "_key", "_sha", "_h", "fp", "score", "lang_pred", "length", "size", "own_0", "copies"]
COLUMNS = ["doc_id", "text", "lang", "source", *CLASHES]
TYPES = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in CLASHES)


def _rows():
    line = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    texts = [
        (1, line("a"), "en", "x"), (2, line("a"), "de", "y"), (3, line("a").replace(" ", "\n \t"), "en", "x"),
        (4, line("A"), "en", "x"), (5, line("b"), "en", "y"), (6, line("b") + " z", "en", None),
        (None, line("c"), "en", "x"), (None, line("c"), "en", "x"), (None, line("C"), "en", "x"),
        (7, line("d"), None, "y"), (7, line("e"), "en", "y"), (7, line("e"), "en", "x"),
        (8, None, "en", "x"), (9, "", "en", "x"), (10, "12 34", "en", "y"), (11, " \t", None, None),
        (12, line("long", 9_000), "en", "z"), (13, "one", "en", "z"), (14, "two words", "de", None),
    ]
    texts += [(100 + i, line("copy"), "en", "x") for i in range(40)]
    texts += [(200 + i, line(f"n{i}x", 20 + i), "en" if i % 2 else "de", "xyz"[i % 3]) for i in range(60)]
    return [(*t, *(7 * n + i for i in range(len(CLASHES)))) for n, t in enumerate(texts)]


def _order(row):
    return row[0] is None, row[0] or 0


def _exact(rows):
    best = {}
    for row in rows:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")
        best.setdefault(key, []).append(row)
    return best


def _groups(rows):
    prints = [simhash.fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= simhash.MAX_BITS:
                group[root(i)] = root(j)
    out = collections.defaultdict(list)
    for i, row in enumerate(rows):
        out[root(i)].append(row)
    return out.values()


def _one_of_each(found, groups, least):
    """Of every group one row is left, one with the least place, and nothing else is."""
    left = collections.Counter(found)
    for group in groups:
        staying = [r for r in group if left[r]]
        assert len(staying) == 1 and least(staying[0]) == min(map(least, group))
    assert sum(left.values()) == len(list(groups))


@pytest.fixture(scope="module")
def stages(spark):
    docs, results = spark.createDataFrame(_rows(), TYPES), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, ""))
        results.append((name, docs.columns, [tuple(r) for r in docs.collect()]))
    return results


def test_stages_against_plain_python(stages):
    names, columns, results = zip(*stages)
    assert names == ("language", "exact_dedup", "near_dedup", "mixture", "packing")
    assert all(c == COLUMNS for c in columns[:-1])
    assert columns[-1] == [c for c in COLUMNS if c not in ADDED] + ADDED
    rows = _rows()
    language, exact, near, mixture, packing = results
    assert sorted(language, key=repr) == sorted(
        (r for r in rows if any(c.isalpha() for c in r[1] or "")), key=repr
    )
    _one_of_each(exact, _exact(language).values(), _order)
    _one_of_each(near, _groups(exact), _order)

    sizes = collections.Counter()
    for r in near:
        sizes[r[3]] += len(r[1].split())
    copies = collections.Counter(mixture)
    assert set(copies) <= set(near) and max(copies.values()) <= 3
    # Sources by code point, null last, weigh 1, 2, 3; what is above three times a size is dealt anew.
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while open_:
        rest = sum(sizes.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        target.update({s: 3 * sizes[s] for s in full} if full else share)
        open_ -= full or open_
    for s in order:
        taken = sum(n * len(r[1].split()) for r, n in copies.items() if r[3] == s)
        assert abs(taken - target[s]) <= max(len(r[1].split()) for r in near if r[3] == s)

    at = {c: i for i, c in enumerate(columns[-1])}
    kept = [i for i, c in enumerate(COLUMNS) if c not in ADDED]
    assert sorted((r[: len(kept)] for r in packing), key=repr) == sorted(
        (tuple(r[i] for i in kept) for r in mixture), key=repr
    )
    batches = collections.defaultdict(list)
    for r in packing:
        n, bound = r[at["length"]], r[at["bucket_length"]]
        assert n == len(r[1].split()) <= bound
        batches[r[at["batch_id"]]].append((r[at["slot"]], bound))
    bounds = sorted({r[at["bucket_length"]] for r in packing})
    assert all(r[at["bucket_length"]] == next(b for b in bounds if b >= r[at["length"]]) for r in packing)
    for found in batches.values():
        assert sorted(slot for slot, _ in found) == list(range(len(found)))
        assert len(found) == 1 or sum(bound for _, bound in found) <= 32_768
