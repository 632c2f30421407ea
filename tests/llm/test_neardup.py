import random

import numpy as np
import pytest
from posgraph.llm import neardup

from tests.llm.util import docs, documents, rows, texts, words

COLS = ("doc_id", "n_shingles", "component_id", "kept")


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(pairs):
    sets = {d: shingles(t) for d, t in pairs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= 75 * (len(x) + len(y) - n):
                    lo, hi = sorted((find(a), find(b)))
                    parent[hi] = lo
    return sorted(((d, len(sets[d]), find(d), find(d) == d) for d in ids), key=repr)


def test_sample_against_brute_force(spark):
    assert rows(neardup.near_duplicates(documents(spark)), *COLS) == brute(texts(spark).items())


def test_one_large_group_with_edits_of_every_degree(spark):
    """Copies edited a little to a lot: links exist only between some of them, at and around the threshold."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    pairs = []
    for d in range(160):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(30)}"
        pairs.append((d, " ".join(w)))
    pairs += [(1000 + i, " ".join(f"u{i}x{j}" for j in range(60))) for i in range(40)]
    random.Random(1).shuffle(pairs)
    assert rows(neardup.near_duplicates(docs(spark, pairs)), *COLS) == brute(pairs)


def test_threshold_is_exact(spark):
    """75 of 100 shingles in common is a link, 74 of 99 or 100 is not."""
    w = [f"a{i}" for i in range(104)]  # 100 shingles
    near, far = w[:79], w[:78]         # 75 and 74 of them
    for text, same in ((near, True), (far, False)):
        got = rows(neardup.near_duplicates(docs(spark, [(1, " ".join(w)), (2, " ".join(text))])), *COLS)
        assert got == brute([(1, " ".join(w)), (2, " ".join(text))]) and (got[1][2] == 1) is same


def test_nulls_short_long_repeated_and_clashing(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    pairs = [(4, None), (3, ""), (9, " \t "), (8, "One two"), (2, "one  TWO"), (7, long), (6, long + " end"),
             (None, "one two"), (1, "alone here")]
    df = docs(spark, pairs + [(8, "One two")], clashes=True)
    got = rows(neardup.near_duplicates(df), *COLS)
    assert len(got) == 10
    by = {r[0]: r for r in got}
    assert by[4] == (4, 0, 4, True) and by[3] == (3, 0, 3, True) and by[9] == (9, 0, 9, True)
    assert by[8] == (8, 1, 2, False) and by[2] == (2, 1, 2, True) and got.count(by[8]) == 2
    assert by[7][1:] == (59_996, 6, False) and by[6][2:] == (6, True)
    assert by[None] == (None, 1, None, True)
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 9]


def test_rows_of_one_id_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    got = rows(neardup.near_duplicates(docs(spark, [(5, a), (5, b), (3, a), (4, b + " c")])), "doc_id", "component_id")
    assert got == [(3, 3), (4, 3), (5, 3), (5, 3)]


def test_empty_table(spark):
    assert neardup.near_duplicates(docs(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "a long, b long")
    got = rows(neardup.components(edges), "id", "component")
    assert sorted(got) == [(i, 0) for i in range(1, 61)] + [(101, 100)]


@pytest.mark.parametrize("share", [0.75, 0.9])
def test_signature_agreement_follows_similarity(share):
    rng = np.random.default_rng(3)
    agree = []
    for _ in range(60):
        common, own = int(400 * share), int(400 * (1 - share) / 2)
        u = rng.integers(0, 1 << 63, common + 2 * own, dtype=np.uint64)
        x, y = neardup.signature(u[:common + own]), neardup.signature(np.concatenate([u[:common], u[common + own:]]))
        agree.append((x == y).mean())
    assert abs(np.mean(agree) - share) < 0.03
