import random

import numpy as np
from posgraph.llm import decontaminate as dc

from tests.conftest import SF_SMALL
from tests.llm.util import docs, documents, rows, texts


def items(spark, pairs, clashes=False):
    if clashes:
        return spark.createDataFrame([(*p, "x", "y") for p in pairs], "item_id long, text string, score string, words string")
    return spark.createDataFrame(pairs, "item_id long, text string")


def brute_score(item, words):
    """Smith-Waterman by the plain recurrence."""
    h = np.zeros((len(item) + 1, len(words) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a == b else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_score_against_the_plain_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(1, 14)).astype(np.uint64) for _ in range(2))
        assert dc.smith_waterman(a, b)[0] == brute_score(a, b)


def test_sample_finds_every_copied_item(spark):
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = set(rows(dc.contaminated(documents(spark), bench), "doc_id", "item_id"))

    def w(t):
        return "".join(c if c.isalnum() else " " for c in t.lower()).split()
    want = set()
    for r in bench.collect():
        i = w(r["text"])
        for d, t in texts(spark).items():
            t = w(t)
            if brute_score_fast(i, t) >= len(i):
                want.add((d, r["item_id"]))
    assert got == want and want


def brute_score_fast(item, words):
    ids = {}
    code = [np.array([ids.setdefault(x, len(ids)) for x in part], np.uint64) for part in (item, words)]
    return dc.smith_waterman(*code)[0] if len(code[1]) else 0


def passage(seed, n=40):
    rng = random.Random(seed)
    return [f"q{rng.randrange(10**5)}" for _ in range(n)]


def test_edited_hot_and_clean(spark):
    rng = random.Random(1)
    filler = lambda: [f"f{rng.randrange(10**5)}" for _ in range(50)]
    bench = [(k, " ".join(passage(k))) for k in range(6)]
    rows_, want = [], set()
    for d in range(300):
        w = filler()
        if d % 3 == 0:  # one item in a third of all documents
            w[20:20] = passage(0)
            want.add((d, 0))
        elif d % 10 == 1:  # every seventh word replaced, one dropped, case and punctuation changed
            p = [x.upper() + "," if i % 5 == 2 else f"z{i}" if i % 7 == 3 else x for i, x in enumerate(passage(1 + d % 5))]
            del p[12]
            w[10:10] = p
            want.add((d, 1 + d % 5))
        elif d % 10 == 2:
            w[10:10] = passage(2)[:9]  # a short quotation is no contamination
        rows_.append((d, " ".join(w)))
    got = dc.contaminated(docs(spark, rows_), items(spark, bench))
    assert set(rows(got, "doc_id", "item_id")) == want
    exact = got.where("item_id = 0").collect()
    assert {(r["score"], r["start_word"], r["end_word"]) for r in exact} == {(1.0, 20, 60)}


def test_edited_copies_with_common_grams_only(spark):
    item = [f"w{k}" for k in range(1, 21)]
    edited = [f"z{k}" if k in (3, 8, 13) else w for k, w in enumerate(item)]
    pairs = [(0, " ".join(item))] + [(d, f"a{d} b{d} " + " ".join(edited) + f" c{d}") for d in range(1, 1001)]
    # The copy keeps common grams only; a rare gram of the item stands alone elsewhere in the document.
    pairs.append((1001, " ".join(item[:5] + [f"f{k}" for k in range(200)] + edited)))
    pairs.append((1002, " ".join(item[-5:])))
    got = dc.contaminated(docs(spark, pairs), items(spark, [(7, " ".join(item))]))
    assert {r["doc_id"]: r["score"] for r in got.collect()} == {0: 1.0} | dict.fromkeys(range(1, 1002), 0.775)


def test_grams_that_many_items_share(spark, monkeypatch):
    rng = random.Random(4)
    phrase = ["which", "of", "the", "following", "is", "right"]
    word = lambda: f"u{rng.randrange(10**6)}"
    bench = [[word() for _ in range(rng.randrange(3, 9))] + phrase + [word() for _ in range(14)] for _ in range(200)]
    texts_ = [[word() for _ in range(30)] + phrase + [word() for _ in range(30)] for _ in range(300)]
    want = set()
    for d in range(0, 40):  # copies that keep the common phrase as their only run of four words
        i = bench[d * 3]
        start = i.index("which")
        copy = [w if start <= k < start + 6 or k % 4 else f"e{d}x{k}" for k, w in enumerate(i)]
        texts_[d][20:20] = copy
        want.add((d, d * 3))
    pairs = [(d, " ".join(t)) for d, t in enumerate(texts_)]
    made, real = {}, dc.stored

    def counted(df, name, *rest):
        out = real(df, name, *rest)
        made[name] = out
        return out
    monkeypatch.setattr(dc, "stored", counted)
    results = []
    for shared in (0, dc.SHARED, 10**9):
        got = dc.contaminated(docs(spark, pairs), items(spark, [(k, " ".join(i)) for k, i in enumerate(bench)]), shared)
        results.append(sorted(tuple(r) for r in got.collect()))
        if shared == dc.SHARED:
            assert made["stretches"].count() < 3 * len(pairs)
    assert results[0] == results[1] == results[2]
    assert {r[:2] for r in results[0]} == want
    some = range(0, len(texts_), 20)  # some of them copies, against every item
    assert {(d, k) for d in some for k, i in enumerate(bench) if brute_score_fast(i, texts_[d]) >= len(i)} == {
        w for w in want if w[0] in some}


def test_equal_items_and_a_long_shared_one(spark):
    p = passage(21)
    bench = [(k, " ".join(p)) for k in range(6)] + [(10 + k, " ".join(p[:30] + passage(30 + k, 400))) for k in range(6)]
    pairs = [(1, " ".join(["a"] + p + ["b"])), (2, " ".join(p[:30] + passage(33, 400))), (3, " ".join(p[:9]))]
    got = rows(dc.contaminated(docs(spark, pairs), items(spark, bench)), "doc_id", "item_id")
    assert set(got) == {(d, k) for d in (1, 2) for k in range(6)} | {(2, 13)} and len(got) == 13


def test_nulls_short_items_long_texts_and_clashing(spark):
    p = " ".join(passage(9))
    pairs = [(1, p), (1, p), (2, None), (3, ""), (None, p), (4, "w " * 100_000 + p), (5, "nothing here")]
    bench = [(7, p), (7, p), (8, None), (9, ""), (10, "two words"), (None, p)]
    df = docs(spark, pairs, clashes=True)
    b = items(spark, bench, clashes=True)
    assert rows(dc.contaminated(df, b), "doc_id", "item_id") == [(1, 7), (4, 7)]
    kept = dc.keep_clean(df, b)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 2, 3, 5]


def test_unspaced_scripts_signs_and_short_items(spark):
    chinese, thai = "北京大学的学生在图书馆里读书写字", "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำ"
    bench = [(1, chinese), (2, thai), (3, "one two three four five"), (4, "lonely"), (5, "Rare pair"), (6, "three short words"), (7, "东京")]
    pairs = [(1, "前言很短。" + chinese + "，后面还有"), (2, "x " + thai + " y"), (3, "“one”—two…three\u3000four“five”"),
             (4, "a LONELY, word"), (5, "some rare—pair, rare pair"), (6, "three short words"), (7, "去东京玩"),
             (8, "rare short three lonelyness pair words"), (9, chinese[:3] + "不同的内容"), (10, "东 和 京"), (11, "three short"),
             (12, "short words")]
    got = dc.contaminated(docs(spark, pairs), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, k) for k in range(1, 8)}
    assert all(r["score"] == 1 for r in got)
    assert {r["doc_id"]: (r["start_word"], r["end_word"]) for r in got if r["doc_id"] in (1, 4, 5, 7)} == {
        1: (4, 20), 4: (1, 2), 5: (1, 3), 7: (1, 3)}


def test_empty_tables(spark):
    assert dc.contaminated(docs(spark, []), items(spark, [(1, "a b c d e")])).count() == 0
    assert dc.contaminated(docs(spark, [(1, "a b c d e")]), items(spark, [])).count() == 0
    assert dc.keep_clean(docs(spark, [(1, "a b c d e")]), items(spark, [])).count() == 1
