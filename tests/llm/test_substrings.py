import hashlib
import random

import numpy as np
from posgraph.llm import substrings

from tests.llm.util import docs, documents, rows, texts

COLS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(pairs):
    out, first = [], {}
    for d, t in pairs:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            if d is not None:
                first[b[s:s + 50]] = min(d, first.get(b[s:s + 50], d))
    for d, t in pairs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for s in range(len(b) - 49):
            if d is not None and first[b[s:s + 50]] < d:
                gone[s:s + 50] = 1
        gone = gone[:len(b)]
        kept = bytes(np.frombuffer(b, np.uint8)[gone == 0])
        out.append((d, len(b), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_sample_against_brute_force(spark):
    assert rows(substrings.remove_repeats(documents(spark)), *COLS) == brute(texts(spark).items())


def test_passages_at_and_around_the_threshold(spark, monkeypatch):
    """Shared passages of 48 to 120 bytes at random places, in many task chunks; repeats inside one document."""
    monkeypatch.setattr(substrings, "CHUNK", 2000)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 3000)
    rng = random.Random(8)
    letters = "abcdefgh é"
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [some(n) for n in (44, 46, 48, 50, 51, 60, 90, 120)]
    pairs = []
    for d in range(150):
        t = "".join(rng.choice(passages) if rng.random() < 0.3 else some(rng.randrange(1, 80)) for _ in range(6))
        pairs.append((d * 7 % 150, t + (t[:70] if d % 11 == 0 else "")))
    pairs += [(200 + i, "ab" * (30 + i)) for i in range(5)] + [(300, pairs[0][1]), (301, pairs[0][1]), (302, "a" * 500)]
    assert rows(substrings.remove_repeats(docs(spark, pairs)), *COLS) == brute(pairs)


def test_stretches_of_a_hot_anchor_are_not_held_together(spark, monkeypatch):
    """A passage whose edges differ in every document: its edge anchors have a stretch per document."""
    settle_bucket = substrings._settle_bucket

    def held(table):
        most = np.unique(table["anchor"].to_numpy(), return_counts=True)[1].max()
        if most > 40:
            raise ValueError(f"{most} stretches of one anchor in one table")
        return settle_bucket(table)
    monkeypatch.setattr(substrings, "HOT", 40, raising=False)
    monkeypatch.setattr(substrings, "CHUNK", 2000)
    monkeypatch.setattr(substrings, "_settle_bucket", held)
    rng = random.Random(4)
    some = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, phrase, rare = some(130), some(30), some(90)
    pairs = [(d * 7 % 300, some(60) + passage + some(60) + phrase + some(60) + (rare if d % 30 == 0 else "")) for d in range(300)]
    pairs += [(5, pairs[9][1] + "x"), (400, pairs[9][1])]
    assert rows(substrings.remove_repeats(docs(spark, pairs)), *COLS) == brute(pairs)


def test_nulls_short_long_repeated_and_clashing(spark):
    text = "The quick brown fox jumps over the lazy dog and runs away from it. "
    pairs = [(3, text), (1, text + "x"), (2, None), (4, ""), (None, text), (5, text[:49]), (6, text[:50]), (6, text[:50]),
             (7, text[:25] + "\x00" * 30 + text), (8, "".join(f"{i:05d}" for i in range(3_000)) + text)]
    df = docs(spark, pairs, clashes=True)
    got = rows(substrings.remove_repeats(df), *COLS)
    assert got == brute(pairs) and len(got) == 10
    texts_ = {r["doc_id"]: r["kept_text"] for r in substrings.remove_repeats(df, with_text=True).collect()}
    assert texts_[7] == text[:25] + "\x00" * 30


def test_empty_table(spark):
    assert substrings.remove_repeats(docs(spark, [])).count() == 0


def test_radix_groups_are_the_equal_rows():
    rng = np.random.default_rng(1)
    rows_ = rng.integers(0, 3, (500, 13)).astype(np.uint8)
    rows_[:, 3:] = rows_[rng.integers(0, 40, 500), 3:]
    label = substrings.radix_groups(rows_)
    _, back, count = np.unique(rows_, axis=0, return_inverse=True, return_counts=True)
    back = back.reshape(-1)
    assert ((label < 0) == (count[back] == 1)).all()
    for i in range(0, 500, 7):
        if label[i] >= 0:
            assert ((label == label[i]) == (back == back[i])).all()


def test_hot_slots_are_split_off_without_an_outer_join(spark, monkeypatch):
    """Each stretch goes one way, by the exact slots, also where some slots are hot and others not."""
    monkeypatch.setattr(substrings, "HOT", 40, raising=False)
    pieces = spark.range(400).selectExpr("id as doc_id", "if(id < 100, 8, 8 * id + 3) as anchor")
    hot, cold = substrings._hot_and_rest(pieces, 1 << 20, "hot")
    assert "LeftOuter" not in hot.unionByName(cold)._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["doc_id"] for r in hot.collect()) == list(range(100))
    assert sorted(r["doc_id"] for r in cold.collect()) == list(range(100, 400))


def test_stretches_are_shuffled_with_short_anchors(spark, monkeypatch):
    settle_bucket = substrings._settle_bucket

    def short(table):
        if table["anchor"].to_numpy().max() >> 24:
            raise ValueError("a whole anchor is shuffled")
        return settle_bucket(table)
    monkeypatch.setattr(substrings, "_settle_bucket", short)
    monkeypatch.setattr(substrings, "CHUNK", 500)
    rng = random.Random(2)
    some = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = some(120)
    pairs = [(d, some(60) + passage[d % 9:] + some(60)) for d in range(40)]
    assert rows(substrings.remove_repeats(docs(spark, pairs)), *COLS) == brute(pairs)
