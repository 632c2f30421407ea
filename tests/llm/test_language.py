import zlib

import numpy as np
from posgraph.llm import language

from tests.llm.util import docs, rows

SF = "/root/testdata/sf0.01"


def fold(d):
    return zlib.crc32(str(d).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in language.identify(d, language.train(d)).collect()}
    truth = {r["doc_id"]: r["lang"] for r in d.select("doc_id", "lang").collect()}
    assert len(got) == len(truth) and all(r["held_out"] == fold(k) for k, r in got.items())
    held = [k for k in truth if fold(k) and truth[k]]
    assert len(held) > 200 and np.mean([got[k]["lang_pred"] == truth[k] for k in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_codewords_differ_in_many_bits():
    for n in (2, 3, 4, 5, 12, 60):
        c = language.codewords(n)
        apart = min(int((c[i] != c[j]).sum()) for i in range(n) for j in range(i))
        assert apart >= c.shape[1] // 4 and apart >= 1
        assert (np.abs(c.sum(0)) < n).all()  # every bit separates some languages


def test_one_wrong_bit_is_corrected():
    code = language.codewords(5)
    book = language.Codebook(list("abcde"), code, np.eye(code.shape[1]), np.zeros(code.shape[1]), np.ones(code.shape[1]))
    for k in range(5):
        bad = 2 * code[k].copy()
        bad[3] *= -1
        assert book.decode(bad[None, :])[0][0] == k


def train_rows():
    a, b = "the cat sat on the mat ", "der hund und die katze "
    return [(i, (a if i % 2 else b) * 5, "en" if i % 2 else "de") for i in range(80)]


def test_nulls_empty_and_clashing(spark):
    extra = [(1001, None, "en"), (1002, "", None), (1003, "123 !?", "de"), (None, "the cat sat on the mat", "de"),
             (1004, "der hund " * 100_000, None), (1005, "der hund und", None), (1005, "der hund und", None)]
    d = docs(spark, train_rows() + extra, clashes=True)
    got = rows(language.identify(d, language.train(d)), "doc_id", "held_out", "lang_pred")
    assert len(got) == 87
    by = {r[0]: r[1:] for r in got}
    assert [by[k][1] for k in (1001, 1002, 1003)] == ["und"] * 3 and by[None] == (None, "en")
    assert by[1004][1] == "de" and by[1005][1] == "de"


def test_without_labels_and_empty(spark):
    book = language.train(docs(spark, [(1, "abc")]))
    assert rows(language.identify(docs(spark, [(1, "abc")]), book), "lang_pred", "score") == [("und", 0.0)]
    assert language.identify(docs(spark, []), book).count() == 0
    one = docs(spark, [(i, "some words", "xx") for i in range(9)])
    assert {r["lang_pred"] for r in language.identify(one, language.train(one)).collect()} == {"xx"}


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    d = [(i, t, "zz" if fold(i) else s) for i, t, s in train_rows()]
    assert "zz" not in language.train(docs(spark, d)).langs


def test_signs_that_are_no_letters(spark):
    d = docs(spark, train_rows() + [(2001, "½²"), (2002, "①Ⅷ٣"), (2003, "½ x"), (2004, "ª")])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(d, language.train(d)).collect()}
    assert got[2001] == got[2002] == ("und", 0.0) and got[2003][0] != "und" and got[2004][0] != "und"


def test_every_language_is_learned(spark):
    """More languages than any bound on their number, and rows without a letter before those with one."""
    known = [i for i in range(6000) if not fold(i)]
    pairs = [(known[2 * k + j], f"{chr(0x4E00 + 7 * k) * 9} {chr(0x4E00 + 7 * k + 1) * 5}", f"l{k:03d}") for k in range(450) for j in (0, 1)]
    book = language.train(docs(spark, pairs + [(known[1000 + i], "12 !", "rare") for i in range(600)] + [(known[1700], "a b c", "rare")]))
    assert book.langs == [f"l{k:03d}" for k in range(450)] + ["rare"]
