import zlib

import numpy as np
from posgraph.llm import quality
from pyspark.sql import functions as F

from tests.llm.util import docs

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def fold(d):
    return zlib.crc32(str(d).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.score(d, quality.train(d, labels)).collect()}
    held = [(r["quality"], got[r["doc_id"]]) for r in labels.collect() if fold(r["doc_id"])]
    assert len(got) == d.count() and len(held) > 50
    assert np.mean([q == g["predicted"] for q, g in held]) >= 0.95
    assert all(g["predicted"] == int(g["score"] >= 0.3) and 0 <= g["score"] <= 1 for g in got.values())
    good, bad = ([g["score"] for q, g in held if q == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) >= 0.97  # pairs ranked right


def test_ranker_finds_the_direction_and_the_cut():
    rng = np.random.default_rng(0)
    n = len(quality.FEATURES)
    good, bad = rng.normal(size=(300, n)), rng.normal(size=(100, n))
    good[:, 2] += 4
    r = quality.bradley_terry(good, bad, 0.75)
    assert r.score(good).mean() > 0.6 and (r.score(good) >= 0.3).mean() > 0.9 and (r.score(bad) < 0.3).mean() > 0.9


def sample(spark, clashes=False):
    good = [(i, f"Some plain sentence number {i} with words. Another one follows here.") for i in range(40)]
    bad = [(100 + i, f"BUY!! NOW!! {i} $$$ ||| ###") for i in range(40)]
    odd = [(500, None), (501, ""), (None, "Plain words again."), (502, "!!! " * 50_000), (503, "x"), (503, "x")]
    labels = [(i, 1, 0) for i in range(40)] + [(100 + i, 0, None) for i in range(40)]
    labels += [(None, 0, 0), (501, None, 0), (7, 0, 0), (9999, 1, 0), (0, 1, 0)]
    return docs(spark, good + bad + odd, clashes), spark.createDataFrame(labels, LABELS)


def test_nulls_contradictions_and_clashing(spark):
    d, labels = sample(spark, clashes=True)
    got = quality.score(d, quality.train(d, labels)).collect()
    assert len(got) == 86
    by = {r["doc_id"]: r for r in got}
    assert by[3]["predicted"] == 1 and by[105]["predicted"] == 0 and by[None]["held_out"] is None
    assert by[500]["score"] == by[501]["score"]
    kept = quality.keep_good(d, labels)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in got if r["predicted"])


def test_without_both_labels_and_empty(spark):
    d, labels = sample(spark)
    model = quality.train(d, labels.where("quality = 1"))
    assert {r["score"] for r in quality.score(d, model).collect()} == {0.5}
    assert quality.score(docs(spark, []), quality.train(docs(spark, []), labels)).count() == 0
    assert quality.keep_good(d, labels.limit(0)).count() == d.count()


def test_every_labelled_document_counts(spark):
    """Documents behind the first 3,000 hashes of their label move the model."""
    ids = spark.range(9000).where("crc32(cast(cast(id as string) as binary)) % 5 <> 0").withColumnRenamed("id", "doc_id")
    labels = ids.selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) AS quality", "0 AS toxic")
    late = [r["doc_id"] for r in ids.where("doc_id % 2 = 0").orderBy(F.xxhash64("doc_id")).offset(3000).collect()]
    assert len(late) > 100
    plain = ids.selectExpr("doc_id", "if(doc_id % 2 = 0, 'Plain words, in order ', 'BUY!! ') || doc_id AS text")
    odd = plain.selectExpr("doc_id", f"if(doc_id in ({', '.join(map(str, late))}), '|||| | ' || doc_id, text) AS text")
    a, b = quality.train(plain, labels), quality.train(odd, labels)
    assert abs(a.mean - b.mean).max() > 1e-4 and abs(a.weights - b.weights).max() > 1e-3


def test_all_pairs_are_fitted():
    rng = np.random.default_rng(3)
    n = len(quality.FEATURES)
    good, bad = rng.normal(size=(70, n)) + 0.3, rng.normal(size=(50, n))
    r = quality.bradley_terry(good, bad, 0.6)
    d = ((good[:, None] - bad[None]) / r.scale).reshape(-1, n)
    w = np.zeros(n)
    for _ in range(30):
        p = 1 / (1 + np.exp(-d @ w))
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(n)
        w += np.linalg.solve(hess, d.T @ (1 - p) / len(d) - 1e-3 * w)
    assert np.abs(w - r.weights).max() < 1e-3
