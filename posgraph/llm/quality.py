"""Operator 10: quality classifier by Bradley-Terry pairwise ranking.

A document's score is ``w . x`` on surface statistics ``x`` of its whole text.
``w`` is learned from preference pairs (a document labelled 1 is preferred to
one labelled 0) by logistic loss on the feature differences: the Bradley-Terry
model P(i beats j) = sigmoid(w . (x_i - x_j)).  All pairs of all labelled
documents outside the held-out fold count; none is listed.  What a document
meets on the other side depends on its own score alone, so each Newton step
takes two sums over the stored features: the other side's mass and feature sums
on a grid of scores, then gradient and Hessian with the grid's values
interpolated at every document's score.  The grid's spacing bounds the error of a
pair's probability (h * h / 80, about 1e-4 for scores 100 apart).  The cut has the
fewest errors over all training scores (of ``CUTS`` evenly spaced ones), and the
reported score is a sigmoid placed so that the cut falls on 0.3.

Rows: every input row gives one row.  A null or empty text has all-zero
features and is scored like any other.  A null ``doc_id`` is carried through
(``held_out`` null).  Labels of documents with contradicting labels, null
labels or null ids are not learned from; a document id on several rows is one
training example.  Without both labels every score is 0.5.  Ties in score need
no rule (a document is judged by its own score alone).  Extra columns are
ignored by ``score`` and carried through by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posgraph.llm.common import id_mod, may_contain, stored

GRID = 1024     # places of the score grid on which the two labels meet
CUTS = 1 << 14  # places tried for the cut
CUT = 0.3
HELD_OUT = 5

FEATURES = ("log_bytes", "upper", "digit", "space", "symbol", "bang", "bar", "newline", "comma_dot",
            "word_len", "distinct_words", "distinct_lines", "symbol_root", "upper_root", "bar_root")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*+/<=>@\\^_`{|}~!")] = True


def features(text: str | None) -> np.ndarray:
    """Surface statistics of one whole text."""
    out = np.zeros(len(FEATURES))
    if not text:
        return out
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = len(data)
    c = np.bincount(data, minlength=256) / n
    words, lines = text.split(), text.split("\n")
    symbol, upper = c[_SYMBOL].sum(), c[65:91].sum()
    out[:9] = (np.log1p(n), upper, c[48:58].sum(), c[32], symbol, c[33], c[124], c[10], c[44] + c[46])
    if words:
        out[9] = min(n / len(words), 50.0) / 10
        out[10] = len(set(words)) / len(words)
    out[11] = len(set(lines)) / len(lines)
    out[12:] = np.sqrt((symbol, upper, c[124]))
    return out


@dataclass
class Ranker:
    """Weights, feature scaling and the cut; picklable and a few hundred bytes."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    cut: float
    width: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(x), 0.5)
        z = (self.raw(x) - self.cut) / self.width + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


Total = Callable[..., np.ndarray]  # total(f, how): f(q, x) over all training rows, summed (or the largest values)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _on_grid(s: np.ndarray, lo: float, h: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The grid place below each score and the share of the place above."""
    at = np.clip((s - lo) / h, 0, n - 1 - 1e-9)
    j = at.astype(np.int64)
    return j, at - j


def _spread(j: np.ndarray, f: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``v`` on the grid, each value shared by the two places around its score."""
    return np.bincount(j, (1 - f) * v, n) + np.bincount(j + 1, f * v, n)


def _newton_step(total: Total, r: Ranker, box: np.ndarray, pairs: float, ridge: float) -> np.ndarray:
    """One Newton step of the logistic loss over all pairs (good, bad) of the training rows."""
    w, k = r.weights, len(r.weights)
    ends = w * (box - r.mean) / r.scale  # the scores' range follows from that of each feature
    lo, hi = ends.min(0).sum(), ends.max(0).sum()
    h = max((hi - lo) / (GRID - 1), 1e-9)

    def met(q, x):
        z = (x - r.mean) / r.scale
        j, f = _on_grid(z @ w, lo, h, GRID)
        bad = q == 0
        return np.concatenate([_spread(j[~bad], f[~bad], np.ones((~bad).sum()), GRID)]
                              + [_spread(j[bad], f[bad], v, GRID) for v in (np.ones(bad.sum()), *z[bad].T)])
    sums = total(met).reshape(k + 2, GRID)
    n_good, n_bad, z_bad = sums[0], sums[1], sums[2:].T
    place = lo + h * np.arange(GRID)
    lost = _sigmoid(place[None, :] - place[:, None])  # of a good row at i against a bad one at j
    var = lost * (1 - lost)
    of_good = np.column_stack([lost @ n_bad, var @ n_bad, var @ z_bad])
    of_bad = np.column_stack([n_good @ lost, n_good @ var])

    def slopes(q, x):
        z = (x - r.mean) / r.scale
        j, f = _on_grid(z @ w, lo, h, GRID)
        f = f[:, None]
        good, bad = q == 1, q == 0
        g = (of_good[j] * (1 - f) + of_good[j + 1] * f)[good]
        b = (of_bad[j] * (1 - f) + of_bad[j + 1] * f)[bad]
        zg, zb = z[good], z[bad]
        cross = zg.T @ g[:, 2:]
        hess = (zg * g[:, 1:2]).T @ zg + (zb * b[:, 1:2]).T @ zb - cross - cross.T
        return np.concatenate([zg.T @ g[:, 0] - zb.T @ b[:, 0], hess.ravel()])
    sums = total(slopes) / pairs
    return np.linalg.solve(sums[k:].reshape(k, k) + ridge * np.eye(k), sums[:k] - ridge * w)


def fit(total: Total, good_share: float | None = None, ridge: float = 1e-3) -> Ranker:
    """Bradley-Terry over all pairs of the training rows that ``total`` runs over.

    The cut has the fewest errors, weighted by ``good_share`` (that of the rows without it).
    """
    k = len(FEATURES)
    sums = total(lambda q, x: np.concatenate([[(q == 1).sum(), (q == 0).sum()], x.sum(0)]))
    n_good, n_bad = sums[:2]
    r = Ranker(np.zeros(k), np.zeros(k), np.ones(k), 0.0, 1.0)
    if not n_good or not n_bad:
        return r
    n = n_good + n_bad
    mean = r.mean = sums[2:] / n
    r.scale = np.sqrt(total(lambda q, x: ((x - mean) ** 2).sum(0)) / n) + 1e-9
    top = total(lambda q, x: np.concatenate([x.max(0), -x.min(0)]), "max")
    box = np.stack([-top[k:], top[:k]])
    for _ in range(40):
        step = _newton_step(total, r, box, n_good * n_bad, ridge)
        r.weights = r.weights + step / max(1.0, np.linalg.norm(step) / 5)
        if np.abs(step).max() < 1e-4 * max(1.0, np.abs(r.weights).max()):
            break
    r.weights = np.round(r.weights, 9)  # sums may differ in their last digits with the order of the tasks
    top = total(lambda q, x: np.array([r.raw(x).max(), -r.raw(x).min()]), "max")
    lo, h = -top[1], max((top[0] + top[1]) / (CUTS - 1), 1e-9)

    def counts(q, x):
        s = r.raw(x)
        j = np.clip((s - lo) / h, 0, CUTS - 1).astype(np.int64)
        return np.concatenate([[s.sum(), (s * s).sum()], np.bincount(j[q == 1], minlength=CUTS), np.bincount(j[q == 0], minlength=CUTS)])
    sums = total(counts)
    g, b = sums[2:].reshape(2, CUTS)
    share = n_good / n if good_share is None else good_share
    errors = share * (np.cumsum(g) - g) / n_good + (1 - share) * (n_bad - (np.cumsum(b) - b)) / n_bad
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    r.cut = float(lo + h * best[len(best) // 2])
    r.width = float(max(np.sqrt(max(sums[1] / n - (sums[0] / n) ** 2, 0.0)) / 3, 1e-9))
    return r


def bradley_terry(good: np.ndarray, bad: np.ndarray, good_share: float | None = None, ridge: float = 1e-3) -> Ranker:
    """``fit`` on two arrays of features."""
    q = np.repeat([1, 0], [len(good), len(bad)])
    x = np.concatenate([good, bad])
    return fit(lambda f, how="sum": f(q, x), good_share, ridge)


def _total_of(rows: DataFrame) -> Total:
    """``total`` over the rows (q, x): one vector of fixed size a task (at most 140 kB), added up by one more task."""
    def total(f, how: str = "sum") -> np.ndarray:
        add = np.maximum if how == "max" else np.add

        def added(vectors):
            out = None
            for v in vectors:
                out = v if out is None else add(out, v)
            if out is not None:
                yield pa.RecordBatch.from_pydict({"v": pa.array([out.tobytes()], pa.binary())})

        def part(batches):
            return added(f(b.column("q").to_numpy(), b.column("x").flatten().to_numpy().reshape(-1, len(FEATURES)))
                         for b in batches if b.num_rows)

        def whole(batches):
            return added(np.frombuffer(v.as_py(), np.float64) for b in batches for v in b.column("v"))
        vectors = rows.mapInArrow(part, "v binary").repartition(1).mapInArrow(whole, "v binary").collect()
        return np.frombuffer(vectors[0]["v"], np.float64) if vectors else np.zeros(2 + len(FEATURES))
    return total


def _feature_udf():
    @F.pandas_udf("array<double>")
    def feats(text: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in text])
    return feats


def train(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Learn from all labelled documents outside the held-out fold.

    Their features are a scratch table (some 130 bytes a document) that every
    step reads; the driver sees sums of a fixed size.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)
                          & (id_mod("doc_id", HELD_OUT) != 0))
             .groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q2"))
             .where("q = q2").select("doc_id", F.col("q").cast("int").alias("q")))
    # Only features meet the labels in a shuffle; texts without a label stay out of it.
    mine = may_contain(docs.select("doc_id", "text"), F.col("doc_id"), known.select("doc_id")).where("_may")
    rows = (mine.select("doc_id", _feature_udf()("text").alias("x")).join(known, "doc_id")
            .groupBy("doc_id", "q").agg(F.min("x").alias("x")).select("q", "x"))
    return fit(_total_of(stored(rows, "quality-features")))


def scorer(model: Ranker):
    """A column function: text -> score in 0..1."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        if not len(text):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.stack([features(t) for t in text])))
    return score


def score(docs: DataFrame, model: Ranker) -> DataFrame:
    s: Column = F.col("score")
    return (docs.select("doc_id", (id_mod("doc_id", HELD_OUT) == 0).alias("held_out"),
                        scorer(model)("text").alias("score"))
            .withColumn("predicted", F.when(s >= CUT, 1).otherwise(0)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected (score below the cut), with their columns."""
    return docs.where(scorer(train(docs, labels))("text") >= F.lit(CUT))
