"""Operator 2: language identification by error-correcting output codes.

Every language gets a binary codeword.  One linear classifier per code bit,
on hashed byte n-grams (1 to 3 bytes) of the lower-cased whole text, predicts
that bit.  Loss-weighted decoding picks the language whose codeword has the
smallest total exponential loss over the bit margins, each bit weighted by its
training accuracy; a text whose best two losses lie close together is flagged
ambiguous.

Rows: every input row gives one row; a null text or one without a letter is
``und`` with score 0.  A null ``doc_id`` is carried through (``held_out``
null) and never learned from.  Ties go to the alphabetically first language.
With no labelled text everything is ``und``; with one language, everything
with a letter is that language.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posgraph.llm.common import id_mod

DIMS = 1 << 11
TRAIN_PER_LANG = 400   # bounds on the texts learned from, per language
TRAIN_TOTAL = 4000     # and in all, but one of every language at least
UNKNOWN = "und"
_BLOCK = 1 << 18       # bytes of a text looked at together
HELD_OUT_REST = 2
MARGIN = 0.15          # relative loss gap below which a decision is ambiguous
LETTER = r"\p{L}"      # one rule for learning and predicting
_LETTER = regex.compile(LETTER)


def ngrams(text: str) -> np.ndarray:
    """Length-normalised root counts of hashed 1-, 2- and 3-byte grams of a whole text."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(DIMS, np.float32)
    for at in range(0, len(data), _BLOCK):  # grams that begin in this block
        a = data[at:at + _BLOCK + 2].astype(np.uint32)
        counts += np.bincount(a[:_BLOCK] & 255, minlength=DIMS)
        two = (a[:-1] * np.uint32(40503) + a[1:] * np.uint32(2654435761)) * np.uint32(2246822519)
        counts += np.bincount(two[:_BLOCK] >> np.uint32(21), minlength=DIMS)
        three = (two[:-1] ^ (a[2:] * np.uint32(3266489917))) * np.uint32(668265263)
        counts += np.bincount(three[:_BLOCK] >> np.uint32(21), minlength=DIMS)
    v = np.sqrt(counts)
    return v / max(float(np.linalg.norm(v)), 1e-9)


def codewords(n: int) -> np.ndarray:
    """``n`` rows of +-1: every split of up to 5 languages, random splits beyond."""
    if n <= 5:
        bits = [[1 if (m >> k) & 1 else -1 for k in range(n)] for m in range(1, 1 << max(n - 1, 0))]
        return np.array(bits, np.float64).reshape(-1, n).T
    rng, width = np.random.default_rng(3), int(np.ceil(10 * np.log2(n)))
    code = np.where(rng.random((n, width)) < 0.5, -1.0, 1.0)
    code[rng.integers(0, n, width), np.arange(width)] *= -1
    flat = np.abs(code.sum(0)) == n
    code[0, flat] *= -1
    return code


@dataclass
class Codebook:
    langs: list[str]
    code: np.ndarray      # language x bit
    weights: np.ndarray   # dimension x bit
    bias: np.ndarray
    bit_weight: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, ambiguous) by loss-weighted decoding."""
        margin = np.clip(x @ self.weights + self.bias, -8, 8)
        loss = (self.bit_weight * np.exp(-margin[:, None, :] * self.code)).sum(2)
        order = np.argsort(loss, axis=1, kind="stable")
        best = order[:, 0]
        low = np.take_along_axis(loss, order[:, :1], 1)
        p = np.exp(-(loss - low) / max(float(self.bit_weight.sum()), 1e-9))
        gap = np.ones(len(x))
        if loss.shape[1] > 1:
            second = np.take_along_axis(loss, order[:, 1:2], 1)
            gap = ((second - low) / np.maximum(second, 1e-12))[:, 0]
        return best, 1 / p.sum(1), gap < MARGIN


def fit(x: np.ndarray, langs: list[str]) -> Codebook:
    """Logistic regression per code bit (full-batch gradient with momentum) on the bounded sample."""
    names = sorted(set(langs))
    code = codewords(len(names)) if names else np.zeros((0, 0))
    bits = code.shape[1]
    w, b = np.zeros((DIMS, bits), np.float32), np.zeros(bits, np.float32)
    if not bits:
        return Codebook(names, code, w, b, np.ones(bits))
    y = code[[names.index(s) for s in langs]].astype(np.float32)
    mean = x.mean(0)
    xc = x - mean
    vw, vb, n, rate = np.zeros_like(w), np.zeros_like(b), len(x), 20.0
    for _ in range(200):
        g = y / (1 + np.exp(np.clip(y * (xc @ w + b), -30, 30)))
        vw = 0.9 * vw + rate * (xc.T @ g / n - 1e-5 * w)
        vb = 0.9 * vb + 0.2 * g.mean(0)
        w, b = w + vw, b + vb
    accuracy = ((xc @ w + b) * y > 0).mean(0)
    return Codebook(names, code, w, b - mean @ w, np.maximum(accuracy - 0.5, 0.01) / 0.5)


def _gram_udf():
    @F.pandas_udf("binary")
    def grams(text: pd.Series) -> pd.Series:
        return pd.Series([ngrams(t).tobytes() for t in text])
    return grams


def train(docs: DataFrame) -> Codebook:
    """Learn from a hash sample of the labelled texts with a letter, outside the held-out fold.

    At most ``TRAIN_PER_LANG`` texts a language and ``TRAIN_TOTAL`` in all (but one
    of every language); the feature vectors of that sample (8 kB each) are all
    the driver receives.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(LETTER)
                       & (id_mod("doc_id", 4) != HELD_OUT_REST))
    langs = known.select("lang").distinct().count()
    if not langs:
        return fit(np.zeros((0, DIMS), np.float32), [])
    per = max(1, min(TRAIN_PER_LANG, TRAIN_TOTAL // langs))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit("lang")), "doc_id")
    ids = (known.select("doc_id", "lang").distinct().withColumn("rn", F.row_number().over(order))
           .where(F.col("rn") <= per).select("doc_id", "lang"))
    if langs <= TRAIN_TOTAL:
        ids = F.broadcast(ids)  # at most TRAIN_TOTAL ids
    rows = (known.select("doc_id", "lang", "text").join(ids, ["doc_id", "lang"])
            .select("doc_id", "lang", _gram_udf()("text").alias("x"))
            .groupBy("doc_id", "lang").agg(F.min("x").alias("x")).orderBy("lang", "doc_id").collect())
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(-1, DIMS)
    return fit(x, [r["lang"] for r in rows])


def predictor(book: Codebook):
    """A column function: text -> (lang_pred, score, ambiguous)."""
    names = book.langs

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(text: pd.Series) -> pd.DataFrame:
        lang, score, unsure = [UNKNOWN] * len(text), np.zeros(len(text)), np.ones(len(text), bool)
        known = [i for i, t in enumerate(text) if t and names and _LETTER.search(t)]
        for at in range(0, len(known), 1000):
            part = known[at:at + 1000]
            best, p, close = book.decode(np.stack([ngrams(text.iat[i]) for i in part]))
            for i, k in zip(part, best, strict=True):
                lang[i] = names[k]
            score[part], unsure[part] = p, close
        return pd.DataFrame({"lang_pred": lang, "score": score, "ambiguous": unsure})
    return predict


def identify(docs: DataFrame, book: Codebook) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous."""
    return (docs.select("doc_id", predictor(book)("text").alias("p"))
            .select("doc_id", (id_mod("doc_id", 4) == HELD_OUT_REST).alias("held_out"), "p.*"))
