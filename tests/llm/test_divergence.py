import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from posgraph.llm import divergence

from tests.llm.util import DOCS, lower_ascii


def brute(rows, min_docs, top):
    """The contract, term by term, on (text, lang, source) rows."""
    counts, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text or ""))
        counts[lang or "", source or ""].update(found)
        langs[lang or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: {t: c[t] for t in kept} for (la, s), c in counts.items() if la == lang}

        def p(c):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}
        shares, q = {s: p(c) for s, c in groups.items()}, p({t: langs[lang][t] for t in kept})
        for s in groups:
            pair = [(h, sum(abs(shares[s][t] - shares[h][t]) for t in kept)) for h in groups if h != s]
            own = [(t, shares[s][t] - q[t]) for t in kept if groups[s][t] and shares[s][t] > q[t]]
            for part, items in (("pair", pair), ("term", own)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def corpus(n=400, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["Ünï", "日本", "ÄB"]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{rng.integers(0, 8)}"
        ranks = np.minimum(rng.geometric(0.08, rng.integers(0, 40)) - 1 + rng.integers(0, 4), len(words) - 1)
        rows.append((" ".join(words[k] for k in ranks).title(), "en" if i % 4 else "de", source))
    return rows + [(None, "en", "empty"), ("", "xx", None), (None, None, "a"), ("only once", None, "b"), ("12 !", "xx", "c"),
                   ("one two", "alone", "z")]


def frame(spark, rows, clashes=False):
    df = spark.createDataFrame([(i, t, la, s, None) for i, (t, la, s) in enumerate(rows)], DOCS)
    if clashes:
        df = df.selectExpr("*", *[f"'x' as {c}" for c in ("term", "n", "docs", "number", "z", "rank", "value", "part", "`a.b`")])
    return df


@pytest.mark.parametrize("cell, rows, clashes", [(1 << 18, 64, False), (7, 2, True), (64, 1, False)])
def test_equals_brute_force_at_any_cell_size(spark, cell, rows, clashes):
    data = corpus()
    got = divergence.audit(frame(spark, data, clashes), min_docs=10, top=5, cell=cell, rows=rows)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute(data, 10, 5)


def test_small_batches_and_pieces_count_the_same(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_PIECE", 16)
    text = b"aa bb " * 50 + b"c" * 100 + b" dd"
    assert b"".join(divergence.pieces(text)) == text
    assert sum(len(divergence._TERM.findall(p)) for p in divergence.pieces(text)) == 102
    assert list(divergence.pieces(b"")) == []


def test_empty_table_and_no_kept_terms(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    got = divergence.audit(frame(spark, [("a b", "en", "x"), ("a c", "en", "y"), (None, None, None)])).collect()
    assert sorted(tuple(r) for r in got) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_accumulators_of_both_ends_add_up():
    rng = np.random.default_rng(0)
    n, terms = 6, 40
    z = rng.integers(1, 9, n)
    p = z[:, None] + rng.integers(1, 50, (n, terms))
    there = rng.random((n, terms)) < 0.4
    full = np.where(there, p, z[:, None])
    size = there.sum(0)
    peer = np.concatenate([np.flatnonzero(there[:, t]) for t in range(terms)])
    flat = np.concatenate([p[there[:, t], t] for t in range(terms)])
    total = np.zeros((n, n), np.int64)
    for lo, hi in ((0, 2), (2, 6)):
        for g, row in divergence.accumulate(lo, hi, terms, z, size, peer, flat):
            total[g] += row
            total[:, g] += row
    for g in range(n):
        for h in range(n):
            if g != h:
                assert total[g, h] == np.abs(full[g] - full[h]).sum()
