import math
import re

from posgraph.llm import licenses

from tests.llm.util import docs, documents, lower_ascii, rows, texts

COLS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(pairs):
    """Every alignment of every template, by trying all starts."""
    templates = {}
    for k, label, base, _, word, place, key in licenses.template_rows():
        templates.setdefault(k, (label, base, []))[2].append((word, place, key))
    all_words = [(d, WORD.findall(lower_ascii(t or ""))) for d, t in pairs]
    df = {w: sum(w in set(ws) for _, ws in all_words) for w in licenses.VOCABULARY}
    weight = {w: math.floor(licenses.UNIT * math.log((len(pairs) + 1) / (df[w] + 1))) + 1 for w in df}
    out = []
    for d, ws in all_words:
        places, base_labels, labels, best = [], set(), set(), 0.0
        for label, base, parts in templates.values():
            for start in range(-max(p for _, p, _ in parts), len(ws)):
                ok = [0 <= start + p < len(ws) and ws[start + p] == w for w, p, _ in parts]
                if all(o for o, (_, _, key) in zip(ok, parts, strict=True) if key):
                    score = (sum(weight[w] for o, (w, _, _) in zip(ok, parts, strict=True) if o)
                             / sum(weight[w] for w, _, _ in parts))
                    if base or score >= licenses.ACCEPT:
                        labels.add(label)
                        best = max(best, score)
                        if base:
                            base_labels.add(label)
                            places.append(start)
        out.append((d, len(ws), len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(base_labels)), ",".join(sorted(labels)), best))
    return sorted(out, key=repr)


def test_sample_against_brute_force(spark):
    assert rows(licenses.scan(documents(spark)), *COLS) == brute(list(texts(spark).items()))


def test_phrases_edits_and_odd_rows(spark):
    pairs = [(1, "Licensed under CC-BY 4.0. cc, by; CC BY"), (2, "All rights\nreserved all rights reserved"), (3, None),
             (4, ""), (None, "the GNU General Public License"), (5, "general public licence"), (6, "cc é by"),
             (7, "Licensd under teh Apache License, Version 2.0"), (8, "x " * 50_000 + "cc by"),
             (9, "The MIT License"), (9, "The MIT License"), (10, "\u212Aey cc by"), (11, "by cc by cc by")]
    got = rows(licenses.scan(docs(spark, pairs, clashes=True)), *COLS)
    assert got == brute(pairs)
    by = {r[0]: r for r in got}
    assert by[1][2] == 3 and by[2][2:6] == (2, 0, 3, "reserved") and by[3][1:] == (0, 0, None, None, "", "", 0.0)
    assert by[8][3] == 50_000 and by[11][2] == 2 and by[6][2] == 0 and "apache" in by[7][6]


def test_empty_table(spark):
    assert licenses.scan(docs(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = licenses.scan(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
