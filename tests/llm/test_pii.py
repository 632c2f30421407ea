import hashlib
import random
import re

from posgraph.llm import pii

from tests.llm.util import docs, documents, rows, texts

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
COLS = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub(r"[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits or "1"), "phone": 8 <= len(digits) <= 15}[kind]


def brute(pairs):
    out = []
    for d, t in pairs:
        found = [[m for m in re.finditer(p, t or "") if valid(k, m.group())] for k, p in PATTERNS.items()]
        spans = [f"{k}:{m.start()}:{m.end()}" for k, ms in zip(PATTERNS, found, strict=True) for m in ms]
        out.append((d, *map(len, found), hashlib.sha256(",".join(spans).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_sample_against_brute_force(spark):
    assert rows(pii.scan(documents(spark)), *COLS) == brute(texts(spark).items())


def test_random_strings_of_the_patterns_own_characters(spark):
    rng = random.Random(4)
    pieces = ["a", "B7", "@", ".", "-", "_", "%", "+", " ", "  ", "(", ")", "1", "25", "256", "255.1", "4111111111111111",
              "x.y@z.com", "1.2.3.4", "+1 (555) 123-4567", "é", "😀", "\n", "0012", "@b.c", "4111 1111-1111 1111", "99999"]
    pairs = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40)))) for i in range(1500)]
    assert rows(pii.scan(docs(spark, pairs)), *COLS) == brute(pairs)


def test_nulls_long_runs_repeated_and_clashing(spark):
    pairs = [(1, None), (2, ""), (None, "me@host.org"), (3, "1" * 40_000), (4, "a" * 40_000 + "@x" + ".y" * 20_000),
             (5, "+" + "1 " * 30_000), (6, "1.2.3.4 " * 3_000), (7, "a@b.c_d@e.f"), (7, "a@b.c_d@e.f")]
    df = pii.scan(docs(spark, pairs, clashes=True))
    assert rows(df, *COLS) == brute(pairs)
    assert {r["spans"] for r in df.where("doc_id = 7").collect()} == {"email:0:5,email:5:11"}


def test_secrets_are_added_and_words_are_not(spark):
    key = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f"
    pairs = [(i, f'plain text {i} token = "{key[i % 20:]}{key[:i % 20]}" more') for i in range(30)]
    pairs += [(100 + i, f"see folder/some-very-long-identifier-name-{i} and averyveryverylongordinaryword{i}") for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in pii.scan(docs(spark, pairs)).collect()}
    assert all(got[i] == f"secret:{20 + len(str(i)) + 1}:{20 + len(str(i)) + 41}" for i in range(30)), got[0]
    assert all(not got[100 + i] for i in range(30))


def test_reliability_estimates_separate_the_classes():
    names = list(pii.FEATURES)
    yes = dict.fromkeys(names, False) | {"hex": True, "gazetteer": True, "assigned": True, "digits": True, "long": True}
    no = dict.fromkeys(names, False) | {"address": True}
    w = pii.estimate([(yes, 50), (no, 200), (yes | {"gazetteer": False}, 10)])

    def z(f):
        return w["bias"] + sum(w[k] for k in names if f[k])
    assert z(yes) > 0 > z(no)


def test_empty_table(spark):
    assert pii.scan(docs(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = pii.scan(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_digits_late_in_a_run(spark):
    """A run is a candidate wherever its first digit stands."""
    late, none = "Ab" * 225 + "9x7Y3", "Ab" * 300
    pairs = [(i, f'token = "{late}{i}"') for i in range(30)] + [(100, f'token = "{none}"')]
    got = {r["doc_id"]: (r["spans"], r["n_secret"]) for r in pii.scan(docs(spark, pairs)).collect()}
    assert got[3] == (f"secret:9:{9 + len(late) + 1}", 1) and got[100] == ("", 0)
