import hashlib
import random
import re

import pytest
from checks.compare import duck, rows_of
from posgraph.llm import conversations as C
from posgraph.llm.queries import ORACLE

ROWS = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit) by trying every sequence of edits."""
    best = None

    def go(at, state, cost, audit, inserted):
        nonlocal best
        if at == len(rows) and state in (C.START, C.ASSISTANT):
            best = min(best or (cost, audit), (cost, audit))
        if inserted < 2:
            go(at, C.following(state), cost + 3, audit + "I", inserted + 1)
        if at < len(rows):
            initial, fault = rows[at]
            go(at + 1, state, cost + 4, audit + "D", 0)
            if fault not in (C.BLANK, C.DUPLICATE):
                extra = 3 if fault == C.CUT else 0
                after = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(state)
                if after is not None:
                    go(at + 1, after, cost + extra, audit + "K", 0)
                go(at + 1, C.following(state), cost + 3 + extra, audit + "R", 0)
    go(0, C.START, 0, "", 0)
    return best


def chained(rows, size):
    parts = [rows[i:i + size] for i in range(0, len(rows), size)]
    names = ("before", "goal", "cost", "audit")
    return C.chain([dict(zip(names, f, strict=True)) for f in C.solve(p, i == 0, i == len(parts) - 1)]
                   for i, p in enumerate(parts))


def test_search_finds_the_cheapest_and_ascii_least():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(rng.choice(["s", "u", "a", "a", "u", "x", ""]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(6))]
        assert C.search(rows, C.START, C.DONE) == cheapest(rows), rows


def test_segments_chain_to_the_same_audit():
    rng = random.Random(6)
    for _ in range(60):
        rows = [(rng.choice("suaau"), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 60))]
        whole = C.search(rows, C.START, C.DONE)
        assert chained(rows, rng.randrange(1, 20)) == whole
    assert C.search([("u", 0)] * 3000, C.START, C.DONE) == chained([("u", 0)] * 3000, C.SEGMENT)


def test_known_repairs():
    none, cut, blank = C.NONE, C.CUT, C.BLANK
    assert C.search([], C.START, C.DONE) == (0, "")
    assert C.search([("s", none)], C.START, C.DONE) == (4, "D")
    assert C.search([("u", none), ("a", none)], C.START, C.DONE) == (0, "KK")
    assert C.search([("u", none)], C.START, C.DONE) == (3, "KI")
    assert C.search([("a", none), ("u", none)], C.START, C.DONE) == (6, "IKKI")
    assert C.search([("u", cut), ("a", blank)], C.START, C.DONE) == (8, "DD")


def odd_rows():
    return [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello!"), (1, 1, "assistant", "Hello!"), (1, 4, "user", "cut off"),
            (2, None, None, None), (2, None, "tool", "x."), (2, 3, "assistant", " \t\n"), (None, 0, "user", "A?"), (None, 1, "assistant", "B."),
            (3, None, "system", "S."), (3, None, "system", "S."), (4, 7, "", "日本。"), (4, 9, "user", "Bye.\r\n"),
            *[(5, k, "user" if k % 3 else "assistant", f"t{k}.") for k in range(40)]]


def reference(rows, ids):
    """The contract in plain Python on rows after damage."""
    out = []
    for conv in ids:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in own:
            tail = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append(C.BLANK if not tail else C.DUPLICATE if (role, text) in seen else C.CUT if tail[-1] not in ".!?" else C.NONE)
            seen.add((role, text))
        cost, audit = C.search([(r[:1], f) for (_, r, _), f in zip(own, faults, strict=True)], C.START, C.DONE)
        new = "\n".join(f"{r}:{x}" for r, x in C.rewrite(audit, iter([(r, x) for _, r, x in own])))
        known = [t for t, _, _ in own if t is not None]
        pairs = zip(own, own[1:], strict=False)
        out.append((conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, *[faults.count(k) for k in (1, 2, 3)],
                    sum((a[1][:1], b[1][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in pairs), cost, audit,
                    hashlib.sha256(new.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("segment", [3, C.SEGMENT])
def test_repair_of_odd_rows(spark, monkeypatch, segment):
    monkeypatch.setattr(C.audits, "__defaults__", (segment,))
    rows = odd_rows()
    clash = ", ".join(f"{c} string" for c in ("key", "at", "fault", "audit", "code", "col", "`a.b`"))
    df = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], f"{ROWS}, {clash}")
    ids = spark.createDataFrame([(c,) for c in (1, 2, 3, 4, 5, 6, None)], "conv_id long").selectExpr(
        "conv_id", "0L as turn", "'user' as role", "'' as text")
    got = sorted((tuple(r) for r in C.repair(df, ids).collect()), key=repr)
    assert got == reference(rows, [1, 2, 3, 4, 5, 6, None])


def test_repaired_turns_are_well_formed(spark):
    df = spark.createDataFrame(odd_rows(), ROWS)
    turns = {}
    for r in C.repaired_turns(df).orderBy("conv_id", "place").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    digests = {r["conv_id"]: r["repaired_sha256"] for r in C.repair(df).collect()}
    for conv, digest in digests.items():
        new = turns.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in new))
        assert hashlib.sha256("\n".join(f"{r}:{x}" for r, x in new).encode()).hexdigest() == digest


def test_empty_table(spark):
    none = spark.createDataFrame([], ROWS)
    assert C.repair(C.damage(none), none).collect() == [] and C.repaired_turns(none).collect() == []


def test_sql_with_nulls_and_ties(spark, tmp_path):
    """The oracle's SQL on odd rows with every kind of damage."""
    rows = odd_rows() + [(k, t, ("user", "assistant", None)[t % 3], f"x{k % 5}.") for k in range(100, 160) for t in range(6)]
    df = spark.createDataFrame(rows, ROWS)
    con = duck("/root/testdata/sf0.001")
    con.register("odd", df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    con.sql("CREATE OR REPLACE TEMP VIEW conversations AS SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, "
            "CAST(role AS VARCHAR) AS role, CAST(text AS VARCHAR) AS text FROM odd")
    rel = con.sql(ORACLE["op13_conversations"])
    got = C.repair(C.damage(df), df)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(rel.columns, rel.fetchall())
