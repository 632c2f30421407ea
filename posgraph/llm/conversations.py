"""Operator 13: repair of conversation structure by depth-first branch and bound.

A well-formed conversation is empty or an optional system turn followed by
user-assistant pairs, by the initials of the roles: ``(s?(ua)+)?``.  Rows are taken by
turn (null first; equal turns by role, then by the digest of the text).  A
row's first fault counts: blank (no character but ``[\\x20\\x09-\\x0D]``), duplicate
(same role and text earlier), truncated (last other character not ``[.!?]``).
Edits: Keep costs 0, Rerole to user or assistant 3, Delete 4 (blank and
duplicate rows must go), Insert an empty user or assistant turn 3; a truncated row that
stays adds 3.  The cheapest edits win, of equally cheap ones the ASCII-least
string of initials (the audit), which fixes the repaired turns.

1. Faults and places are found by Spark on light rows (digest instead of text).
2. Every ``SEGMENT`` rows of a conversation are one search, so a conversation
   with a large share of all rows is spread over tasks.  ``search`` goes depth first
   with an explicit stack.  A node is (row, what the last role was); its
   suffix bound is the least cost of the rest from there.  Nodes that cannot
   beat the incumbent (cost, audit) are left, as are nodes that a prefix at
   least as good has reached before (one dominance table entry per node; equally
   cheap prefixes of one node are never prefixes of each other, so their order is
   that of the completed audits).  Children go cheapest bound first, then in
   ASCII order; the search ends when the stack is empty, that is with a proof.
3. Searches that begin or end inside a conversation are made for every role
   that may come before and after; chaining the segments keeps the best (cost,
   audit) per last role.
4. A last pass streams the texts of each conversation in order past its audit
   (a running digest; memory for the audit, not the texts).

Rows: null role and text count as one space.  Null ``conv_id`` is a
conversation of its own, null turns count in no gap.  Repeated rows are
duplicates.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posgraph.llm.common import stored

SEGMENT = 256
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)  # what the last role was
DONE = 4                                   # the goal of a conversation's last segment
_BLANKS = " \t\n\x0b\x0c\r"
NONE, BLANK, DUPLICATE, CUT = range(4)     # faults
Row = tuple[str, int]                      # initial of the role, fault


# ------------------------------------------------------------- the search

def following(state: int) -> int:
    """The last role after an inserted or rewritten turn: the only one that fits."""
    return ASSISTANT if state == USER else USER


def kept(state: int, initial: str) -> int | None:
    """The last role after a kept turn, None where it does not fit."""
    if initial == "s":
        return SYSTEM if state == START else None
    return following(state) if initial == ("a" if state == USER else "u") else None


def edits(row: Row, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, last role) of the edits that use up a row, in ASCII order."""
    initial, fault = row
    out = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        extra = TRUNCATED if fault == CUT else 0
        if (after := kept(state, initial)) is not None:
            out.append(("K", KEEP + extra, after))
        out.append(("R", REROLE + extra, following(state)))
    return out


def suffix_bounds(rows: list[Row], goal: int) -> list[list[float]]:
    """For every place and last role the least cost of reaching the goal from there, audits aside."""
    ends = [0, 2 * INSERT, INSERT, 0] if goal == DONE else [0 if s == goal else math.inf for s in range(4)]
    bounds: list[list[float]] = [ends]
    for row in reversed(rows):
        rest = bounds[-1]
        use = [min(cost + rest[after] for _, cost, after in edits(row, s)) for s in range(4)]
        one = [min(use[s], INSERT + use[following(s)]) for s in range(4)]
        bounds.append([min(use[s], INSERT + one[following(s)]) for s in range(4)])
    return bounds[::-1]


def search(rows: list[Row], state: int, goal: int) -> tuple[int, str] | None:
    """The cheapest (cost, audit) from a last role to the goal, None if there is none."""
    bounds, n = suffix_bounds(rows, goal), len(rows)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, state, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        low = cost + bounds[at][state]
        if low == math.inf or best and (low > best[0] or low == best[0] and audit > best[1][:len(audit)]):
            continue
        if (at, state) in reached and reached[at, state] <= (cost, audit):
            continue
        reached[at, state] = cost, audit
        if at == n and (state in (START, ASSISTANT) if goal == DONE else state == goal):
            if best is None or (cost, audit) < best:
                best = cost, audit
            continue
        children = [(cost + c, "I", at, s) for c, s in [(INSERT, following(state))] if at < n or goal == DONE]
        if at < n:
            children += [(cost + c, letter, at + 1, s) for letter, c, s in edits(rows[at], state)]
        children.sort(key=lambda x: (x[0] + bounds[x[2]][x[3]], x[1]), reverse=True)
        stack += [(place, s, c, audit + letter) for c, letter, place, s in children]
    return best


def solve(rows: list[Row], first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(role before, goal, cost, audit) of a segment for every role before it and every goal."""
    out = []
    for before in [START] if first else range(4):
        for goal in [DONE] if last else range(4):
            found = search(rows, before, goal)
            if found:
                out.append((before, goal, *found))
    return out


def chain(segments: Iterator[list[dict]]) -> tuple[int, str]:
    """The cheapest (cost, audit) of a whole conversation from its segments in order."""
    best = {START: (0, "")}
    for found in segments:
        after: dict[int, tuple[int, str]] = {}
        for f in found:
            if f["before"] in best:
                cost, audit = best[f["before"]]
                option = cost + f["cost"], audit + f["audit"]
                after[f["goal"]] = min(after.get(f["goal"], option), option)
        best = after
    return best[DONE]


def rewrite(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) turns of a conversation."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "K":
            state = kept(state, role[:1])
        elif edit != "D":
            state = following(state)
            role = "user" if state == USER else "assistant"
        if edit != "D":
            yield role, text


# ------------------------------------------------------------- Spark

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows after the damage that crc32(conv_id:turn) % 20 chooses."""
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.expr("sequence(1, if(code = 3, 2, 1))"))
    return rows.where("code <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("col")


def turns(rows: DataFrame) -> DataFrame:
    """key, at, turn, initial, fault, last, illegal of every keyed row: its place, first fault and neighbours (stored)."""
    trimmed = F.rtrim(F.col("text"), F.lit(_BLANKS))
    light = rows.select("key", "turn", "role", F.sha2("text", 256).alias("digest"), (trimmed == "").alias("blank"),
                        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    first = F.row_number().over(Window.partitionBy("key", "role", "digest").orderBy(F.asc_nulls_first("turn")))
    fault = F.when(F.col("blank"), BLANK).when(F.col("seen") > 1, DUPLICATE).when(F.col("cut"), CUT).otherwise(NONE)
    order = Window.partitionBy("key").orderBy(F.asc_nulls_first("turn"), "role", "digest", "seen")  # equal rows: first the one seen first
    initial = F.substring("role", 1, 1)
    before = F.lag(initial).over(order)
    legal = F.concat_ws(">", before, initial).isin("s>u", "u>a", "a>u")
    placed = light.withColumn("seen", first).select(
        "key", "turn", initial.alias("initial"), fault.alias("fault"), (F.row_number().over(order) - 1).alias("at"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"), (before.isNotNull() & ~legal).alias("illegal"))
    return stored(placed, "turns")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(some, schema)


_FOUND = pa.schema([("key", pa.string()), ("segment", pa.int64()), ("found", pa.list_(pa.struct(
    [("before", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
_AUDIT = pa.schema([("key", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
_DIGEST = pa.schema([("key", pa.string()), ("repaired_sha256", pa.string())])
_TURN = pa.schema([("key", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The solutions of every segment; rows come sorted by (key, segment, at)."""
    def segments() -> Iterator[dict]:
        for (key, segment), rows in groupby(_rows(batches), itemgetter("key", "segment")):
            held = list(rows)  # at most SEGMENT
            found = solve([(r["initial"], r["fault"]) for r in held], segment == 0, held[-1]["last"])
            names = ("before", "goal", "cost", "audit")
            yield {"key": key, "segment": segment, "found": [dict(zip(names, f, strict=True)) for f in found]}
    yield from _batches(segments(), _FOUND)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit of every conversation; rows come sorted by (key, segment)."""
    def conversations() -> Iterator[dict]:
        for key, rows in groupby(_rows(batches), itemgetter("key")):
            cost, audit = chain(r["found"] for r in rows)
            yield {"key": key, "cost": cost, "audit": audit}
    yield from _batches(conversations(), _AUDIT)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[tuple[str, str]]]]:
    """(key, repaired turns) of every conversation; its audit comes before its rows."""
    for key, rows in groupby(_rows(batches), itemgetter("key")):
        yield key, rewrite(next(rows)["audit"], ((r["role"], r["text"]) for r in rows))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def conversations() -> Iterator[dict]:
        for key, repaired in _repaired(batches):
            digest = hashlib.sha256()
            for i, (role, text) in enumerate(repaired):
                digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
            yield {"key": key, "repaired_sha256": digest.hexdigest()}
    yield from _batches(conversations(), _DIGEST)


def _repaired_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    repaired = ({"key": key, "place": i, "role": role, "text": text}
                for key, new in _repaired(batches) for i, (role, text) in enumerate(new))
    yield from _batches(repaired, _TURN)


def keyed(rows: DataFrame) -> DataFrame:
    """The rows with ``key``, the conversation's id as text (empty for null), and no null role or text."""
    return rows.select("conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
                       "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])


def audits(placed: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """key, cost, audit of every conversation (stored)."""
    parts = (placed.select("key", "at", "initial", "fault", "last", F.expr(f"cast(at div {segment} as long)").alias("segment"))
             .repartition("key", "segment").sortWithinPartitions("key", "segment", "at"))
    found = parts.mapInArrow(_solve, "key string, segment long, found array<struct<before:int,goal:int,cost:bigint,audit:string>>")
    whole = found.repartition("key").sortWithinPartitions("key", "segment")
    return stored(whole.mapInArrow(_chain, "key string, cost long, audit string"), "audits")


def _beside(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Every conversation's audit and, after it, its rows in order."""
    none = F.lit(None)
    both = audit.select("key", F.lit(False).alias("row"), none.cast(rows.schema["turn"].dataType).alias("turn"),
                        none.cast("string").alias("role"), none.cast("string").alias("text"), "audit").unionAll(
        rows.select("key", F.lit(True).alias("row"), "turn", "role", "text", none.cast("string").alias("audit")))
    return both.repartition("key").sortWithinPartitions("key", "row", F.asc_nulls_first("turn"), "role", F.sha2("text", 256))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place, role, text: the repaired conversations."""
    rows = keyed(rows)
    new = _beside(rows, audits(turns(rows))).mapInArrow(_repaired_turns, "key string, place long, role string, text string")
    return new.select(F.expr("nullif(substring(key, 2), '')").cast(rows.schema["conv_id"].dataType).alias("conv_id"),
                      "place", "role", "text")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    One row per ``conv_id`` of ``conversations`` (by default of ``rows``); one that
    has no rows gets zeros, an empty audit and the digest of nothing.
    """
    ids = keyed(conversations if conversations is not None else rows).select("conv_id", "key").distinct()
    rows = keyed(rows)
    placed = turns(rows)
    audit = audits(placed)
    digests = stored(_beside(rows, audit).mapInArrow(_digests, "key string, repaired_sha256 string"), "digests")
    spread = F.max("turn") - F.min("turn") + 1 - F.sum("new")
    once = placed.groupBy("key", "turn").agg(
        *[F.sum((F.col("fault") == k).cast("long")).alias(n) for n, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))],
        F.sum(F.col("illegal").cast("long")).alias("illegal")).withColumn("new", F.col("turn").isNotNull().cast("long"))
    names = ["blank", "duplicate", "truncated", "illegal"]
    counts = once.groupBy("key").agg(F.coalesce(spread, F.lit(0)).cast("long").alias("gaps"), *[F.sum(n).alias(n) for n in names])
    out = ids.join(counts, "key", "left").join(audit, "key", "left").join(digests, "key", "left")
    return out.select("conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ["gaps", *names, "cost"]],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
