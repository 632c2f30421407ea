"""Operator 7: removal of repeated 50-byte strings by a depth-limited radix sort of suffixes.

A byte goes when a 50-byte string that covers it also starts in a document
with a smaller id.  Suffixes are ordered only through 50 bytes, most
significant digit first, and leave the sort as soon as they are alone:

1. Copies of a whole text are settled by their digest; only the smallest id of
   each text takes part further.
2. First digit: the 16-byte string inside a window whose hash is smallest, which
   depends on the window's bytes alone.  Windows that share it are consecutive,
   so one anchor stands for about 17 suffixes.  Anchors are counted in hash
   buckets; those found in one document only are finished.
3. The stretches around the anchors that remain (found again in a second pass
   through a bitmap of fixed size) are sorted on their bytes in 8-byte digits,
   first within a task, where all but the first of equal windows are settled,
   then, for those first ones, per bucket over the whole corpus.  Groups that
   are equal through 50 bytes are exactly the repeated windows.

Equal stretches of a passage in a third of all documents reach a bucket once per
task chunk, not once per document.  Those at its edges (and around short common
phrases) differ from document to document, so an anchor can have one per
document.  Anchors are counted in ``SLOTS`` slots a bucket; stretches of slots with
more than ``HOT`` of them are split by their next digit (``split_hot``): into runs of
``STEP`` windows, keyed by the 44 bytes that all windows of a run share, at most
``_SPAN / STEP`` = 5 rows each, and sorted in the buckets of these keys.  Runs whose
44 bytes are still that frequent (the edges of a very frequent passage) are dealt
out window by window: the smallest id of every (anchor, 128-bit hash of the 50
bytes) is a partial aggregate, joined back.  Every input takes these steps.  The
anchors' bitmap only saves traffic: when it fills up, more stretches are sorted, never fewer.

Rows: every input row gives one row.  A null text is empty.  A null ``doc_id``
is neither smaller nor larger than others, so nothing is removed from that row
or because of it; likewise rows that repeat a ``doc_id`` do not affect each
other.  Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posgraph.llm.common import bitmap, drop_rows, may_contain, stored
from posgraph.llm.words import mix, powers, running

WINDOW, ANCHOR = 50, 16
_SPAN = WINDOW - ANCHOR + 1          # anchors inside a window
_STRETCH = WINDOW + _SPAN - 1        # longest text around one anchor's windows
HASH_BYTES = 1 << 18                 # bytes hashed at once (the arrays stay in the cache)
CHUNK = 1 << 21                      # bytes of text settled together inside a task
BUCKET_BYTES = 1 << 22               # text per bucket of anchors
SLOTS = 64                           # parts of a bucket in which stretches are counted (some 4,000 in each at most, if evenly)
HOT = 1 << 13                        # stretches of a slot above which its anchors are split by their next digit
ANCHOR_BITS = 24                     # of an anchor that are shuffled with a stretch
STEP = 7                             # windows of a split stretch; divides _SPAN
BLOCK = 1 << 17                      # windows sorted at once
BITMAP_BITS = 1 << 27                # 16 MB, whatever the input
_U = np.uint64
_LOW = (1 << 24) - 1
_PIECE = "doc_id long, th long, start long, stop long, anchor long, lead int, body binary"
_SPANS = "doc_id long, th long, start long, stop long"


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, place, first and last window) of every anchor in joined texts that end at ``ends``.

    Windows do not cross an end.
    """
    if len(data) < WINDOW:
        none = np.zeros(0, np.int64)
        return none.astype(_U), none, none, none
    c = running(data)
    raw = (c[ANCHOR:] - c[:-ANCHOR]) * powers(len(c))[1][:len(data) - ANCHOR + 1]
    ranked = (raw & _U(0xFFFFFFFFFF000000)) | np.arange(len(raw), dtype=_U)  # of equal hashes the leftmost
    at = (_slide_min(ranked, _SPAN) & _U(_LOW)).astype(np.int32)
    inside = np.ones(len(at) + 1, bool)
    over = (ends[:, None] - np.arange(1, WINDOW)).reshape(-1)
    inside[over[(over >= 0) & (over < len(at))]] = False
    inside[-1] = False
    fresh = np.concatenate([[True], (at[1:] != at[:-1]) | ~inside[:-2]])
    first = np.flatnonzero(inside[:-1] & fresh)
    last = np.flatnonzero(inside[:-1] & np.concatenate([fresh[1:] | ~inside[1:-1], [True]]))
    return mix(raw[at[first]]), at[first].astype(np.int64), first, last


def parts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, text number, place in the text) of the texts in pieces of about ``HASH_BYTES``.

    A longer text is cut into overlapping pieces, so that every window is in exactly one of them.
    """
    held, size = [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(len(t) - WINDOW + 1, 0), HASH_BYTES):
            piece = t[at:at + HASH_BYTES + WINDOW - 1]
            held.append((k, at, piece))
            size += len(piece)
            if size >= HASH_BYTES:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(p) for _, _, p in held])
    return (np.frombuffer(b"".join(p for _, _, p in held), np.uint8), ends, np.array([k for k, _, _ in held]),
            np.array([at for _, at, _ in held]))


def radix_groups(rows: np.ndarray) -> np.ndarray:
    """Group number of every row of bytes (-1: equal to no other), by digits of 8 bytes from the front."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, :rows.shape[1]] = rows
    digits = padded.view(_U)
    if sys.byteorder == "little":
        digits.byteswap(inplace=True)
    label = np.zeros(len(rows), np.int64)
    tied = np.arange(len(rows))
    for d in range(digits.shape[1]):
        if not len(tied):
            break
        digit = digits[tied, d]
        order = np.lexsort((digit, label[tied]))
        tied, digit = tied[order], digit[order]
        old = label[tied]
        new = np.concatenate([[True], (old[1:] != old[:-1]) | (digit[1:] != digit[:-1])])
        group = np.cumsum(new) - 1
        alone = np.bincount(group)[group] == 1
        label[tied] = group
        label[tied[alone]] = -1
        tied = tied[~alone]
    return label


def _smallest(label: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id of each row's group (its own where the label is -1)."""
    low = ids.copy()
    some = np.flatnonzero(label >= 0)
    if len(some):
        by = np.full(label.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(by, label[some], ids[some])
        low[some] = by[label[some]]
    return low


def _bytes_at(data: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    room = np.concatenate([data, np.zeros(width, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(room, width)[start]


def _blocks(rows: np.ndarray, anchor: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """``rows`` by anchor, in blocks of about ``BLOCK`` windows that keep each anchor together."""
    rows = rows[np.argsort(anchor[rows], kind="stable")]
    a = anchor[rows]
    group = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(rows) else np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(size[rows] - WINDOW + 1)])
    at = 0
    while at < len(rows):
        end = np.searchsorted(total, total[at] + BLOCK, "right") - 1
        k = np.searchsorted(group, end, "right") - 1
        end = len(rows) if end >= len(rows) else group[k] if group[k] > at else group[k + 1] if k + 1 < len(group) else len(rows)
        yield rows[at:end]
        at = end


def settle(ids: np.ndarray, anchor: np.ndarray, lead: np.ndarray, size: np.ndarray, body: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last removed window) of stretches, and which rows must still be compared elsewhere.

    A stretch holds ``size`` bytes (the rest of its ``body`` row is zero) around an
    anchor ``lead`` bytes from its start.  Equal stretches have equal windows, so
    only one row of each, with the smallest id, is taken apart into windows.
    """
    n = len(ids)
    head = np.stack([anchor.astype(">u8"), (lead.astype(np.int64) << 16 | size).astype(">u8")], 1)
    whole = radix_groups(np.concatenate([head.view(np.uint8).reshape(n, 16), body], 1))
    low = _smallest(whole, ids)
    behind = ids > low
    # One row stands for all of its stretch and id; the others take over its answer.
    order = np.lexsort((np.arange(n), ids, whole))
    same = np.zeros(n, bool)
    a, b = order[1:], order[:-1]
    same[a] = (whole[a] >= 0) & (whole[a] == whole[b]) & (ids[a] == ids[b])
    stands = np.arange(n)
    lead_rows = order[np.maximum.accumulate(np.where(same[order], 0, np.arange(n)))] if n else order
    stands[order] = lead_rows
    reps = np.flatnonzero(~behind & ~same)
    _, back, count = np.unique(anchor[reps], return_inverse=True, return_counts=True)
    open_reps = reps[count[back] > 1]  # anchors with more than one kind of stretch
    flat = np.ascontiguousarray(body).reshape(-1)
    runs = []
    for block in _blocks(open_reps, anchor, size):
        windows = size[block] - WINDOW + 1
        owner = np.repeat(block, windows)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        label = radix_groups(_bytes_at(flat, owner * body.shape[1] + place, WINDOW))
        gone = ids[owner] > _smallest(label, ids[owner])
        edge = np.concatenate([[True], (owner[1:] != owner[:-1]) | (gone[1:] != gone[:-1])])
        begin = np.flatnonzero(edge)
        stop = np.append(begin[1:], len(owner)) - 1
        begin, stop = begin[gone[begin]], stop[gone[begin]]
        runs.append((owner[begin], place[begin], place[stop]))
    run_row, run_lo, run_hi = (np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, np.int64) for k in range(3))
    order = np.argsort(run_row, kind="stable")
    run_row, run_lo, run_hi = run_row[order], run_lo[order], run_hi[order]
    # Rows of the same stretch and id get their representative's runs.
    twins = np.flatnonzero(same & ~behind)
    if len(twins) and len(run_row):
        lo = np.searchsorted(run_row, stands[twins], "left")
        k = np.searchsorted(run_row, stands[twins], "right") - lo
        pick = np.repeat(lo - np.cumsum(k) + k, k) + np.arange(k.sum())
        run_row = np.concatenate([run_row, np.repeat(twins, k)])
        run_lo, run_hi = np.concatenate([run_lo, run_lo[pick]]), np.concatenate([run_hi, run_hi[pick]])
    full = np.flatnonzero(behind)
    rows = np.concatenate([run_row, full])
    first = np.concatenate([run_lo, np.zeros(len(full), np.int64)])
    last = np.concatenate([run_hi, size[full] - WINDOW])
    left = size - WINDOW + 1
    np.subtract.at(left, rows, last - first + 1)
    return rows, first, last, left > 0


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    texts = batch["text"].cast(pa.binary()).to_pylist()
    ids, th = batch["doc_id"].to_numpy(), batch["th"].to_numpy()
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHUNK or i == len(texts) - 1:
            yield ids[first:i + 1], th[first:i + 1], texts[first:i + 1]
            first, held = i + 1, 0


def _key_rows(buckets: int):
    """Per chunk and bucket: the distinct anchors (40 low bits), twice if in more than one document."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in _chunks(batch):
                hs, docs = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
                for data, ends, number, _ in parts(texts):
                    h, _, first, _ = anchors(data, ends)
                    hs.append(h)
                    docs.append(number[np.searchsorted(ends, first, "right")])
                h, doc = np.concatenate(hs), np.concatenate(docs)
                order = np.argsort(h, kind="stable")  # documents stay in order within a hash
                h, doc = h[order], doc[order]
                new = np.concatenate([[True], h[1:] != h[:-1]])[:len(h)]
                other = ~new & np.concatenate([[False], doc[1:] != doc[:-1]])[:len(h)]
                h = np.concatenate([h[new], np.unique(h[other])])
                bucket = ((h >> _U(40)) % _U(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                h, bucket = h[order], bucket[order]
                low = np.ascontiguousarray(h).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                used, cut = np.unique(bucket, return_index=True)
                cut = np.append(cut, len(bucket))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used), pa.array([low[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())],
                    ["bucket", "keys"])
    return make


def _repeated(table: pa.Table) -> pa.Table:
    """Bitmap positions (two a key) of the anchors that a bucket holds more than once."""
    raw = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    keys = np.sort(wide.view("<u8")[:, 0])
    twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
    return pa.table({"p": pa.array(np.concatenate(_probes(twice)))})


def _probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m = _U(BITMAP_BITS - 1)
    return (h & m).astype(np.int64), ((h >> _U(13)) & m).astype(np.int64)


def _pieces(bits):
    """Stretches around repeated anchors: removed windows that the chunk settles, and the rows left to compare."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bits.value
        for batch in batches:
            for ids, th, texts in _chunks(batch):
                found = []
                for data, ends, number, begin in parts(texts):
                    h, at, lo, hi = anchors(data, ends)
                    keep = np.ones(len(h), bool)
                    for p in _probes(h & _U((1 << 40) - 1)):
                        keep &= (b[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
                    h, at, lo, hi = h[keep], at[keep], lo[keep], hi[keep]
                    k = np.searchsorted(ends, lo, "right")
                    size = hi - lo + WINDOW
                    body = _bytes_at(data, lo, _STRETCH) * (np.arange(_STRETCH) < size[:, None])
                    start = lo - np.concatenate([[0], ends])[k] + begin[k]
                    found.append((number[k], h, at - lo, size, start, body.astype(np.uint8)))
                if not found:
                    continue
                doc, h, lead, size, start, body = (np.concatenate(x) for x in zip(*found, strict=True))
                rows, first, last, more = settle(ids[doc], h, lead, size, body)
                ship = np.flatnonzero(more)
                n, m = len(rows), len(ship)
                nothing = pa.nulls(n)
                col = {"doc_id": np.concatenate([ids[doc[rows]], ids[doc[ship]]]),
                       "th": np.concatenate([th[doc[rows]], th[doc[ship]]]),
                       "start": np.concatenate([start[rows] + first, start[ship]]),
                       "stop": np.concatenate([start[rows] + last + WINDOW, start[ship] + size[ship]])}
                none = lambda k: nothing.cast(k)
                tail = [pa.chunked_array([none(pa.int64()), pa.array(h[ship].view(np.int64))]),
                        pa.chunked_array([none(pa.int32()), pa.array(lead[ship].astype(np.int32))]),
                        pa.chunked_array([none(pa.binary()), pa.array([body[i, :size[i]].tobytes() for i in ship], pa.binary())])]
                if n + m:
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in col.values()]
                                                     + [t.combine_chunks() for t in tail],
                                                     [*col, "anchor", "lead", "body"])
    return make


def _settle_bucket(table: pa.Table) -> pa.Table:
    bodies = table["body"].to_pylist()
    size = np.array([len(t) for t in bodies], np.int64)
    body = np.frombuffer(b"".join(t.ljust(_STRETCH, b"\0") for t in bodies), np.uint8).reshape(-1, _STRETCH)
    ids, start = table["doc_id"].to_numpy(), table["start"].to_numpy()
    rows, first, last, _ = settle(ids, table["anchor"].to_numpy().view(_U), table["lead"].to_numpy(), size, body)
    return pa.table({"doc_id": ids[rows], "th": table["th"].to_numpy()[rows], "start": start[rows] + first,
                     "stop": start[rows] + last + WINDOW})


def split_hot(pieces: DataFrame) -> DataFrame:
    """Stretches cut by their next digit.

    Windows at the same place relative to their anchor come in runs of ``STEP``.
    All windows of a run cover its core of ``WINDOW - STEP + 1`` bytes, so equal windows
    have equal cores: the run, with the bytes that its windows cover, becomes a
    stretch of its own whose anchor is the hash of (anchor, run, core).
    """
    runs, last = _SPAN // STEP, f"octet_length(body) - {WINDOW}"
    begin = f"lead - {_SPAN - 1} + {STEP} * k"
    parts = F.expr(f"""filter(transform(sequence(0, {runs - 1}), k -> named_struct('k', k, 'begin', {begin},
        'lo', greatest(0, {begin}), 'hi', least({last}, {begin} + {STEP - 1}))), p -> p.lo <= p.hi)""")
    core = F.expr(f"substring(body, p.begin + {STEP}, {WINDOW - STEP + 1})")
    cut = pieces.withColumn("p", F.explode(parts)).select(
        "doc_id", "th", F.expr("start + p.lo").alias("start"),
        F.xxhash64("anchor", "p.k", core).alias("anchor"), F.expr("p.lo - p.begin").alias("lead"),
        F.expr(f"substring(body, p.lo + 1, p.hi - p.lo + {WINDOW})").alias("body"))
    return cut


def _hot_and_rest(pieces: DataFrame, slots: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The stretches of slots that hold more than ``HOT`` of them, and all others."""
    pieces = pieces.withColumn("slot", F.pmod("anchor", F.lit(slots)))
    hot = stored(pieces.groupBy("slot").count().where(F.col("count") > HOT).select("slot"), name)
    hot = F.broadcast(hot)  # at most one number for every HOT stretches
    return pieces.join(hot, "slot", "left_semi"), pieces.join(hot, "slot", "left_anti")


def _settle_windows(pieces: DataFrame) -> DataFrame:
    """The removed windows of stretches, settled by one aggregate and a join; no group is held together."""
    window = F.expr(f"substring(body, i + 1, {WINDOW})")
    keys = [F.xxhash64(window).alias("k1"), F.xxhash64(F.lit(1), window).alias("k2")]
    windows = pieces.select("doc_id", "th", "start", "anchor", "body",
                            F.explode(F.sequence(F.lit(0), F.octet_length("body") - WINDOW)).alias("i"))
    windows = windows.select("doc_id", "th", (F.col("start") + F.col("i")).alias("start"), "anchor", *keys)
    low = windows.groupBy("anchor", "k1", "k2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    low = stored(low.where("low <> high").drop("high"), "lowest")  # a plain exchange on each side of the join
    return (windows.join(low, ["anchor", "k1", "k2"]).where("doc_id > low")
            .select("doc_id", "th", "start", (F.col("start") + WINDOW).alias("stop")))


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """(what is left of ``text`` without the spans, number of maximal spans)."""
    kept, at, runs, end = [], 0, 0, -1
    for lo, hi in sorted(spans):
        if lo > end:
            runs += 1
            kept.append(text[at:lo])
        at = end = max(hi, end)
    kept.append(text[at:])
    return b"".join(kept), runs


def _cut_rows(with_text: bool):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).to_pylist()
            done = [cut(t, [(s["start"], s["stop"]) for s in spans])
                    for t, spans in zip(texts, batch["spans"].to_pylist(), strict=True)]
            cols = [batch["doc_id"], batch["th"], pa.array([len(t) - len(k) for t, (k, _) in zip(texts, done, strict=True)]),
                    pa.array([n for _, n in done]), pa.array([hashlib.sha256(k).hexdigest() for k, _ in done])]
            names = ["doc_id", "th", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols.append(pa.array([k.decode("utf-8", "replace") for k, _ in done]))
            yield pa.RecordBatch.from_arrays(cols, names + ["kept_text"] * with_text)
    return make


def repeated_spans(docs: DataFrame, total_bytes: int) -> DataFrame:
    """(doc_id, th, start, stop): removed byte ranges (they may overlap) of distinct texts ``docs`` (doc_id, th, text)."""
    spark = docs.sparkSession
    buckets = max(16, -(-total_bytes // BUCKET_BYTES))
    keys = docs.mapInArrow(_key_rows(buckets), "bucket long, keys binary")
    seen = keys.groupBy("bucket").applyInArrow(_repeated, "p long")
    bits = spark.sparkContext.broadcast(bitmap(stored(seen, "anchors"), "p", BITMAP_BITS))
    pieces = stored(docs.mapInArrow(_pieces(bits), _PIECE), "stretches", "zstd")
    local = pieces.where("body is null").select("doc_id", "th", "start", "stop")
    hot, cold = _hot_and_rest(pieces.where("body is not null").drop("stop"), buckets * SLOTS, "hot")
    still, split = _hot_and_rest(stored(split_hot(hot), "split", "zstd"), buckets * SLOTS, "still-hot")
    local = local.unionAll(_settle_windows(still))
    # Windows are compared byte by byte, so ANCHOR_BITS of an anchor are enough to sort it out inside a bucket.
    short = F.shiftrightunsigned("anchor", 64 - ANCHOR_BITS).alias("anchor")
    rest = cold.unionByName(split).select("doc_id", "th", "start", short, "lead", "body", (F.col("slot") % buckets).alias("bucket"))
    return local.unionAll(rest.groupBy("bucket").applyInArrow(_settle_bucket, _SPANS))


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (, kept_text for rows that lost bytes) of every row."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("th"))
    facts = stored(docs.select("doc_id", "th", F.octet_length("text").cast("long").alias("n_bytes"),
                               F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "facts")
    first = facts.where(f"doc_id is not null and n_bytes >= {WINDOW}").groupBy("sha").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("hi")).where("first_id <> hi").drop("hi")
    first = stored(first, "first")  # a plain exchange on each side of the join: AQE splits a hot text
    copies = stored(facts.join(first, "sha").where("doc_id > first_id").select("doc_id", "th").distinct(), "copies")

    total = facts.agg(F.sum("n_bytes")).first()[0] or 0
    key = F.xxhash64("doc_id", "th")
    distinct = docs.where(f"doc_id is not null and octet_length(text) >= {WINDOW}")
    distinct = drop_rows(distinct, ["doc_id", "th"], copies, key).select("doc_id", "th", "text")
    spans = stored(repeated_spans(distinct, total).groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
    hit = may_contain(docs, key, spans.select(key.alias("k"))).where("_may").select("doc_id", "th", "text")
    schema = "doc_id long, th long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    less = hit.join(spans, ["doc_id", "th"]).mapInArrow(_cut_rows(with_text), schema).dropDuplicates(["doc_id", "th"])

    gone = copies.withColumn("gone", F.lit(True))
    out = facts.join(less, ["doc_id", "th"], "left").join(gone, ["doc_id", "th"], "left")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    pick = [F.when(F.col("gone"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(F.col("gone"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(F.col("gone"), empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")]
    return out.select("doc_id", "n_bytes", *pick, *(["kept_text"] * with_text))
