"""Operator 11: source divergence audit by Gustavson row accumulation.

Every (lang, source) group is a row of a sparse group x term matrix of counts
and, smoothed, of shares ``p = 1 + floor(UNIT * (count + 5) / (N + 5 V))`` over
the ``V`` terms that its language keeps (in at least ``min_docs`` documents).
Two groups diverge by the sum of |p - q| over all kept terms; a group's own
terms are those whose share lies above the language's.

1. One pass over the texts counts terms per group; a task holds at most
   ``HELD`` counters before it hands them on, and Spark adds them up.
2. Postings are stored term by term: (source number, share, baseline share of
   a term that the source lacks).  A language's index is cut by term hash into
   blocks of about ``CELL`` postings, its sources into blocks of rows; a cell is
   one block of each.
3. In a cell each source scatters its terms through the index into one dense
   accumulator over its peers: no pair of postings is ever emitted.  A source
   starts from the baselines: every term counts |z_g - z_h|; its own terms are
   corrected to |p - z_h|, terms that both hold to |p - q|.  Cells give partial
   sums per pair of sources, which Spark adds up.

All arithmetic is in integers.  A hot source is one row among its language's
(its texts were counted where they lie), a hot language is cut into cells.  Per
language the sources are numbered in one task and listed in one row; the
result itself holds all pairs of them.

Rows: null text, lang and source count as empty.  A group without kept terms is
reported with all its peers; a language that keeps none has values 0.  Ties
rank by item in UTF-8 order.  ``doc_id`` and extra columns are ignored: every
row, repeated or not, is a document.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posgraph.llm.common import stored

MIN_DOCS, SMOOTH, UNIT, TOP = 30, 5, 1_000_000_000, 50
HELD = 200_000      # counters that a task holds before it hands them on
CELL = 1 << 18      # postings in a block of a language's index, about
ROWS = 64           # sources in a block of rows, fewer where they have over 2**14 peers
_PIECE = 1 << 20    # bytes of a text looked at together
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
COUNTED = "lang string, source string, term binary, n long, docs long"
PARTIAL = "lang string, lo int, hi int, value long"


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``_PIECE`` bytes, cut between terms."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + _PIECE)
        stop = gap.start() if gap else len(text)
        yield text[at:stop]
        at = stop


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term of each group; a null term counts the group's documents."""
    tally: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        rows = [(*group, term, count, docs[term]) for group, (n, docs) in tally.items() for term, count in n.items()]
        tally.clear()
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          ["lang", "source", "term", "n", "docs"])
    for batch in batches:
        columns = [batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()]
        for lang, source, text in zip(*columns, strict=True):
            n, docs = tally.setdefault((lang or "", source or ""), (Counter(), Counter()))
            before, seen = len(n), set()
            for piece in pieces((text or b"").translate(_LOWER)):
                words = _TERM.findall(piece)
                n.update(words)
                seen.update(words)
            n[None] += 1
            docs.update(seen)
            held += len(n) - before
            if held >= HELD:
                yield flush()
                held = 0
    if tally:
        yield flush()


def share(n: Column, total: Column, terms: Column) -> Column:
    """p of a count, as a long; decimals keep the product exact."""
    top = (F.coalesce(n, F.lit(0)).cast("decimal(20,0)") + F.lit(SMOOTH)) * F.lit(UNIT)
    low = total.cast("decimal(20,0)") + (terms * SMOOTH).cast("decimal(20,0)")
    return F.call_function("div", top, low) + 1


def _absolute(p: np.ndarray, z: np.ndarray) -> np.ndarray:
    """For every z the sum of |p - z|."""
    p = np.sort(p)
    upto = np.concatenate([[0], np.cumsum(p)])
    k = np.searchsorted(p, z)
    return z * k - upto[k] + (upto[-1] - upto[k]) - z * (len(p) - k)


def accumulate(lo: int, hi: int, base: int, z: np.ndarray, size: np.ndarray, peer: np.ndarray, p: np.ndarray
               ) -> Iterator[tuple[int, np.ndarray]]:
    """(g, its accumulator over all peers) for the sources lo <= g < hi of one cell.

    ``size``, ``peer`` and ``p`` are the term-major index: the length of every
    posting list, and the lists one after another.  What belongs to a pair as a
    whole (``base`` terms at their baselines, terms that both hold) goes only
    to the later peer, each source's own terms to all peers: the
    accumulators of both ends add up to the pair's value.
    """
    start = np.cumsum(size) - size
    term = np.repeat(np.arange(len(size)), size)
    order = np.argsort(peer, kind="stable")
    edge = np.searchsorted(peer[order], np.arange(lo, hi + 1))
    for i, g in enumerate(range(lo, hi)):
        gap = np.abs(z - z[g])
        row = gap * base
        row[:g] = 0
        mine = order[edge[i]:edge[i + 1]]
        if len(mine):
            row += _absolute(p[mine], z) - gap * len(mine)
            lists = term[mine]
            step = size[lists]
            at = np.repeat(start[lists] - (np.cumsum(step) - step), step) + np.arange(step.sum())
            own = np.repeat(p[mine], step)[peer[at] > g]
            at = at[peer[at] > g]
            h, q = peer[at], p[at]
            both = np.abs(own - q) - np.abs(own - z[h]) - np.abs(z[g] - q) + gap[h]
            # Below 2**31 each and at most a cell's terms: the sums are exact in doubles.
            row += np.bincount(h, both, len(z)).astype(np.int64)
        yield g, row


def _cell(key: tuple, cell: pa.Table) -> pa.Table:
    lang, block, part = (k.as_py() for k in key)
    cell = cell.combine_chunks()
    is_peers = cell["terms"].is_valid().to_numpy()
    peers = cell.filter(pa.array(is_peers))
    width, terms = peers["width"][0].as_py(), peers["terms"][0].as_py()
    z = pa.concat_arrays(peers["postings"].chunks).flatten().field("z").to_numpy(zero_copy_only=False)
    lists = pa.concat_arrays([*cell.filter(pa.array(~is_peers))["postings"].chunks, peers["postings"].chunk(0).slice(0, 0)])
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    peer = flat.field("source").to_numpy(zero_copy_only=False).astype(np.int64)
    p = flat.field("p").to_numpy(zero_copy_only=False).astype(np.int64)
    lo, hi = block * width, min(len(z), (block + 1) * width)
    ends, values = [], []
    for g, row in accumulate(lo, hi, terms if part == 0 else 0, z.astype(np.int64), size, peer, p):
        others = np.flatnonzero(np.arange(len(z)) != g) if part == 0 else np.flatnonzero(row * (np.arange(len(z)) != g))
        ends.append((np.minimum(others, g), np.maximum(others, g)))
        values.append(row[others])
    low, high = (np.concatenate([e[k] for e in ends]).astype(np.int32) for k in (0, 1))
    return pa.table({"lang": pa.array([lang] * len(low), pa.string()), "lo": low, "hi": high, "value": np.concatenate(values)},
                    pa.schema([("lang", pa.string()), ("lo", pa.int32()), ("hi", pa.int32()), ("value", pa.int64())]))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, cell: int = CELL, rows: int = ROWS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank for every group of ``docs``."""
    counted = docs.select("lang", "source", "text").mapInArrow(_count, COUNTED)
    counts = stored(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
                    .withColumn("term", F.col("term").cast("string")), "term-counts")
    terms = stored(counts.where("term is not null").groupBy("lang", "term")
                   .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(F.col("docs") >= min_docs)
                   .drop("docs"), "kept-terms")
    kept = stored(counts.where("term is not null").select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "kept-counts")

    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("total_lang"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    groups = (counts.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["total", "held", "terms", "total_lang"]))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    z = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(0))
    groups = stored(groups.withColumn("number", number).withColumn("z", z.cast("long")), "groups")

    shares = kept.join(groups, ["lang", "source"])
    shares = shares.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    own = (shares.withColumn("q", share(F.col("n_lang"), F.col("total_lang"), F.col("terms"))).where("p > q")
           .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("p - q").alias("value")))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    own = own.withColumn("rank", place).where(F.col("rank") <= top)

    # The term-major index and its cells.
    spec = groups.groupBy("lang").agg(
        F.max("terms").alias("terms"), F.greatest(F.lit(1), F.ceil(F.sum("held") / cell)).cast("int").alias("parts"),
        F.greatest(F.lit(1), F.least(F.lit(rows), F.expr(f"{1 << 20} div count(1)"))).cast("int").alias("width"),
        F.count(F.lit(1)).alias("sources"),
        F.array_sort(F.collect_list(F.struct(F.col("number").alias("source"), F.lit(0).cast("long").alias("p"), "z"))).alias("postings"))
    spec = stored(spec, "index-spec")
    posting = F.struct(F.col("number").alias("source"), "p", "z")
    index = (shares.groupBy("lang", "term").agg(F.collect_list(posting).alias("postings"))
             .join(spec.select("lang", "parts", "width"), "lang")
             .withColumn("part", F.expr("cast(pmod(xxhash64(term), parts) as int)"))
             .withColumn("block", F.explode(F.array_distinct(F.expr("transform(postings, x -> x.source div width)")))))
    every = (spec.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
             .withColumn("block", F.explode(F.expr("sequence(0L, (sources - 1) div width)"))))
    columns = ["lang", "block", "part", "postings"]
    cells = every.select(*columns, "width", "terms").unionAll(
        index.select(*columns, F.lit(None).cast("int"), F.lit(None).cast("long")))
    sums = (cells.groupBy("lang", "block", "part").applyInArrow(_cell, PARTIAL)
            .groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value")))
    both = F.explode(F.array(F.struct(F.col("lo").alias("g"), F.col("hi").alias("h")),
                             F.struct(F.col("hi").alias("g"), F.col("lo").alias("h")))).alias("e")
    names = groups.select("lang", "number", "source")
    pairs = (sums.select("lang", "value", both).select("lang", "value", "e.*")
             .join(names.select("lang", F.col("number").alias("g"), "source"), ["lang", "g"])
             .join(names.select("lang", F.col("number").alias("h"), F.col("source").alias("item")), ["lang", "h"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", place))
    return pairs.unionAll(own)
