"""Operator 12: near duplicates by SimHash and Golay-code fuzzy hashing.

The fingerprint of a document has 64 bits: a bit is 1 if more than half of the
XXH64 hashes (seed 42) of its three-word shingles have it, repeats included.
Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; with fewer than three words
the whole sequence is one shingle.  Fingerprints link at up to ``MAX_BITS`` = 3
differing bits.

1. Equal fingerprints collapse to one class; only distinct ones go on.
2. Keys: a fingerprint is cut into segments of 22, 21 and 21 bits, each read as
   a word of the Golay code (``golay``): its own codeword lies within 3 bits, and
   a segment that differs in one bit has that codeword among its at most six
   near ones.  Of three errors either some segment has none, and then another
   has at most one: key (that segment, near codeword of the other); or each
   has one: key (near codewords of the first two, the half of the third that
   has none).  About 88 keys a fingerprint, two linked ones share a key that is
   own for at least one of them: no link is lost.
3. Members of a key join with its centre (the smallest fingerprint) and are
   verified, one comparison each; what is linked then is one component.  Only
   keys that still hold several components go on, and there only the members
   outside the key's largest component meet the others (own keys, verified on
   all 64 bits).  So a large group of copies is not compared pair by pair.

Keys are shuffled as (long, long, boolean); a bitmap keeps keys held by one
fingerprint alone out of the joins, whose sides are stored tables, so that AQE
splits a hot key.

Rows: every input row gives one row.  Null and wordless texts have fingerprint
zero, which links like any other.  A null ``doc_id`` cannot be linked: its
component is null.  Rows that repeat a ``doc_id`` are one document, linked if
any of its rows links.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posgraph.llm.common import may_contain, stored
from posgraph.llm.golay import near_codewords
from posgraph.llm.neardup import components

SHINGLE, SEED, MAX_BITS = 3, 42, 3
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, bits)
HALVES = ((43, 11), (54, 10))             # of the last segment
_PIECE = 1 << 18                          # bytes of a text looked at together
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of a whole text, block by block."""
    ones, n, words, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(text):
        gap = _BLANK.search(text, at + _PIECE)
        stop = gap.start() if gap else len(text)
        words += text[at:stop].translate(_LOWER).split()  # bytes split at exactly these six blanks
        at = stop
        if len(words) >= SHINGLE:
            ones += _bits([b"%b %b %b" % t for t in zip(words, words[1:], words[2:])])
            n += len(words) - SHINGLE + 1
            words = words[1 - SHINGLE:]
    if words and not n:
        ones, n = _bits([b" ".join(words)]), 1
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def _bits(shingles: list[bytes]) -> np.ndarray:
    """How many of the hashes have each bit, the highest first."""
    h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], ">u8")
    return np.add.reduce(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1), axis=0, dtype=np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t or b"") for t in batch["text"].cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(np.array(prints, _U).view(np.int64))],
                                         ["doc_id", "fp"])


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, own) of every key of the fingerprints (unsigned 64-bit)."""
    def cut(low: int, bits: int) -> np.ndarray:
        return (prints >> _U(low)) & _U((1 << bits) - 1)
    segments = [cut(*s) for s in SEGMENTS]
    near = [near_codewords(s) for s in segments]
    rows, out, own = [], [], []
    kind = 0
    for i, exact in enumerate(segments):
        for j, (words, there) in enumerate(near):
            if i != j:
                row, place = np.nonzero(there)
                rows.append(row)
                own.append(place == 0)
                out.append(_U(kind << 40) | exact[row] << _U(12) | words[row, place].astype(_U))
                kind += 1
    (a, in_a), (b, in_b) = near[:2]
    row, i, j = np.nonzero(in_a[:, :, None] & in_b[:, None, :])
    pair = a[row, i].astype(_U) << _U(23) | b[row, j].astype(_U) << _U(11)
    for half in HALVES:
        rows.append(row)
        own.append((i == 0) & (j == 0))
        out.append(_U(kind << 40) | pair | cut(*half)[row])
        kind += 1
    return np.concatenate(rows), np.concatenate(out), np.concatenate(own)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch["fp"].to_numpy(zero_copy_only=False)
        for at in range(0, len(fp), 1000):
            part = fp[at:at + 1000]
            row, key, own = keys(part.view(_U))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part[row]), pa.array(own)],
                                             ["key", "fp", "own"])


def links(prints: DataFrame, extra: DataFrame) -> DataFrame:
    """(id, component) of fingerprints linked directly or through others; ``extra`` are given edges (a, b)."""
    keyed = prints.select("fp").mapInArrow(_keys, "key long, fp long, own boolean")
    groups = stored(keyed.groupBy("key").agg(F.min("fp").alias("centre"), F.max("fp").alias("hi"), F.max("own").alias("any"))
                    .where("centre <> hi and any").select("key", "centre"), "keys")
    shared = may_contain(keyed, F.col("key"), groups.select("key")).where("_may").drop("_may")
    members = stored(shared.join(groups, "key"), "members")
    close = f"bit_count(a ^ b) <= {MAX_BITS}"
    first = members.select(F.col("fp").alias("a"), F.col("centre").alias("b")).where("a <> b").where(close).distinct()
    edges = stored(first.unionAll(extra), "links")

    comp = components(edges).withColumnRenamed("id", "fp")
    known = stored(members.drop("centre").join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "labelled")
    sizes = known.groupBy("key", "component").count()
    still = stored(sizes.groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("main"),
                                            F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "open-keys")
    left = stored(known.join(still, "key"), "open")
    x = left.where("component <> main").select("key", F.col("fp").alias("a"), F.col("own").alias("own_a"), F.col("component").alias("ca"))
    y = left.select("key", F.col("fp").alias("b"), F.col("own").alias("own_b"), F.col("component").alias("cb"))
    met = x.join(y, (x["key"] == y["key"]) & (x["ca"] != y["cb"]) & F.expr("own_a or own_b") & F.expr(close))
    return components(edges.unionAll(met.select("a", "b").distinct()))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hexadecimal), component_id for every row of ``docs``."""
    sketch = stored(docs.select("doc_id", "text").mapInArrow(_sketch, "doc_id long, fp long"), "prints")
    some = sketch.where("doc_id is not null")
    classes = stored(some.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    # A document whose rows have several fingerprints connects them.
    several = some.groupBy("doc_id").agg(F.min("fp").alias("b"), F.max("fp").alias("hi")).where("b <> hi").drop("hi")
    extra = some.join(several, "doc_id").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    comp = links(classes, stored(extra, "extra")).withColumnRenamed("id", "fp")
    placed = stored(classes.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "placed")
    lowest = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_print = stored(placed.join(lowest, "component").select("fp", "component_id"), "components")
    out = sketch.join(of_print, "fp", "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
