"""Operator 1: near-duplicate groups with a MinHash LSH forest.

A document is its set of distinct five-word shingles (``words``: A-Z
lower-cased; with fewer words the whole sequence is one shingle).  Two
documents are linked when 100 * |intersection| >= 75 * |union|.

1. One pass over the texts makes a 96-value MinHash signature, the set size and
   a 128-bit digest of the set.  Documents with equal sets form one class; only
   the class' smallest id goes on.
2. The forest: 32 orders, order t being the signature rotated by 3t.  Documents
   that agree on the first three values of an order are a region; sharing no
   region at similarity 0.75 has probability (1 - 0.75^3)^32 = 2e-8.
3. Candidates are confirmed on the full sets, region by region, and a region is
   left as soon as its members are connected (the depth adapts to the region):
   first every document with its smallest region centre (the smallest id of the
   region); then, in regions still open, with all their centres; then with the
   centre of the members that share the longest prefix (4 to 12 values).
   Members that still lie in different components go through an exact prefix
   filter (``prefix_pairs``), which leaves out only pairs that cannot be links.

No pairs inside a connected group are made, so a group of n copies costs about
n comparisons; centres come from partial aggregates, never from one task
holding a group.

Rows: every input row gives one row.  A document without words has
``n_shingles`` 0 and is linked with nothing.  A null ``doc_id`` cannot be
linked: its component is null and it is kept.  Rows that repeat a ``doc_id``
are one document, linked if any of its rows links.  Extra columns are ignored
by ``near_duplicates`` and carried through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posgraph.llm.common import drop_ids, may_contain, stored
from posgraph.llm.words import chunks, constants, mix, ngram_hashes, word_hashes

SHINGLE, PERCENT = 5, 75
ORDERS, BASE_DEPTH = 32, 3
VALUES = ORDERS * BASE_DEPTH
DEEPER = (4, 5, 6, 8, 12)
_BLOCK = 8192
SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, sig binary"
COMPARED = "a long, b long, n_a long, n_b long, common long"

_XOR = (constants(VALUES, 11) >> np.uint64(32)).astype(np.uint32)[:, None]
_MUL = ((constants(VALUES, 12) >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(texts)
    out, at = [], 0
    for k in counts.tolist():
        out.append(np.unique(ngram_hashes(words[at:at + k], min(k, SHINGLE))) if k else np.zeros(0, np.uint64))
        at += k
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of the ``VALUES`` hash functions over the set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    sig = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), _BLOCK):
        sig = np.minimum(sig, ((low[i:i + _BLOCK] ^ _XOR) * _MUL).min(axis=1))
    return sig


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in chunks(batch):
            sets = shingle_sets(texts)
            digest = [[int(np.add.reduce(mix(s ^ np.uint64(k))).astype(np.int64)) if len(s) else 0 for s in sets]
                      for k in (0x51, 0xA7)]
            yield pa.RecordBatch.from_arrays([
                batch["doc_id"].slice(first, len(texts)).cast(pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array(digest[0], pa.int64()),
                pa.array(digest[1], pa.int64()), pa.array([signature(s).tobytes() if len(s) else b"" for s in sets],
                                                          pa.binary())],
                ["doc_id", "n_shingles", "set_a", "set_b", "sig"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set sizes and intersections of text pairs; rows come sorted by b, whose set is kept."""
    last_text, last_set = b"", np.zeros(0, np.uint64)
    for batch in batches:
        other = [t or b"" for t in batch["text_b"].cast(pa.binary()).to_pylist()]
        for first, texts in chunks(batch, "text_a"):
            rows = []
            for s, t in zip(shingle_sets(texts), other[first:first + len(texts)], strict=True):
                if t != last_text:
                    last_text, last_set = t, shingle_sets([t])[0]
                rows.append((len(s), len(last_set), len(np.intersect1d(s, last_set, assume_unique=True))))
            counts = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch[c].slice(first, len(texts)) for c in ("a", "b")] + [pa.array(c, pa.int64()) for c in counts],
                ["a", "b", "n_a", "n_b", "common"])


def compare_pairs(docs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """``pairs`` (a, b) with the sizes and the intersection of their full sets (stored).

    Only texts that the id bitmap lets through are shuffled.  With repeated
    ids the largest intersection counts.
    """
    def side(c: str) -> DataFrame:
        marked = may_contain(docs.select("doc_id", "text"), F.col("doc_id"), pairs.select(c))
        return marked.where("_may").select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    compared = both.mapInArrow(_compare, COMPARED)
    best = F.max_by(F.struct("n_a", "n_b", "common"), F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common")))
    return stored(compared.groupBy("a", "b").agg(best.alias("m")).select("a", "b", "m.*"), name)


def links_of(compared: DataFrame) -> DataFrame:
    return compared.where(f"100 * common >= {PERCENT} * (n_a + n_b - common)").select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b): the smallest id reachable.

    Alternating large-star and small-star steps (each a minimum per node,
    joined back) until the edges no longer change; every step is a stored table.
    """
    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
               "edges")
    before = None
    while (now := mark(e)) != before:
        before = now
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        e = stored(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                   .unionAll(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component"))


def _bands(sketch: DataFrame) -> DataFrame:
    width = 4 * BASE_DEPTH
    keys = F.expr(f"transform(sequence(0, {ORDERS - 1}), t -> xxhash64(t, substring(sig, t * {width} + 1, {width})))")
    return sketch.select("doc_id", "n_shingles", F.posexplode(keys).alias("t", "region"))


def _labelled(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members of regions that still hold more than one component, with their component."""
    known = stored(members.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left")
                   .withColumn("component", F.coalesce("component", "doc_id")), "labelled")
    # Stored, so that the join below has a plain exchange on each side, which AQE splits for a hot region.
    open_regions = stored(known.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                          .where("lo <> hi").select("region"), "open-regions")
    return known.join(open_regions, "region")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct shingle of each document; ``sid`` tells apart rows that repeat a doc_id."""
    for batch in batches:
        for first, texts in chunks(batch):
            sets = shingle_sets(texts)
            size = np.array([len(s) for s in sets])
            sid = [int(np.add.reduce(mix(s ^ np.uint64(0x51))).astype(np.int64)) if len(s) else 0 for s in sets]
            ids = batch["doc_id"].slice(first, len(texts))
            rows = pa.array(np.repeat(np.arange(len(sets)), size))
            yield pa.RecordBatch.from_arrays(
                [ids.take(rows), batch["component"].slice(first, len(texts)).take(rows),
                 batch["residual"].slice(first, len(texts)).take(rows), pa.array(sid, pa.int64()).take(rows),
                 pa.array(np.repeat(size, size)), pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))],
                ["doc_id", "component", "residual", "sid", "n", "shingle"])


def prefix_pairs(docs: DataFrame, left: DataFrame) -> DataFrame:
    """Pairs (a, b) that may still be links, among members of open regions (``left``).

    An exact prefix filter, for the pairs with one end outside the largest
    component of a region.  Shingles are ordered by their frequency among the
    open documents, rarest first.  With |x| >= |y| a link needs a shingle among
    the first |x| - ceil(3|x|/4) + 1 of x and the first |y| - ceil(6|y|/7) + 1 of
    y, and from there on enough shingles on both sides for an intersection of
    3/7 (|x| + |y|).  The latter bounds the partner's size, so each shingle of
    the outside document is joined on (shingle, size class) with the classes
    that its place still allows: copies with edits of their own do not meet.
    """
    main = (left.groupBy("region", "component").count().groupBy("region")
            .agg(F.max_by("component", F.struct("count", "component")).alias("main")))
    members = (left.join(main, "region").groupBy("doc_id", "component")
               .agg(F.max(F.col("component") != F.col("main")).alias("residual")))
    members = stored(members, "members")
    texts = may_contain(docs, F.col("doc_id"), members.select("doc_id")).where("_may").select("doc_id", "text")
    tokens = stored(texts.join(members, "doc_id").mapInArrow(
        _tokens, "doc_id long, component long, residual boolean, sid long, n long, shingle long"), "tokens")
    df = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("doc_id", "sid").orderBy("df", "shingle")
    size_class = lambda n: F.floor(F.log(n.cast("double")) * 33).cast("int")
    n, rest = F.col("n"), F.col("n") - F.col("p") + 1
    head = (tokens.join(df, "shingle").withColumn("p", F.row_number().over(order))
            .where("df > 1 and p <= n - ceil(3 * n / 4) + 1"))
    head = stored(head.withColumn("short", F.expr("p <= n - ceil(6 * n / 7) + 1")).withColumn("rest", rest)
                  .withColumn("most", F.expr("(7 * rest - 3 * n) div 3")), "prefixes")  # the largest partner that the place allows

    def ends(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("doc_id").alias(name), F.col("component").alias(f"c{name}"), F.col("n").alias(f"n{name}"),
                         F.col("rest").alias(f"r{name}"), "shingle", "slot")

    def meet(outside: DataFrame, low, high, others: DataFrame, larger: str) -> DataFrame:
        x = outside.withColumn("lo", low).withColumn("hi", F.least(high, F.col("most"))).where("lo <= hi")
        x = x.withColumn("slot", F.explode(F.sequence(size_class(F.col("lo")), size_class(F.col("hi")))))
        y = others.withColumn("slot", size_class(n))
        return ends(x, "x").join(ends(y, "y"), ["shingle", "slot"]).where(
            f"x <> y and cx <> cy and 7 * least(rx, ry) >= 3 * (nx + ny) and {larger}").select(
            F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    outside = head.where("residual")
    as_larger = meet(outside, F.ceil(n * 3 / 4), n, head.where("short"), "nx >= ny and 4 * ny >= 3 * nx")
    as_smaller = meet(outside.where("short"), n, F.floor(n * 4 / 3), head, "nx <= ny and 4 * nx >= 3 * ny")
    return as_larger.unionAll(as_smaller).distinct()


def link_classes(docs: DataFrame, sketch: DataFrame, extra: DataFrame) -> DataFrame:
    """(id, component) over the class representatives in ``sketch``; ``extra`` are given edges (a, b)."""
    bands = _bands(sketch)
    regions = bands.groupBy("region").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("hi"))
    members = stored(bands.join(regions.where("centre <> hi").drop("hi"), "region"), "regions")

    pairs = members.where("doc_id <> centre").groupBy(F.col("doc_id").alias("a")).agg(F.min("centre").alias("b"))
    seen = compare_pairs(docs, stored(pairs, "pairs"), "compared")

    def step(seen: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        pairs = stored(pairs.distinct().join(seen, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            seen = seen.unionAll(compare_pairs(docs, pairs, "compared"))
        return seen, components(links_of(seen).unionAll(extra))

    comp = components(links_of(seen).unionAll(extra))
    left = stored(_labelled(members, comp), "open")
    ends = [F.col("doc_id").alias("a"), F.col("centre").alias("b")]
    seen, comp = step(seen, left.where("doc_id <> centre").select(*ends))

    # Longest common prefixes: in each order, the deepest prefix that a document shares with another component.
    left = stored(_labelled(left.drop("component"), comp), "open")
    deep = left.join(sketch.select("doc_id", "sig"), "doc_id").select(
        "doc_id", "component", "t", F.explode(F.expr(
            f"transform(array{DEEPER}, k -> struct(k, xxhash64(t, k, substring(concat(sig, sig), t * {4 * BASE_DEPTH} + 1, k * 4))"
            " as p))")).alias("d")).select("doc_id", "component", "t", "d.*").toDF("doc_id", "component", "t", "k", "p")
    groups = (deep.groupBy("p").agg(F.min(F.struct("doc_id", "component")).alias("c"), F.min("component").alias("lo"),
                                    F.max("component").alias("hi")).where("lo <> hi"))
    near = deep.join(groups, "p").where("component <> c.component")
    near = near.groupBy("doc_id", "t").agg(F.max_by("c.doc_id", "k").alias("centre"))
    seen, comp = step(seen, near.select(F.greatest("doc_id", "centre").alias("a"), F.least("doc_id", "centre").alias("b")))

    left = _labelled(left.drop("component"), comp)
    return step(seen, stored(prefix_pairs(docs, stored(left, "open")), "pairs"))[1]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    sketch = stored(docs.mapInArrow(_sketch, SKETCH), "sketch")
    key = ["n_shingles", "set_a", "set_b"]
    some = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = stored(some.groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    whole = some.join(classes, key).where("doc_id = rep").dropDuplicates(["doc_id", *key])
    # A document whose rows fall into several classes connects them.
    ids = some.select("doc_id", *key).join(classes, key).select("doc_id", "rep").distinct()
    lowest = ids.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("hi")).where("b <> hi").drop("hi")
    extra = ids.join(lowest, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b")
    comp = link_classes(docs, whole.select("doc_id", "n_shingles", "sig"), stored(extra, "extra"))
    rep = F.coalesce("component", "rep", "doc_id")
    return (sketch.drop("sig").join(classes, key, "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), rep).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay (one document of each group), with all their columns."""
    return drop_ids(docs, near_duplicates(docs).where("not kept").select("doc_id"))
