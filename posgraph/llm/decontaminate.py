"""Operator 5: benchmark decontamination by n-gram seeds and Smith-Waterman alignment.

Words are runs of letters and digits (lower-cased), so case and punctuation (ASCII
or not) do not hide a copy; in scripts written without blanks (Han, kana, Thai,
Lao, Khmer, Myanmar) every character is a word.  Four-word grams of the test items are looked up in every
document: a bitmap of fixed size, broadcast to the tasks, lets through the
grams that may occur in an item, and a join keeps those that do.  A gram of at
most ``shared`` items (4) is a seed as it stands.  A gram that more items share
would point from each of its documents to all of them; it is a seed only
together with a word near it.  A copy holds at least half of the item's words, so
it holds one of any more than half: each item takes its rarest ones (counted as
pairs of gram and near word over all documents), and the pair is looked up.
Both ways miss no pair that the alignment could accept; ``shared`` moves cost only.
Every stretch of a document that a seed points to is aligned with the item on
words (match 2, mismatch -1, gap -1), unless fewer than half of the item's words
occur in it, which no score of 0.5 allows; the score is that of the best
local alignment over that of the whole item, and 0.5 or more is contamination.

Rows: one per contaminated (document, item).  An item of one to
three words counts only where all of it occurs as one gram (score 1).  A null
text, or one without a word, matches nothing.  A null ``doc_id`` cannot be
reported and stays; rows that repeat a ``doc_id`` count as one document (best
score), as do items that repeat an ``item_id``.  Of equal scores the first
stretch is reported.  Items of equal words are aligned once.  Empty tables give no rows; extra columns are ignored by
``contaminated`` and carried through by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posgraph.llm.common import FILTER_BITS, bitmap, drop_ids, may_contain, stored
from posgraph.llm.words import PUNCTUATION, chunks, mix, ngram_hashes, word_hashes

GRAM = 4
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, 1, 1
SHARED = 4
_BLOCK = 1 << 20  # pairs of gram and near word that are hashed at once
_FOUND = "doc_id long, gram long, pos long, paired boolean"
_PAIRS = "item long, n long, gram long, size long, key long, times long"
_ALIGNED = "doc_id long, item long, score double, start_word long, end_word long"


_UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
_SIGN = r"[^\p{L}\p{M}\p{N}\p{C}\x00-\x7F]"  # punctuation, symbols and blanks beyond ASCII


def _spaced(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``batch`` with its text lower-cased and blanks for signs and around unspaced characters."""
    text = pc.utf8_lower(batch["text"])
    odd = pc.fill_null(pc.match_substring_regex(text, f"{_UNSPACED}|{_SIGN}"), False)
    if pc.any(odd).as_py():
        some = pc.replace_substring_regex(text.filter(odd), f"{_SIGN}+", " ")
        text = pc.replace_with_mask(text, odd, pc.replace_substring_regex(some, f"({_UNSPACED})", r" \1 "))
    return batch.set_column(batch.schema.get_field_index("text"), "text", text)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, texts in chunks(_spaced(batch)):
            words, counts = word_hashes(texts, PUNCTUATION)
            edges = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch["item_id"].slice(first, len(texts)).cast(pa.int64()),
                pa.ListArray.from_arrays(edges, pa.array(words.view(np.int64)))], ["item_id", "words"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every gram of every item with its place (a short item is one gram); ``n`` is the number of words of the item."""
    for batch in batches:
        for item, words in zip(batch["item"].to_pylist(), batch["words"].to_pylist(), strict=True):
            g = ngram_hashes(np.array(words, np.int64).view(np.uint64), min(GRAM, len(words))).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(g), item)), pa.array(np.full(len(g), len(words))),
                 pa.array(np.arange(len(g))), pa.array(g)], ["item", "n", "at", "gram"])


def _size_class(n: np.ndarray) -> np.ndarray:
    """Items of 2^c to 2^(c + 1) - 1 words are of class c."""
    return np.floor(np.log2(n)).astype(np.int64)


def _class_key(grams: np.ndarray, size: int) -> np.ndarray:
    return mix(grams + np.uint64(size + 1))


def _pair_key(grams: np.ndarray, size: int, words: np.ndarray) -> np.ndarray:
    return mix(_class_key(grams, size) + mix(words))


def _item_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each shared gram of an item with each of the item's words (and how often the item holds the word)."""
    for batch in batches:
        for item, gram, words in zip(batch["item"].to_pylist(), batch["gram"].to_pylist(), batch["words"].to_pylist(), strict=True):
            word, times = np.unique(np.array(words, np.int64).view(np.uint64), return_counts=True)
            grams, size = np.full(len(word), gram, np.int64), int(_size_class(len(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(word), item)), pa.array(np.full(len(word), len(words))), pa.array(grams),
                 pa.array(np.full(len(word), size)), pa.array(_pair_key(grams.view(np.uint64), size, word).view(np.int64)),
                 pa.array(times)], ["item", "n", "gram", "size", "key", "times"])


def _class_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [_class_key(np.array([g], np.int64).view(np.uint64), s)[0]
                for g, s in zip(batch["gram"].to_pylist(), batch["size"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64))], ["key"])


def _set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = (keys & np.uint64(FILTER_BITS - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _near(words: np.ndarray, grams: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int, bits: np.ndarray
          ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in ``at``, key) of every gram with a word near it that the bitmap of pairs lets through.

    An item of n words aligns within 3 n words of the gram, and n is below 2^(size + 1).
    """
    reach = 3 << (size + 1)
    reach = min(reach, int((hi - lo).max(initial=0)))
    offsets = np.arange(-reach, reach)
    step = max(1, _BLOCK // max(1, len(offsets)))
    for k in range(0, len(at), step):
        some = slice(k, k + step)
        place = at[some, None] + offsets
        inside = (place >= lo[some, None]) & (place < hi[some, None])
        row, col = np.nonzero(inside)
        keys = _pair_key(grams[at[some]][row], size, words[place[row, col]])
        kept = _set(bits, keys)
        row, keys = row[kept] + k, keys[kept]
        order = np.lexsort((keys, row))
        row, keys = row[order], keys[order]
        once = np.ones(len(row), bool)
        once[1:] = (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])
        yield row[once], keys[once]


def _lookup(bits, sizes: list[int], classes, pairs, size_classes: list[int]):
    """Grams (of ``sizes`` words) of the documents that the bitmap ``bits`` lets through, with their places,
    and pairs of a shared gram (``classes``) and a near word that ``pairs`` lets through."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].cast(pa.int64())
            for first, texts in chunks(_spaced(batch)):
                words, counts = word_hashes(texts, PUNCTUATION)
                ends = np.cumsum(counts)

                def rows(at, doc, keys, paired, first=first, starts=ends - counts):
                    return pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(first + doc)), pa.array(keys.view(np.int64)), pa.array(at - starts[doc]),
                         pa.array(np.full(len(at), paired))], ["doc_id", "gram", "pos", "paired"])

                def inside(g, marked, size, ends=ends):
                    at = np.flatnonzero(marked)
                    doc = np.searchsorted(ends, at, "right")
                    whole = at + size <= ends[doc]
                    return at[whole], doc[whole]
                for size in sizes:
                    g = ngram_hashes(words, size)
                    at, doc = inside(g, _set(bits.value, g), size)
                    yield rows(at, doc, g[at], False)
                g = ngram_hashes(words, GRAM) if size_classes else np.zeros(0, np.uint64)
                for size in size_classes:
                    at, doc = inside(g, _set(classes.value, _class_key(g, size)), GRAM)
                    for row, keys in _near(words, g, at, (ends - counts)[doc], ends[doc], size, pairs.value):
                        yield rows(at[row], doc[row], keys, True)
    return look


def smith_waterman(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """(best local score, end of the first best alignment in ``words``)."""
    h = np.zeros(len(words) + 1, np.int64)
    steps = GAP * np.arange(len(words) + 1)
    best, end = 0, 0
    for w in item:
        diagonal = h[:-1] + np.where(words == w, MATCH, -MISMATCH)
        h[1:] = np.maximum(np.maximum(diagonal, h[1:] - GAP), 0)
        h = np.maximum.accumulate(h + steps) - steps  # gaps along the document
        h[0] = 0
        k = int(h.argmax())
        if h[k] > best or (h[k] == best and 0 < best and k < end):
            best, end = int(h[k]), k
    return best, end


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last_text, words = None, np.zeros(0, np.uint64)
    for batch in batches:
        rows = []
        for doc_id, text, key, item, block in zip(
                batch["doc_id"].to_pylist(), _spaced(batch)["text"].cast(pa.binary()).to_pylist(),
                batch["item"].to_pylist(), batch["words"].to_pylist(), batch["block"].to_pylist(), strict=True):
            if text != last_text:
                last_text, words = text, word_hashes([text], PUNCTUATION)[0]
            item, n = np.array(item, np.int64).view(np.uint64), len(item)
            lo, hi = max(0, (block - 1) * n), min(len(words), (block + 3) * n)
            if np.isin(item, words[lo:hi]).sum() < THRESHOLD * n:
                continue  # even with every word matched and no gap the score is too low
            score, end = smith_waterman(item, words[lo:hi])
            if score >= THRESHOLD * MATCH * n:
                _, back = smith_waterman(item[::-1], words[lo:lo + end][::-1])
                rows.append((doc_id, key, score / (MATCH * n), lo + end - back, lo + end))
        cols = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                         ["doc_id", "item", "score", "start_word", "end_word"])


def contaminated(docs: DataFrame, benchmark: DataFrame, shared: int = SHARED) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word of every contaminated (document, item)."""
    context = docs.sparkSession.sparkContext
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    named = (benchmark.select("item_id", "text").where(F.col("item_id").isNotNull())
             .mapInArrow(_item_words, "item_id long, words array<long>")
             .where(F.size("words") > 0).withColumn("item", F.xxhash64("words")).distinct())
    named = stored(named, "items")
    items = named.select("item", "words").distinct()

    place = stored(items.mapInArrow(_grams, "item long, n long, at long, gram long"), "places")
    short, full = place.where(F.col("n") < GRAM), place.where(F.col("n") >= GRAM)
    common = full.groupBy("gram").agg(F.countDistinct("item").alias("held")).where(F.col("held") > shared).select("gram")
    near = stored(full.join(common, "gram", "left_semi").select("item", "gram").distinct().join(items, "item")
                  .select("item", "gram", "words").mapInArrow(_item_pairs, _PAIRS), "pairs")
    alone = full.join(common, "gram", "left_anti")

    bits = context.broadcast(bitmap(alone.select("gram").unionAll(short.select("gram")), "gram"))
    classes = context.broadcast(bitmap(near.select("gram", "size").distinct().mapInArrow(_class_keys, "key long"), "key"))
    pairs = context.broadcast(bitmap(near, "key"))
    sizes = [GRAM, *sorted(r["n"] for r in short.select("n").distinct().collect())]  # at most GRAM of them
    size_classes = sorted(r["size"] for r in near.select("size").distinct().collect())  # logarithms
    found = stored(docs.mapInArrow(_lookup(bits, sizes, classes, pairs, size_classes), _FOUND), "found")
    single, paired = found.where("not paired"), found.where("paired")

    # Of an item's words near a gram, the rarest that make up more than half of its places.
    seen = paired.groupBy(F.col("gram").alias("key")).agg(F.count(F.lit(1)).alias("df"))
    before = (Window.partitionBy("item", "gram").orderBy(F.coalesce("df", F.lit(0)), "key")
              .rowsBetween(Window.unboundedPreceding, -1))
    rarest = (near.join(seen, "key", "left").withColumn("before", F.coalesce(F.sum("times").over(before), F.lit(0)))
              .where((F.col("before") <= F.floor(F.col("n") / 2)) & F.col("df").isNotNull())
              .select("item", "gram", "key").join(place, ["item", "gram"]).select("item", "n", "at", F.col("key").alias("gram")))

    block = F.floor((F.col("pos") - F.col("at")) / F.col("n")).alias("block")
    stretches = (single.join(alone, "gram").select("doc_id", "item", block)
                 .unionAll(paired.join(rarest, "gram").select("doc_id", "item", block)).distinct())
    stretches = stored(stretches, "stretches")
    marked = may_contain(docs, F.col("doc_id"), stretches.select("doc_id")).where("_may").select("doc_id", "text")
    aligned = (stretches.join(items, "item").join(marked, "doc_id").select("doc_id", "text", "item", "words", "block")
               .mapInArrow(_align, _ALIGNED))
    if len(sizes) > 1:
        first = (single.join(short.select("gram").distinct(), "gram", "left_semi").groupBy("doc_id", "gram")
                 .agg(F.min("pos").alias("pos")))
        whole = first.join(short, "gram")
        aligned = aligned.unionAll(whole.select("doc_id", "item", F.lit(1.0), "pos", F.col("pos") + F.col("n")))
    best = F.max(F.struct("score", (-F.col("start_word")).alias("s"), "end_word")).alias("m")
    scored = aligned.groupBy("doc_id", "item").agg(best)
    named = named.select("item_id", "item").distinct()
    return stored(scored.join(named, "item").groupBy("doc_id", "item_id").agg(F.max("m").alias("m")).select(
        "doc_id", "item_id", "m.score", (-F.col("m.s")).alias("start_word"), "m.end_word"), "contaminated")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, with all their columns."""
    return drop_ids(docs, contaminated(docs, benchmark).select("doc_id"))
