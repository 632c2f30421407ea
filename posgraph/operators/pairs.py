"""Item pairs within a person's basket, split so no basket lands on one task.

Association rules count, for every pair of items, the persons who bought
both; the pairs of one basket are the unit of work.  A plain self-join on
the person puts all pairs of a basket into one task, which is quadratic in
the basket — fatal for a wholesale account holding a third of all lines.

Here each basket of ``n`` items is cut into ``s = ceil(n / chunk)`` hash
slices of its items, and the pairs are produced per (person, slice i, slice
j) with i <= j.  A task sees at most ``chunk`` x ``chunk`` item pairs, and
each unordered pair is produced exactly once:

* a left row of slice ``i`` is replicated to the slice pairs (i, j), j >= i;
* a right row of slice ``j`` is replicated to the slice pairs (i, j), i <= j;
* within one slice (i == j) the order test ``a < b`` keeps one orientation;
  across slices (i < j) the pair appears once with the lower slice on the left.

An ordinary basket (n <= chunk) has s = 1 and costs exactly what the plain
self-join costs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posgraph.operators.bitmaps import slot_of, with_set_slots

PAIR_BUCKETS = 1 << 22  # hash buckets of the first count: its bitmap has 512 kB, whatever the input


def basket_pairs(baskets: DataFrame, person: str = "person_id", item: str = "product_id",
                 chunk: int = 2048, counts: DataFrame | None = None) -> DataFrame:
    """Distinct (person, item) rows -> (person, item_a, item_b) with item_a < item_b.

    ``counts`` is (person, n): an upper bound of each basket's size (the stored
    degree index); without it the baskets are counted.
    """
    # Only baskets larger than ``chunk`` need more than one slice.  Their
    # persons are few (at most rows / chunk) and are broadcast: planned from
    # the size of ``counts``, all baskets would be shuffled once more for them.
    if counts is None:
        counts = baskets.groupBy(person).agg(F.count(F.lit(1)).alias("n"))
    heavy = F.broadcast(counts.where(F.col("n") > F.lit(chunk))
                        .select(person, F.ceil(F.col("n") / F.lit(chunk)).cast("int").alias("_s")))
    sliced = (baskets.join(heavy, person, "left")
              .withColumn("_s", F.coalesce(F.col("_s"), F.lit(1)))
              .withColumn("_c", F.pmod(F.xxhash64(F.col(item)), F.col("_s")).cast("int")))
    left = sliced.select(
        person, F.col("_c").alias("_i"),
        F.explode(F.sequence(F.col("_c"), F.col("_s") - 1)).alias("_j"),
        F.col(item).alias("item_a"))
    right = sliced.select(
        person, F.explode(F.sequence(F.lit(0), F.col("_c"))).alias("_i"),
        F.col("_c").alias("_j"),
        F.col(item).alias("item_b"))
    joined = left.join(right, [person, "_i", "_j"])
    keep = (F.col("_i") < F.col("_j")) | (F.col("item_a") < F.col("item_b"))
    return joined.where(keep).select(
        person,
        F.least("item_a", "item_b").alias("item_a"),
        F.greatest("item_a", "item_b").alias("item_b"))


def count_pairs(pairs: DataFrame, enough: Callable[[Column], Column] | None = None, buckets: int = PAIR_BUCKETS) -> DataFrame:
    """(item_a, item_b, n_both) of the pairs whose count is ``enough`` (of all without it).

    With ``enough`` (a test that holds for every larger count too) the pairs are
    counted twice.  The first count is by hash bucket, combined map-side to at
    most ``buckets`` rows a task; a pair can only be frequent if its bucket is, so
    the second, exact count sees the pairs whose bucket's bit is set.  The
    bitmap is broadcast: ``buckets / 8`` bytes.  Where all buckets are frequent (many
    more pairs than buckets) the result is the same and nothing is saved.
    """
    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("n_both"))
    if enough is None:
        return counted(pairs)
    slot = slot_of(buckets, "item_a", "item_b")
    frequent = pairs.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("n")).where(enough(F.col("n")))
    likely = with_set_slots(pairs, slot, frequent.select("_slot"))
    return counted(likely.select("item_a", "item_b")).where(enough(F.col("n_both")))
