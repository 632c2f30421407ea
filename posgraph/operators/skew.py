"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed partition only when both join inputs are shuffle stages.
When the small side is an aggregate keyed like the join (one row per person,
say), the planner reuses its partitioning, AQE cannot split, and every row of
a hot key on the big side streams through a single task.

``salted_join`` spreads such keys explicitly: a key with ``n`` rows on the big
side gets ``ceil(n / rows_per_task)`` salts; each big-side row takes one salt
(a hash of the row), each small-side row of that key is replicated once per
salt, and the join runs on (key, salt).  Keys under the budget keep a single
salt, so the ordinary case is the plain shuffle join.  The hot keys are at
most ``total rows / rows_per_task`` and are broadcast: planned from the size of
``counts`` they would shuffle both sides once more, whatever their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posgraph.operators.bitmaps import likely_in

DEFAULT_ROWS_PER_TASK = 2_000_000


def rows_per_task(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("posgraph.skew.rowsPerTask", str(DEFAULT_ROWS_PER_TASK)))


def salted_join(big: DataFrame, small: DataFrame, key: str, counts: DataFrame, how: str = "inner",
                per_task: int | None = None, on: Sequence[str] = (), few: bool = False) -> DataFrame:
    """``big`` join ``small`` on ``key`` (and the columns ``on``) with hot keys spread over several tasks.

    ``counts`` is (key, n): an upper bound of the rows ``big`` has per key.
    ``how`` is ``inner`` or ``left_semi`` (rows of ``big`` are never duplicated).
    With ``few`` (``small`` is expected to name few of the keys) a bitmap of its
    keys keeps the other rows of ``big`` out of the shuffle.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("how must be 'inner' or 'left_semi'")
    if few:
        big = likely_in(big, key, small.select(key))
        small, how = (small.select(key).distinct(), "inner") if how == "left_semi" else (small, how)
    r = per_task or rows_per_task(big)
    hot = F.broadcast(counts.where(F.col("n") > F.lit(r))
                      .select(key, F.ceil(F.col("n") / F.lit(r)).cast("int").alias("_salts")))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    b = (big.join(hot, key, "left")
         .withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), salts).cast("int"))
         .drop("_salts"))
    s = (small.join(hot, key, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
         .drop("_salts"))
    return b.join(s, [key, "_salt", *on], how).drop("_salt")

