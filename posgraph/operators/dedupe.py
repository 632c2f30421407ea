"""Keep one row per key under a total order.

``row_number() over (partition by key order by <other columns> nulls first) = 1``.
Because the limit is 1, the planner inserts a partial ``WindowGroupLimit``
before the shuffle: every map task keeps at most one row per key, so a hot key
(one product on a third of all lines) arrives at its reducer as at most one row
per map task instead of a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    keys = list(keys)
    if order is None:
        order = [c for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
