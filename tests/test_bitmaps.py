"""Rows that a join does not need stay out of its shuffles."""

from contextlib import contextmanager

from posgraph.operators import recommend, similarity
from posgraph.operators.bitmaps import likely_in
from posgraph.operators.pairs import basket_pairs
from posgraph.operators.skew import salted_join

from tests.conftest import graph_of


@contextmanager
def no_broadcast(spark):
    """Tables count as too large for a broadcast by their size."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_likely_in_loses_no_row(spark):
    rows = spark.range(100_000).selectExpr("cast(id as string) AS k", "id AS v")
    ids = spark.range(0, 100_000, 100).selectExpr("cast(id as string) AS k")
    kept = {r["k"] for r in likely_in(rows, "k", ids).collect()}
    assert {str(i) for i in range(0, 100_000, 100)} <= kept and len(kept) < 1_100


def test_hot_keys_cost_no_shuffle(spark):
    big = spark.range(50).selectExpr("cast(id % 5 as string) AS p", "cast(id as string) AS q")
    counts = big.groupBy("p").count().withColumnRenamed("count", "n")
    small = spark.range(3).selectExpr("cast(id as string) AS p")
    with no_broadcast(spark):
        joins = [salted_join(big, small, "p", counts, per_task=4),
                 basket_pairs(big, "p", "q", 4, counts),
                 similarity.sliced_product(big, big.withColumnRenamed("q", "r"), "p", "q", "r", counts, 4)]
        for df, n in zip(joins, (30, 5 * 45, 500), strict=True):
            assert "LeftOuter" not in [w for line in plan(df).splitlines() if "SortMergeJoin" in line for w in line.replace(",", "").split()]
            assert df.count() == n


def test_only_the_partners_edges_are_shuffled(spark):
    g = graph_of(spark, [("A", "p", "1", "2024"), ("A", "q", "2", "2024"), ("B", "p", "3", "2024"), ("B", "r", "4", "2024"),
                         ("C", "s", "5", "2024"), ("C", "t", "6", "2024")])
    with no_broadcast(spark):
        df = recommend.user_recommendations(g, "A", 2, 0.01)
        assert "getbit" in plan(df) or "bit_get" in plan(df)
        assert [(r["product_id"], r["similar_user_id"]) for r in df.collect()] == [("r", "B")]
        related = recommend.related_products(g, "p").collect()
        assert [(r["product_id"], r["frequency"]) for r in related] == [("q", 1), ("r", 1)]
