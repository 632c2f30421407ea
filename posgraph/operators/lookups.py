"""Purchase history, purchasers and purchase statistics.

Each query has a single-id form (the original call) and an all-ids form that
answers every person/product in one distributed job:

* single id: a point filter on the edge table (row-group skipping on the
  person-clustered files, or on the product-clustered copy for a product) and
  ``orderBy + limit``, which plans as ``TakeOrderedAndProject`` (per-task top-k,
  then merge); only those rows are joined to the node table;
* all ids: ``row_number() over (partition by id ...) <= k`` — the planner
  puts a partial ``WindowGroupLimit`` before the shuffle, so a person with a
  third of all edges sends at most k rows per map task.

Ordering: newest first with null times first (as a descending graph sort
puts them), then product/person id and edge id, so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posgraph.functions.dates import date_bounds
from posgraph.operators.graph import Graph


def _in_range(edges: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """Inclusive date bounds on the text datetime; no bound when None/''."""
    lo, hi = date_bounds(start_date, end_date)
    if lo is not None:
        edges = edges.where(F.col("datetime") >= F.lit(lo))
    if hi is not None:
        edges = edges.where(F.col("datetime") <= F.lit(hi))
    return edges


def _newest_first(*tie: str) -> list[Column]:
    return [F.col("datetime").desc_nulls_first(), *[F.col(c).asc_nulls_first() for c in tie]]


def _top(df: DataFrame, order: list[Column], limit: int | None, by: str | None) -> DataFrame:
    if by is None:
        df = df.orderBy(*order)
        return df if limit is None else df.limit(limit)
    if limit is None:
        return df
    w = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")


def _with_names(g: Graph, edges: DataFrame, node: str) -> DataFrame:
    """Edges with the names of their product, or the traits of their person."""
    if node == "product":
        names = g.product.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    else:
        names = g.person.select(F.col("id").alias("person_id"), "gender", "prefecture")
    return edges.join(names, f"{node}_id")


def _history(g: Graph, edges: DataFrame, node: str, limit: int | None, by: str | None) -> DataFrame:
    """The newest ``limit`` edges (of each ``by``), then their names.

    Ranking comes first, so at most ``limit`` edges a key reach the join (every
    edge of a graph has its end nodes, so the join drops none).
    """
    order = _newest_first(f"{node}_id", "id")
    rows = _with_names(g, _top(edges, order, limit, by), node)
    return rows.orderBy(*order) if by is None else rows


PERSON_PURCHASE_COLS = ["product_id", "product_name", "purchase_date", "quantity", "amount",
                        "payment_method", "store_id"]


def person_purchases(g: Graph, person_id: str, limit: int | None = 10,
                     start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """One person's purchases, newest first."""
    e = _in_range(g.purchase.where(F.col("person_id") == F.lit(person_id)), start_date, end_date)
    rows = _history(g, e, "product", limit, None)
    return rows.select(*PERSON_PURCHASE_COLS[:2], F.col("datetime").alias("purchase_date"),
                       *PERSON_PURCHASE_COLS[3:])


def person_purchases_all(g: Graph, limit: int | None = 10, start_date: str | None = None,
                         end_date: str | None = None) -> DataFrame:
    """T1 for every person: (person_id, ...) with at most ``limit`` rows per person."""
    rows = _history(g, _in_range(g.purchase, start_date, end_date), "product", limit, "person_id")
    return rows.select("person_id", *PERSON_PURCHASE_COLS[:2], F.col("datetime").alias("purchase_date"),
                       *PERSON_PURCHASE_COLS[3:])


PURCHASER_COLS = ["person_id", "gender", "prefecture", "purchase_date", "quantity", "amount", "store_id"]


def product_purchasers(g: Graph, product_id: str, limit: int | None = 10,
                       start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Buyers of one product, newest purchase first."""
    e = _in_range(g.purchases_of_products().where(F.col("product_id") == F.lit(product_id)), start_date, end_date)
    rows = _history(g, e, "person", limit, None)
    return rows.select(*PURCHASER_COLS[:3], F.col("datetime").alias("purchase_date"), *PURCHASER_COLS[4:])


def product_purchasers_all(g: Graph, limit: int | None = 10, start_date: str | None = None,
                           end_date: str | None = None) -> DataFrame:
    """T2 for every product: (product_id, ...) with at most ``limit`` rows per product."""
    rows = _history(g, _in_range(g.purchase, start_date, end_date), "person", limit, "product_id")
    return rows.select("product_id", *PURCHASER_COLS[:3], F.col("datetime").alias("purchase_date"),
                       *PURCHASER_COLS[4:])


def _stats_aggs() -> list[Column]:
    n = F.count(F.lit(1))
    amount = F.sum("amount")
    return [
        n.alias("total_purchases"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("decimal(28,3)").alias("total_quantity"),
        F.coalesce(amount, F.lit(0)).cast("decimal(28,2)").alias("total_amount"),
        F.try_divide(amount.cast("double"), n.cast("double")).alias("avg_amount"),
    ]


def _categories(c: str = "major_category") -> Column:
    return F.array_sort(F.collect_set(c)).alias("categories")


def person_statistics(g: Graph, person_id: str) -> DataFrame:
    """A5 (person): exactly one row; zeros and null average for a person without purchases."""
    e = g.purchase.where(F.col("person_id") == F.lit(person_id))
    rows = e.join(g.product.select(F.col("id").alias("product_id"), "major_category"), "product_id")
    return rows.agg(*_stats_aggs(), _categories())


def product_statistics(g: Graph, product_id: str) -> DataFrame:
    """A5 (product): exactly one row, with the number of distinct buyers."""
    e = g.purchases_of_products().where(F.col("product_id") == F.lit(product_id))
    rows = e.join(g.person.select(F.col("id").alias("person_id")), "person_id")
    return rows.agg(*_stats_aggs(), F.countDistinct("person_id").alias("unique_customers"))


def person_statistics_all(g: Graph) -> DataFrame:
    """A5 for every person node (persons without purchases get the zero row).

    The category set per person is bounded by the number of categories of
    the catalogue, not by the number of purchases.
    """
    rows = g.purchase.join(g.product.select(F.col("id").alias("product_id"), "major_category"),
                           "product_id")
    agg = rows.groupBy("person_id").agg(*_stats_aggs(), _categories())
    return _zero_fill(g.person.select(F.col("id").alias("person_id")), agg, "person_id",
                      extra={"categories": F.array().cast("array<string>")})


def product_statistics_all(g: Graph) -> DataFrame:
    """A5 for every product node."""
    rows = g.purchase.join(g.person.select(F.col("id").alias("person_id")), "person_id")
    agg = rows.groupBy("product_id").agg(*_stats_aggs(),
                                         F.countDistinct("person_id").alias("unique_customers"))
    return _zero_fill(g.product.select(F.col("id").alias("product_id")), agg, "product_id",
                      extra={"unique_customers": F.lit(0).cast("bigint")})


def _zero_fill(ids: DataFrame, agg: DataFrame, key: str, extra: dict[str, Column]) -> DataFrame:
    j = ids.join(agg, key, "left")
    zero = {
        "total_purchases": F.lit(0).cast("bigint"),
        "total_quantity": F.lit(0).cast("decimal(28,3)"),
        "total_amount": F.lit(0).cast("decimal(28,2)"),
        **extra,
    }
    return j.select(key, *[F.coalesce(F.col(c), zero[c]).alias(c) if c in zero else F.col(c)
                           for c in agg.columns if c != key])
