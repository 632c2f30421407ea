"""Relationship reports, returned as frames (the caller shows or writes them).

All three are single aggregations with map-side partial aggregation, so a hot
product or store is combined inside each map task before the shuffle.
``countDistinct`` is planned as two aggregation levels (by store+person, then
by store), which keeps a hot store from collecting its visitors in one buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_products(purchases: DataFrame, k: int | None = 5) -> DataFrame:
    """Per product: purchase count, total quantity, total amount; busiest first."""
    out = (purchases.groupBy("product_id")
           .agg(F.count(F.lit(1)).alias("purchase_count"),
                F.sum("purchase_details_quantity").cast("decimal(28,3)").alias("total_quantity"),
                F.sum("purchase_details_amount").cast("decimal(28,2)").alias("total_amount"))
           .orderBy(F.col("purchase_count").desc(), F.col("product_id").asc_nulls_first()))
    return out.limit(k) if k is not None else out


def payment_mix(purchases: DataFrame) -> DataFrame:
    """Purchase count per payment method."""
    return (purchases.groupBy(F.col("purchase_details_payment_method").alias("payment_method"))
            .agg(F.count(F.lit(1)).alias("count")))


def top_stores(visits: DataFrame, k: int | None = 5) -> DataFrame:
    """Per store: visits and distinct visitors; busiest first."""
    out = (visits.groupBy("store_id")
           .agg(F.count(F.lit(1)).alias("visit_count"),
                F.countDistinct("person_id").alias("unique_visitors"))
           .orderBy(F.col("visit_count").desc(), F.col("store_id").asc_nulls_first()))
    return out.limit(k) if k is not None else out


def analyze_relationships(purchases: DataFrame, visits: DataFrame) -> dict[str, DataFrame]:
    return {
        "top_products": top_products(purchases),
        "payment_mix": payment_mix(purchases),
        "top_stores": top_stores(visits),
    }
