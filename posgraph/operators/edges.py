"""Purchase and visit edges from POS lines (flat frames).

Grains
------
purchases: ``receipt`` keeps one line per receipt (the committed id:
store_day_time_register_receipt); ``line`` adds the line number so every
product of a receipt survives.

visits: ``store_day`` is one visit per store and day, whoever came (the
committed id); ``receipt`` is one visit per receipt.  The visit total is the
sum of sales over *all* lines of the visit key, anonymous lines included.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posgraph.functions.columns import compact_datetime, joined_id
from posgraph.operators.dedupe import keep_one

RECEIPT_KEY = ["SHOP_CD", "SALES_YMD", "SALES_HMS", "REGISTER_NO", "RECEIPT_NO"]
PURCHASE_ID = {"receipt": RECEIPT_KEY, "line": RECEIPT_KEY + ["SALES_DETAIL_NO"]}
VISIT_KEY = {"store_day": ["SHOP_CD", "SALES_YMD"], "receipt": RECEIPT_KEY}


def _grain(table: dict, grain: str) -> list[str]:
    if grain not in table:
        raise ValueError(f"unknown grain {grain!r}; expected one of {sorted(table)}")
    return table[grain]


def purchase_lines(pos: DataFrame, grain: str = "line") -> DataFrame:
    """Every sales line with a customer as a purchase row (not deduplicated)."""
    c = F.col
    return pos.where(c("CUSTOMER_ID").isNotNull()).select(
        joined_id(*_grain(PURCHASE_ID, grain)).alias("id"),
        c("CUSTOMER_ID").alias("person_id"),
        c("ITEM_CD_UNIQUE").alias("product_id"),
        compact_datetime().alias("datetime"),
        c("SALES_NUM").try_cast("decimal(18,3)").alias("purchase_details_quantity"),
        c("SALES_AMT").alias("purchase_details_amount"),
        c("SALES_AMT_TAX_EXCLUDED").alias("purchase_details_amount_without_tax"),
        c("PAYMENTS_DIV").alias("purchase_details_payment_method"),
        c("PAYMENTS_KIND").alias("purchase_details_payment_type"),
        c("SHOP_CD").alias("purchase_details_store_id"),
        c("DISCOUNT_PRICE").alias("discount_info_discount_amount"),
        c("PRICE_DOWN_AMT").alias("discount_info_price_down_amount"),
        c("DISCOUNT_DIV_1").alias("discount_info_discount_type1"),
        c("DISCOUNT_DIV_2").alias("discount_info_discount_type2"),
        c("DISCOUNT_DIV_3").alias("discount_info_discount_type3"),
    )


def purchases(pos: DataFrame, grain: str = "receipt") -> DataFrame:
    """Purchase edges, one per id (flat)."""
    return keep_one(purchase_lines(pos, grain), ["id"])


def visit_totals(pos: DataFrame, grain: str = "store_day") -> DataFrame:
    """A1: sales total per visit key over all lines (anonymous included)."""
    keys = _grain(VISIT_KEY, grain)
    return pos.groupBy(*keys).agg(F.sum("SALES_AMT").cast("decimal(28,2)").alias("total_amount"))


def visits(pos: DataFrame, grain: str = "store_day") -> DataFrame:
    """Visit edges with the visit total (flat), one per visit id.

    One aggregation of the lines by visit key gives both: the total over all
    lines, and the first line with a customer in the total order (the smallest
    struct; nulls first, as everywhere).  Both combine map-side, so a hot store
    sends one row per map task.  Lines whose key has a null part have no total,
    and keys without a customer have no visit.
    """
    keys = _grain(VISIT_KEY, grain)
    c = F.col
    order = {
        "person_id": c("CUSTOMER_ID"),
        "store_id": c("SHOP_CD"),
        "datetime": compact_datetime(),
        "visit_details_company_id": c("COMPANY_CD_UNIQUE"),
        "visit_details_register_no": c("REGISTER_NO"),
        "visit_details_conversion_converted": F.lit(True),
        "visit_details_conversion_purchase_id": F.concat_ws("_", c("RECEIPT_NO"), c("SALES_DETAIL_NO")),
    }
    line = F.struct(*[e.alias(name) for name, e in order.items()])
    by_key = (pos.where(reduce(and_, [c(k).isNotNull() for k in keys])).groupBy(*keys).agg(
        F.sum("SALES_AMT").cast("decimal(28,2)").alias("total_amount"),
        F.min(F.when(c("CUSTOMER_ID").isNotNull(), line)).alias("line")))
    return by_key.where(c("line").isNotNull()).select(joined_id(*keys).alias("id"), "line.*", "total_amount")


def extract_relationships(pos: DataFrame, purchase_grain: str = "receipt",
                          visit_grain: str = "store_day") -> tuple[DataFrame, DataFrame]:
    """Both edge sets (flat, lazy)."""
    return purchases(pos, purchase_grain), visits(pos, visit_grain)


def relationship_counts(purchase_frame: DataFrame, visit_frame: DataFrame) -> DataFrame:
    """(name, count) of the two edge frames, as one small job."""
    p = purchase_frame.agg(F.count(F.lit(1)).alias("count")).select(F.lit("purchases").alias("name"), "count")
    v = visit_frame.agg(F.count(F.lit(1)).alias("count")).select(F.lit("visits").alias("name"), "count")
    return p.unionByName(v)
