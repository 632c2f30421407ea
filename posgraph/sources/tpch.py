"""Adapter: the driver's TPC-H-style tables as POS detail lines.

The mapping is a fixed specification (the same one the SQL oracle uses as a
CTE), so both engines see identical POS rows.  It is a plain join plan:
orders take their customer and two lookups into ``nation`` first (25 rows by
definition of the schema, broadcast), then meet lineitem on the order key (the
one big/big join, sort-merge at scale; lineitem is hash-partitioned on that key
up front), then part (AQE picks the strategies at run time from real sizes).

Rules built into the mapping: every tenth receipt is anonymous; some birth
months are null; some dates are null or malformed; schedule price and discount
are sometimes null; returned lines carry sign '-'; a receipt belongs to one
store; 25 stores in 5 companies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posgraph.schemas import POS_COLUMNS

TPCH_TABLES = ("lineitem", "orders", "customer", "part", "nation")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def pos_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POS detail lines (``schemas.POS_SCHEMA`` column order) from the driver tables."""
    # Hash-partition the fact table on the order key.  At scale the
    # lineitem x orders sort-merge join needs exactly this exchange, so it is
    # reused, not added; on small inputs (one file, one row group) it is what
    # spreads the line expressions over all cores instead of one scan task.
    l = read_table(spark, sf_dir, "lineitem").repartition("l_orderkey").alias("l")
    o = read_table(spark, sf_dir, "orders").alias("o")
    c = read_table(spark, sf_dir, "customer").alias("c")
    p = read_table(spark, sf_dir, "part").alias("p")
    nation = read_table(spark, sf_dir, "nation")
    cn = F.broadcast(nation.select(F.col("n_nationkey").alias("cn_key"),
                                   F.col("n_name").alias("cn_name")))
    sn = F.broadcast(nation.select(F.col("n_nationkey").alias("sn_key"),
                                   F.col("n_regionkey").alias("sn_region")))

    ok = F.col("o.o_orderkey")
    ck = F.col("c.c_custkey")
    pk = F.col("p.p_partkey")
    joined = (
        l.join(o.join(c, ck == F.col("o.o_custkey"))
               .join(cn, F.col("cn_key") == F.col("c.c_nationkey"))
               .join(sn, F.col("sn_key") == ok % 25), F.col("l.l_orderkey") == ok)
        .join(p, pk == F.col("l.l_partkey"))
    )

    seg = F.col("c.c_mktsegment")
    retail = F.col("p.p_retailprice")
    ptype = F.col("p.p_type")
    brand = F.col("p.p_brand")
    size = F.col("p.p_size")
    odate = F.col("o.o_orderdate")
    amt = F.col("l.l_extendedprice").cast("decimal(18,2)")

    cols = {
        "CUSTOMER_ID": _null_when(ok % 10 == 0, _pad(ck, 10)),
        "SEX": _null_when(ck % 11 == 0, _s(ck % 3)),
        "BIRTHDAY_Y": _s(1950 + ck % 55),
        "BIRTHDAY_M": _null_when(ck % 17 == 0, _s(1 + ck % 12)),
        "BIRTHDAY_D": _s(1 + ck % 28),
        "ZIP_CODE": _pad(ck % 1000, 7),
        "PREFECTURE": F.col("cn_name"),
        "LATITUDE": _s(30 + F.col("c.c_nationkey") % 15),
        "LONGITUDE": _s(130 + F.col("c.c_nationkey") % 15),
        "DM_STOP_TYPE": F.when(seg == "BUILDING", F.lit("Y"))
                         .when(seg == "MACHINERY", F.lit(None).cast("string"))
                         .otherwise(F.lit("N")),
        "EMAIL_STOP_TYPE": F.when(ck % 2 == 0, "Y").otherwise("N"),
        "TEL_STOP_TYPE": F.when(ck % 3 == 0, "Y").otherwise("N"),
        "MAIL_PC_FLG": F.when(ck % 4 == 0, "Y").otherwise("N"),
        "MAIL_MOBILE_FLG": F.when(ck % 5 == 0, "Y").otherwise("N"),
        "MEMBER_ID": F.concat(F.lit("M"), _pad(ck, 10)),
        "CARD_ID": F.concat(F.lit("C"), _pad(ck, 10)),
        "CARD_STS": F.when(F.col("c.c_acctbal") < 0, "9").otherwise("1"),
        "START_DATE": F.concat(_s(2010 + ck % 10), F.lit("-01-15")),
        "END_DATE": F.when(ck % 5 == 0, "2024-06-30"),
        "EXPIRATION_DATE": F.when(ck % 97 == 0, "not-a-date").otherwise("2030-12-31"),
        "REGIST_YMD": F.lit("2009-12-01"),
        "ITEM_CD_UNIQUE": _pad(pk, 13),
        "PD_NM": F.col("p.p_name"),
        "PD_NM_KANA": F.upper(F.col("p.p_name")),
        "ITEM_CATEGORY_LV1_CD": ptype,
        "ITEM_CATEGORY_LV2_CD": brand,
        "ITEM_CATEGORY_LV3_CD": _s(size),
        "GRP_CD": brand,
        "GRP_KJ": F.concat(F.lit("group "), brand),
        "GRP_KN": F.upper(F.concat(F.lit("group "), brand)),
        "DEPT_CD": ptype,
        "DEPT_KJ": F.concat(F.lit("dept "), ptype),
        "DEPT_KN": F.upper(F.concat(F.lit("dept "), ptype)),
        "CLR_CD": _s(pk % 8),
        "CLR_NM": F.concat(F.lit("color "), _s(pk % 8)),
        "SZ_CD": _s(size),
        "SZ_NM": F.concat(F.lit("size "), _s(size)),
        "MFC_CD": _s(pk % 40),
        "SSN_CD": _s(pk % 4),
        "VARIATION_PRODUCT_NO": _s(pk % 3),
        "MASTER_PRICE": retail.cast("decimal(14,2)"),
        "SCHEDULE_PRICE": _null_when(pk % 7 == 0, retail.cast("decimal(14,2)")),
        "HYOUJUN_BAITANKA": retail.cast("decimal(14,2)"),
        "HYOUJUN_GENTANKA": size.cast("decimal(14,2)"),
        "ZEIRITSU": F.when(ptype == "ECONOMY", "8").otherwise("10"),
        "SHOP_CD": _pad(ok % 25, 4),
        "COMPANY_CD_UNIQUE": _s(F.col("sn_region")),
        "SALES_SIGN": F.when(F.col("l.l_returnflag") == "R", "-").otherwise("+"),
        "COUNTRY_CD": F.when(F.col("l.l_suppkey") % 20 == 0, "20").otherwise("10"),
        "SALES_YMD": (F.year(odate) * 10000 + F.month(odate) * 100 + F.dayofmonth(odate)).cast("int"),
        "SALES_HMS": F.concat(_pad(ok % 24, 2), _pad(ok % 60, 2), _pad(ok % 59, 2)),
        "REGISTER_NO": _s(100 + ok % 5),
        "RECEIPT_NO": _s(ok),
        "SALES_DETAIL_NO": _s(F.col("l.l_linenumber")),
        "SALES_NUM": F.col("l.l_quantity").cast("decimal(18,3)"),
        "SALES_AMT": amt,
        "SALES_AMT_TAX_EXCLUDED": (amt - F.col("l.l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)"),
        "PAYMENTS_DIV": F.col("o.o_orderpriority"),
        "PAYMENTS_KIND": F.col("o.o_orderstatus"),
        "DISCOUNT_PRICE": _null_when(F.col("l.l_discount") == 0,
                                     F.col("l.l_discount").cast("decimal(18,2)")),
        "PRICE_DOWN_AMT": F.col("l.l_tax").cast("decimal(18,2)"),
        "DISCOUNT_DIV_1": F.col("l.l_returnflag"),
        "DISCOUNT_DIV_2": F.col("l.l_linestatus"),
        "DISCOUNT_DIV_3": F.lit(None).cast("string"),
    }
    return joined.select([cols[name].alias(name) for name in POS_COLUMNS])
