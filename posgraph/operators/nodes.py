"""Node sets from POS lines.

Each builder returns the *flat* frame (one column per leaf, named by path
with '_'), deduplicated on the node id under a total order (D1).  ``nested``
turns it into the nested shape written as JSON lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posgraph.functions.columns import birth_date, flag, nest, parse_timestamp, try_cast
from posgraph.operators.dedupe import keep_one
from posgraph.schemas import NESTED


def person_lines(pos: DataFrame) -> DataFrame:
    c = F.col
    return pos.select(
        c("CUSTOMER_ID").alias("id"),
        c("SEX").alias("gender"),
        birth_date("BIRTHDAY_Y", "BIRTHDAY_M", "BIRTHDAY_D").alias("birth_date"),
        c("ZIP_CODE").alias("location_zip_code"),
        c("PREFECTURE").alias("location_prefecture"),
        c("LATITUDE").alias("location_coordinates_latitude"),
        c("LONGITUDE").alias("location_coordinates_longitude"),
        flag("DM_STOP_TYPE").alias("contact_preferences_dm_stop"),
        flag("EMAIL_STOP_TYPE").alias("contact_preferences_email_stop"),
        flag("TEL_STOP_TYPE").alias("contact_preferences_tel_stop"),
        flag("MAIL_PC_FLG").alias("contact_preferences_mail_pc"),
        flag("MAIL_MOBILE_FLG").alias("contact_preferences_mail_mobile"),
        c("MEMBER_ID").alias("membership_member_id"),
        c("CARD_ID").alias("membership_card_id"),
        c("CARD_STS").alias("membership_status"),
        parse_timestamp("START_DATE").alias("membership_start_date"),
        parse_timestamp("END_DATE").alias("membership_end_date"),
        parse_timestamp("EXPIRATION_DATE").alias("membership_expiration_date"),
        parse_timestamp("REGIST_YMD").alias("membership_registration_date"),
    )


def product_lines(pos: DataFrame) -> DataFrame:
    c = F.col
    return pos.select(
        c("ITEM_CD_UNIQUE").alias("id"),
        c("PD_NM").alias("name"),
        c("PD_NM_KANA").alias("name_kana"),
        c("ITEM_CATEGORY_LV1_CD").alias("categories_major_category"),
        c("ITEM_CATEGORY_LV2_CD").alias("categories_medium_category"),
        c("ITEM_CATEGORY_LV3_CD").alias("categories_minor_category"),
        c("GRP_CD").alias("categories_group_code"),
        c("GRP_KJ").alias("categories_group_name"),
        c("GRP_KN").alias("categories_group_name_kana"),
        c("DEPT_CD").alias("categories_department_code"),
        c("DEPT_KJ").alias("categories_department_name"),
        c("DEPT_KN").alias("categories_department_name_kana"),
        c("CLR_CD").alias("attributes_color_code"),
        c("CLR_NM").alias("attributes_color_name"),
        c("SZ_CD").alias("attributes_size_code"),
        c("SZ_NM").alias("attributes_size_name"),
        c("MFC_CD").alias("attributes_maker_code"),
        c("SSN_CD").alias("attributes_season_code"),
        c("VARIATION_PRODUCT_NO").alias("attributes_variation_no"),
        try_cast("MASTER_PRICE", "decimal(14,2)").alias("pricing_master_price"),
        try_cast("SCHEDULE_PRICE", "decimal(14,2)").alias("pricing_schedule_price"),
        try_cast("HYOUJUN_BAITANKA", "decimal(14,2)").alias("pricing_standard_price"),
        try_cast("HYOUJUN_GENTANKA", "decimal(14,2)").alias("pricing_standard_cost"),
        try_cast("ZEIRITSU", "int").alias("pricing_tax_rate"),
    )


def store_lines(pos: DataFrame) -> DataFrame:
    return pos.select(F.col("SHOP_CD").alias("id"), F.col("COMPANY_CD_UNIQUE").alias("company_id"))


PERSON_SOURCE = [
    "CUSTOMER_ID", "SEX", "BIRTHDAY_Y", "BIRTHDAY_M", "BIRTHDAY_D", "ZIP_CODE", "PREFECTURE",
    "LATITUDE", "LONGITUDE", "DM_STOP_TYPE", "EMAIL_STOP_TYPE", "TEL_STOP_TYPE", "MAIL_PC_FLG",
    "MAIL_MOBILE_FLG", "MEMBER_ID", "CARD_ID", "CARD_STS", "START_DATE", "END_DATE",
    "EXPIRATION_DATE", "REGIST_YMD"]
PRODUCT_SOURCE = [
    "ITEM_CD_UNIQUE", "PD_NM", "PD_NM_KANA", "ITEM_CATEGORY_LV1_CD", "ITEM_CATEGORY_LV2_CD",
    "ITEM_CATEGORY_LV3_CD", "GRP_CD", "GRP_KJ", "GRP_KN", "DEPT_CD", "DEPT_KJ", "DEPT_KN",
    "CLR_CD", "CLR_NM", "SZ_CD", "SZ_NM", "MFC_CD", "SSN_CD", "VARIATION_PRODUCT_NO",
    "MASTER_PRICE", "SCHEDULE_PRICE", "HYOUJUN_BAITANKA", "HYOUJUN_GENTANKA", "ZEIRITSU"]


def _nodes(pos: DataFrame, source: list[str], id_col: str, project, keep_null_ids: bool) -> DataFrame:
    """Distinct source rows first, then derive and keep one row per id.

    Node attributes repeat on every line of a customer or item, so the
    ``distinct`` (a hash aggregate, combined map-side before its shuffle)
    shrinks the data to about one row per node before any parsing or
    sorting.  Exact: identical source rows derive identical node rows.
    """
    src = pos.select(*source)
    if not keep_null_ids:
        src = src.where(F.col(id_col).isNotNull())
    return keep_one(project(src.distinct()), ["id"])


def persons(pos: DataFrame, keep_null_ids: bool = False) -> DataFrame:
    """One row per customer id (flat).  Anonymous lines give no person."""
    return _nodes(pos, PERSON_SOURCE, "CUSTOMER_ID", person_lines, keep_null_ids)


def products(pos: DataFrame, keep_null_ids: bool = False) -> DataFrame:
    """One row per item code (flat)."""
    return _nodes(pos, PRODUCT_SOURCE, "ITEM_CD_UNIQUE", product_lines, keep_null_ids)


def stores(pos: DataFrame, keep_null_ids: bool = False) -> DataFrame:
    """Distinct (store, company) pairs."""
    lines = store_lines(pos)
    if not keep_null_ids:
        lines = lines.where(F.col("id").isNotNull())
    return lines.distinct()


def nested(flat: DataFrame, kind: str) -> DataFrame:
    """Flat node/edge frame -> nested JSON-lines shape (``kind`` in schemas.NESTED)."""
    return nest(flat, NESTED[kind])


def transform_all(pos: DataFrame) -> dict[str, DataFrame]:
    """P5: the three node sets, flat."""
    return {"persons": persons(pos), "products": products(pos), "stores": stores(pos)}
