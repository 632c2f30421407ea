"""Declared schemas: POS detail, nested node/edge frames, flat graph tables.

Everything is declared up front.  JSON inference would lose decimals and
timestamps, and a field that is null on every row would vanish because
Spark's JSON writer omits null fields.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
DEC_PRICE = T.DecimalType(14, 2)
DEC_QTY = T.DecimalType(18, 3)
DEC_AMT = T.DecimalType(18, 2)
DEC_TOTAL = T.DecimalType(28, 2)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, S, True) for n in names]


# One row per receipt line.
POS_SCHEMA = T.StructType(
    _strings(
        "CUSTOMER_ID", "SEX", "BIRTHDAY_Y", "BIRTHDAY_M", "BIRTHDAY_D",
        "ZIP_CODE", "PREFECTURE", "LATITUDE", "LONGITUDE",
        "DM_STOP_TYPE", "EMAIL_STOP_TYPE", "TEL_STOP_TYPE", "MAIL_PC_FLG", "MAIL_MOBILE_FLG",
        "MEMBER_ID", "CARD_ID", "CARD_STS",
        "START_DATE", "END_DATE", "EXPIRATION_DATE", "REGIST_YMD",
        "ITEM_CD_UNIQUE", "PD_NM", "PD_NM_KANA",
        "ITEM_CATEGORY_LV1_CD", "ITEM_CATEGORY_LV2_CD", "ITEM_CATEGORY_LV3_CD",
        "GRP_CD", "GRP_KJ", "GRP_KN", "DEPT_CD", "DEPT_KJ", "DEPT_KN",
        "CLR_CD", "CLR_NM", "SZ_CD", "SZ_NM", "MFC_CD", "SSN_CD", "VARIATION_PRODUCT_NO",
    )
    + [T.StructField(n, DEC_PRICE, True)
       for n in ("MASTER_PRICE", "SCHEDULE_PRICE", "HYOUJUN_BAITANKA", "HYOUJUN_GENTANKA")]
    + _strings("ZEIRITSU", "SHOP_CD", "COMPANY_CD_UNIQUE", "SALES_SIGN", "COUNTRY_CD")
    + [T.StructField("SALES_YMD", T.IntegerType(), True)]
    + _strings("SALES_HMS", "REGISTER_NO", "RECEIPT_NO", "SALES_DETAIL_NO")
    + [T.StructField("SALES_NUM", DEC_QTY, True),
       T.StructField("SALES_AMT", DEC_AMT, True),
       T.StructField("SALES_AMT_TAX_EXCLUDED", DEC_AMT, True)]
    + _strings("PAYMENTS_DIV", "PAYMENTS_KIND")
    + [T.StructField("DISCOUNT_PRICE", DEC_AMT, True),
       T.StructField("PRICE_DOWN_AMT", DEC_AMT, True)]
    + _strings("DISCOUNT_DIV_1", "DISCOUNT_DIV_2", "DISCOUNT_DIV_3")
)

POS_COLUMNS = [f.name for f in POS_SCHEMA.fields]


def _struct(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


_CODE_NAME = _struct(_f("code", S), _f("name", S))
_CODE_NAME_KANA = _struct(_f("code", S), _f("name", S), _f("name_kana", S))

PERSON_NESTED = _struct(
    _f("id", S), _f("gender", S), _f("birth_date", S),
    _f("location", _struct(_f("zip_code", S), _f("prefecture", S),
                           _f("coordinates", _struct(_f("latitude", S), _f("longitude", S))))),
    _f("contact_preferences", _struct(*[_f(n, T.BooleanType()) for n in
                                        ("dm_stop", "email_stop", "tel_stop", "mail_pc", "mail_mobile")])),
    _f("membership", _struct(_f("member_id", S), _f("card_id", S), _f("status", S),
                             *[_f(n, T.TimestampNTZType()) for n in
                               ("start_date", "end_date", "expiration_date", "registration_date")])),
)

PRODUCT_NESTED = _struct(
    _f("id", S), _f("name", S), _f("name_kana", S),
    _f("categories", _struct(_f("major_category", S), _f("medium_category", S), _f("minor_category", S),
                             _f("group", _CODE_NAME_KANA), _f("department", _CODE_NAME_KANA))),
    _f("attributes", _struct(_f("color", _CODE_NAME), _f("size", _CODE_NAME),
                             _f("maker_code", S), _f("season_code", S), _f("variation_no", S))),
    _f("pricing", _struct(*[_f(n, DEC_PRICE) for n in
                            ("master_price", "schedule_price", "standard_price", "standard_cost")],
                          _f("tax_rate", T.IntegerType()))),
)

STORE_NESTED = _struct(_f("id", S), _f("company_id", S))

PURCHASE_NESTED = _struct(
    _f("id", S), _f("person_id", S), _f("product_id", S), _f("datetime", S),
    _f("purchase_details", _struct(_f("quantity", DEC_QTY), _f("amount", DEC_AMT),
                                   _f("amount_without_tax", DEC_AMT), _f("payment_method", S),
                                   _f("payment_type", S), _f("store_id", S))),
    _f("discount_info", _struct(_f("discount_amount", DEC_AMT), _f("price_down_amount", DEC_AMT),
                                _f("discount_type1", S), _f("discount_type2", S), _f("discount_type3", S))),
)

VISIT_NESTED = _struct(
    _f("id", S), _f("person_id", S), _f("store_id", S), _f("datetime", S),
    _f("visit_details", _struct(_f("company_id", S), _f("register_no", S),
                                _f("conversion", _struct(_f("converted", T.BooleanType()),
                                                         _f("purchase_id", S))))),
    _f("total_amount", DEC_TOTAL),
)

NESTED = {
    "persons": PERSON_NESTED,
    "products": PRODUCT_NESTED,
    "stores": STORE_NESTED,
    "purchases": PURCHASE_NESTED,
    "visits": VISIT_NESTED,
}

# Flat graph tables (one property per column).
PERSON_TABLE = _struct(*[_f(n, S) for n in (
    "id", "gender", "birth_date", "prefecture", "zip_code", "latitude", "longitude",
    "member_id", "status")])

PRODUCT_TABLE = _struct(
    *[_f(n, S) for n in ("id", "name", "name_kana", "major_category", "medium_category",
                         "minor_category", "group_code", "group_name", "department_code",
                         "department_name")],
    _f("price", DEC_PRICE), _f("tax_rate", T.IntegerType()))

STORE_TABLE = _struct(_f("id", S), _f("company_id", S))

PURCHASE_TABLE = _struct(
    *[_f(n, S) for n in ("person_id", "product_id", "id", "store_id", "datetime")],
    _f("quantity", DEC_QTY), _f("amount", DEC_AMT), _f("amount_without_tax", DEC_AMT),
    _f("payment_method", S), _f("payment_type", S),
    _f("discount_amount", DEC_AMT), _f("price_down_amount", DEC_AMT),
    *[_f(n, S) for n in ("discount_type1", "discount_type2", "discount_type3")])

VISIT_TABLE = _struct(
    *[_f(n, S) for n in ("person_id", "store_id", "id")],
    _f("datetime", T.TimestampNTZType()),
    _f("company_id", S), _f("register_no", S), _f("is_converted", T.BooleanType()),
    _f("purchase_id", S))

TABLES = {
    "person": PERSON_TABLE,
    "product": PRODUCT_TABLE,
    "store": STORE_TABLE,
    "purchase": PURCHASE_TABLE,
    "visit": VISIT_TABLE,
}

# Keys each graph table is unique on (node id / edge merge key).
TABLE_KEYS = {
    "person": ["id"],
    "product": ["id"],
    "store": ["id"],
    "purchase": ["person_id", "product_id", "id"],
    "visit": ["person_id", "store_id", "id"],
}
