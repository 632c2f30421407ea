import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from posgraph.operators.graph import Graph  # noqa: E402
from posgraph.schemas import POS_SCHEMA, TABLES  # noqa: E402
from posgraph.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


# Defaults for a POS line; tests override what matters to them.
POS_DEFAULTS = {
    "CUSTOMER_ID": "C1", "SEX": "1", "BIRTHDAY_Y": "1980", "BIRTHDAY_M": "3", "BIRTHDAY_D": "9",
    "ZIP_CODE": "0000001", "PREFECTURE": "TOKYO", "LATITUDE": "35", "LONGITUDE": "139",
    "DM_STOP_TYPE": "Y", "EMAIL_STOP_TYPE": "N", "TEL_STOP_TYPE": "N", "MAIL_PC_FLG": "N",
    "MAIL_MOBILE_FLG": "N", "MEMBER_ID": "M1", "CARD_ID": "K1", "CARD_STS": "1",
    "START_DATE": "2010-01-15", "END_DATE": None, "EXPIRATION_DATE": "2030-12-31", "REGIST_YMD": "20091201",
    "ITEM_CD_UNIQUE": "P1", "PD_NM": "apple", "PD_NM_KANA": "APPLE",
    "ITEM_CATEGORY_LV1_CD": "fruit", "ITEM_CATEGORY_LV2_CD": "f1", "ITEM_CATEGORY_LV3_CD": "f11",
    "GRP_CD": "g", "GRP_KJ": "group g", "GRP_KN": "GROUP G", "DEPT_CD": "d", "DEPT_KJ": "dept d",
    "DEPT_KN": "DEPT D", "CLR_CD": "1", "CLR_NM": "red", "SZ_CD": "2", "SZ_NM": "M", "MFC_CD": "9",
    "SSN_CD": "0", "VARIATION_PRODUCT_NO": "1",
    "MASTER_PRICE": None, "SCHEDULE_PRICE": None, "HYOUJUN_BAITANKA": None, "HYOUJUN_GENTANKA": None,
    "ZEIRITSU": "10", "SHOP_CD": "S1", "COMPANY_CD_UNIQUE": "1", "SALES_SIGN": "+", "COUNTRY_CD": "10",
    "SALES_YMD": 20241201, "SALES_HMS": "101010", "REGISTER_NO": "1", "RECEIPT_NO": "R1",
    "SALES_DETAIL_NO": "1", "SALES_NUM": None, "SALES_AMT": None, "SALES_AMT_TAX_EXCLUDED": None,
    "PAYMENTS_DIV": "cash", "PAYMENTS_KIND": "A", "DISCOUNT_PRICE": None, "PRICE_DOWN_AMT": None,
    "DISCOUNT_DIV_1": None, "DISCOUNT_DIV_2": None, "DISCOUNT_DIV_3": None,
}


def pos_frame(spark, rows):
    """POS lines with declared types; each row is a dict of overrides."""
    from decimal import Decimal
    full = []
    for r in rows:
        d = dict(POS_DEFAULTS)
        d.update(r)
        for k in ("SALES_NUM", "SALES_AMT", "SALES_AMT_TAX_EXCLUDED", "DISCOUNT_PRICE", "PRICE_DOWN_AMT",
                  "MASTER_PRICE", "SCHEDULE_PRICE", "HYOUJUN_BAITANKA", "HYOUJUN_GENTANKA"):
            if d[k] is not None and not isinstance(d[k], Decimal):
                d[k] = Decimal(str(d[k]))
        full.append(tuple(d[f.name] for f in POS_SCHEMA.fields))
    return spark.createDataFrame(full, POS_SCHEMA)


def table(spark, name, rows):
    """A graph table from dicts (missing columns are null)."""
    from decimal import Decimal
    schema = TABLES[name]
    out = []
    for r in rows:
        vals = []
        for f in schema.fields:
            v = r.get(f.name)
            if v is not None and f.dataType.typeName() == "decimal" and not isinstance(v, Decimal):
                v = Decimal(str(v))
            vals.append(v)
        out.append(tuple(vals))
    return spark.createDataFrame(out, schema)


def graph_of(spark, purchases, persons=None, products=None):
    """A Graph from purchase edges given as (person, product, id, datetime) tuples."""
    persons = persons or sorted({p for p, *_ in purchases})
    products = products or sorted({q for _, q, *_ in purchases})
    return Graph(
        table(spark, "person", [{"id": p, "gender": "1", "prefecture": "X"} for p in persons]),
        table(spark, "product", [{"id": q, "name": f"name {q}", "major_category": f"cat {q[:1]}"}
                                 for q in products]),
        table(spark, "store", [{"id": "S1", "company_id": "1"}]),
        table(spark, "purchase", [{"person_id": p, "product_id": q, "id": i, "store_id": "S1",
                                   "datetime": dt, "quantity": 1, "amount": 10}
                                  for p, q, i, dt in purchases]),
        table(spark, "visit", []),
    )
