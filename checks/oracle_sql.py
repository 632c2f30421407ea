"""DuckDB oracle SQL for every registered query.

Each statement starts from the POS adapter (the same mapping as
``posgraph.sources.tpch``) as a CTE and re-states the operator in plain SQL,
independent of the Spark code.  Conventions: flat columns, doubles rounded to
6 places, decimal sums cast to DECIMAL(28, s), explicit NULLS FIRST/LAST.
"""

from __future__ import annotations

ADAPTER = """
SELECT CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE lpad(CAST(c.c_custkey AS STRING),10,'0') END AS CUSTOMER_ID,
 CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE CAST(c.c_custkey % 3 AS STRING) END AS SEX,
 CAST(1950 + c.c_custkey % 55 AS STRING) AS BIRTHDAY_Y,
 CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE CAST(1 + c.c_custkey % 12 AS STRING) END AS BIRTHDAY_M,
 CAST(1 + c.c_custkey % 28 AS STRING) AS BIRTHDAY_D,
 lpad(CAST(c.c_custkey % 1000 AS STRING),7,'0') AS ZIP_CODE, cn.n_name AS PREFECTURE,
 CAST(30 + c.c_nationkey % 15 AS STRING) AS LATITUDE, CAST(130 + c.c_nationkey % 15 AS STRING) AS LONGITUDE,
 CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Y' WHEN 'MACHINERY' THEN NULL ELSE 'N' END AS DM_STOP_TYPE,
 CASE WHEN c.c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS EMAIL_STOP_TYPE,
 CASE WHEN c.c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS TEL_STOP_TYPE,
 CASE WHEN c.c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS MAIL_PC_FLG,
 CASE WHEN c.c_custkey % 5 = 0 THEN 'Y' ELSE 'N' END AS MAIL_MOBILE_FLG,
 concat('M',lpad(CAST(c.c_custkey AS STRING),10,'0')) AS MEMBER_ID,
 concat('C',lpad(CAST(c.c_custkey AS STRING),10,'0')) AS CARD_ID,
 CASE WHEN c.c_acctbal < 0 THEN '9' ELSE '1' END AS CARD_STS,
 concat(CAST(2010 + c.c_custkey % 10 AS STRING),'-01-15') AS START_DATE,
 CASE WHEN c.c_custkey % 5 = 0 THEN '2024-06-30' ELSE NULL END AS END_DATE,
 CASE WHEN c.c_custkey % 97 = 0 THEN 'not-a-date' ELSE '2030-12-31' END AS EXPIRATION_DATE,
 '2009-12-01' AS REGIST_YMD,
 lpad(CAST(p.p_partkey AS STRING),13,'0') AS ITEM_CD_UNIQUE,
 p.p_name AS PD_NM, upper(p.p_name) AS PD_NM_KANA,
 p.p_type AS ITEM_CATEGORY_LV1_CD, p.p_brand AS ITEM_CATEGORY_LV2_CD, CAST(p.p_size AS STRING) AS ITEM_CATEGORY_LV3_CD,
 p.p_brand AS GRP_CD, concat('group ',p.p_brand) AS GRP_KJ, upper(concat('group ',p.p_brand)) AS GRP_KN,
 p.p_type AS DEPT_CD, concat('dept ',p.p_type) AS DEPT_KJ, upper(concat('dept ',p.p_type)) AS DEPT_KN,
 CAST(p.p_partkey % 8 AS STRING) AS CLR_CD, concat('color ',CAST(p.p_partkey % 8 AS STRING)) AS CLR_NM,
 CAST(p.p_size AS STRING) AS SZ_CD, concat('size ',CAST(p.p_size AS STRING)) AS SZ_NM,
 CAST(p.p_partkey % 40 AS STRING) AS MFC_CD, CAST(p.p_partkey % 4 AS STRING) AS SSN_CD, CAST(p.p_partkey % 3 AS STRING) AS VARIATION_PRODUCT_NO,
 CAST(p.p_retailprice AS DECIMAL(14,2)) AS MASTER_PRICE,
 CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE CAST(p.p_retailprice AS DECIMAL(14,2)) END AS SCHEDULE_PRICE,
 CAST(p.p_retailprice AS DECIMAL(14,2)) AS HYOUJUN_BAITANKA, CAST(p.p_size AS DECIMAL(14,2)) AS HYOUJUN_GENTANKA,
 CASE WHEN p.p_type = 'ECONOMY' THEN '8' ELSE '10' END AS ZEIRITSU,
 lpad(CAST(o.o_orderkey % 25 AS STRING),4,'0') AS SHOP_CD, CAST(sn.n_regionkey AS STRING) AS COMPANY_CD_UNIQUE,
 CASE WHEN l.l_returnflag = 'R' THEN '-' ELSE '+' END AS SALES_SIGN,
 CASE WHEN l.l_suppkey % 20 = 0 THEN '20' ELSE '10' END AS COUNTRY_CD,
 CAST(year(o.o_orderdate)*10000 + month(o.o_orderdate)*100 + day(o.o_orderdate) AS INT) AS SALES_YMD,
 concat(lpad(CAST(o.o_orderkey % 24 AS STRING),2,'0'),lpad(CAST(o.o_orderkey % 60 AS STRING),2,'0'),lpad(CAST(o.o_orderkey % 59 AS STRING),2,'0')) AS SALES_HMS,
 CAST(100 + o.o_orderkey % 5 AS STRING) AS REGISTER_NO, CAST(o.o_orderkey AS STRING) AS RECEIPT_NO,
 CAST(l.l_linenumber AS STRING) AS SALES_DETAIL_NO,
 CAST(l.l_quantity AS DECIMAL(18,3)) AS SALES_NUM,
 CAST(l.l_extendedprice AS DECIMAL(18,2)) AS SALES_AMT,
 CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) - CAST(l.l_quantity AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS SALES_AMT_TAX_EXCLUDED,
 o.o_orderpriority AS PAYMENTS_DIV, o.o_orderstatus AS PAYMENTS_KIND,
 CASE WHEN l.l_discount = 0 THEN NULL ELSE CAST(l.l_discount AS DECIMAL(18,2)) END AS DISCOUNT_PRICE,
 CAST(l.l_tax AS DECIMAL(18,2)) AS PRICE_DOWN_AMT,
 l.l_returnflag AS DISCOUNT_DIV_1, l.l_linestatus AS DISCOUNT_DIV_2, CAST(NULL AS STRING) AS DISCOUNT_DIV_3
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
 JOIN customer c ON c.c_custkey = o.o_custkey JOIN part p ON p.p_partkey = l.l_partkey
 JOIN nation cn ON cn.n_nationkey = c.c_nationkey JOIN nation sn ON sn.n_nationkey = o.o_orderkey % 25
"""

SALES = "SELECT * FROM pos WHERE SALES_SIGN = '+' AND COUNTRY_CD = '10'"

# Fixed parameters (same literals as posgraph.plans.catalog).
DAY_LO, DAY_HI = 19970601, 19970630
TARGET_PERSON = "0000000005"
TARGET_PRODUCT = "0000000000042"
DT_FROM, DT_TO = "19960101T000000", "19991231T235959"


def with_(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({q})" for name, q in ctes) + "\n" + body


def base(*extra: tuple[str, str]) -> list[tuple[str, str]]:
    return [("pos", ADAPTER), ("sales", SALES), *extra]


def keep_one(src: str, keys: list[str], order: list[str]) -> str:
    """Row-number dedupe: one row per key, smallest by ``order`` (nulls first)."""
    o = ", ".join(f'"{c}" ASC NULLS FIRST' for c in order)
    k = ", ".join(f'"{c}"' for c in keys)
    return (f"SELECT * EXCLUDE (rn_) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {k} ORDER BY {o}) AS rn_ FROM {src}) WHERE rn_ = 1")


def ts(c: str) -> str:
    return f"coalesce(TRY_CAST({c} AS TIMESTAMP), try_strptime({c}, '%Y%m%d'))"


PERSON_LINES = f"""
SELECT CUSTOMER_ID AS id, SEX AS gender,
 concat_ws('-', BIRTHDAY_Y, lpad(BIRTHDAY_M, 2, '0'), lpad(BIRTHDAY_D, 2, '0')) AS birth_date,
 ZIP_CODE AS location_zip_code, PREFECTURE AS location_prefecture,
 LATITUDE AS location_coordinates_latitude, LONGITUDE AS location_coordinates_longitude,
 DM_STOP_TYPE = 'Y' AS contact_preferences_dm_stop, EMAIL_STOP_TYPE = 'Y' AS contact_preferences_email_stop,
 TEL_STOP_TYPE = 'Y' AS contact_preferences_tel_stop, MAIL_PC_FLG = 'Y' AS contact_preferences_mail_pc,
 MAIL_MOBILE_FLG = 'Y' AS contact_preferences_mail_mobile,
 MEMBER_ID AS membership_member_id, CARD_ID AS membership_card_id, CARD_STS AS membership_status,
 {ts('START_DATE')} AS membership_start_date, {ts('END_DATE')} AS membership_end_date,
 {ts('EXPIRATION_DATE')} AS membership_expiration_date, {ts('REGIST_YMD')} AS membership_registration_date
FROM sales"""
PERSON_COLS = ["id", "gender", "birth_date", "location_zip_code", "location_prefecture",
               "location_coordinates_latitude", "location_coordinates_longitude",
               "contact_preferences_dm_stop", "contact_preferences_email_stop",
               "contact_preferences_tel_stop", "contact_preferences_mail_pc",
               "contact_preferences_mail_mobile", "membership_member_id", "membership_card_id",
               "membership_status", "membership_start_date", "membership_end_date",
               "membership_expiration_date", "membership_registration_date"]
PERSONS = keep_one("(SELECT * FROM person_lines WHERE id IS NOT NULL)", ["id"], PERSON_COLS[1:])

PRODUCT_LINES = """
SELECT ITEM_CD_UNIQUE AS id, PD_NM AS name, PD_NM_KANA AS name_kana,
 ITEM_CATEGORY_LV1_CD AS categories_major_category, ITEM_CATEGORY_LV2_CD AS categories_medium_category,
 ITEM_CATEGORY_LV3_CD AS categories_minor_category,
 GRP_CD AS categories_group_code, GRP_KJ AS categories_group_name, GRP_KN AS categories_group_name_kana,
 DEPT_CD AS categories_department_code, DEPT_KJ AS categories_department_name,
 DEPT_KN AS categories_department_name_kana,
 CLR_CD AS attributes_color_code, CLR_NM AS attributes_color_name,
 SZ_CD AS attributes_size_code, SZ_NM AS attributes_size_name,
 MFC_CD AS attributes_maker_code, SSN_CD AS attributes_season_code, VARIATION_PRODUCT_NO AS attributes_variation_no,
 TRY_CAST(MASTER_PRICE AS DECIMAL(14,2)) AS pricing_master_price,
 TRY_CAST(SCHEDULE_PRICE AS DECIMAL(14,2)) AS pricing_schedule_price,
 TRY_CAST(HYOUJUN_BAITANKA AS DECIMAL(14,2)) AS pricing_standard_price,
 TRY_CAST(HYOUJUN_GENTANKA AS DECIMAL(14,2)) AS pricing_standard_cost,
 TRY_CAST(ZEIRITSU AS INTEGER) AS pricing_tax_rate
FROM sales"""
PRODUCT_COLS = ["id", "name", "name_kana", "categories_major_category", "categories_medium_category",
                "categories_minor_category", "categories_group_code", "categories_group_name",
                "categories_group_name_kana", "categories_department_code",
                "categories_department_name", "categories_department_name_kana",
                "attributes_color_code", "attributes_color_name", "attributes_size_code",
                "attributes_size_name", "attributes_maker_code", "attributes_season_code",
                "attributes_variation_no", "pricing_master_price", "pricing_schedule_price",
                "pricing_standard_price", "pricing_standard_cost", "pricing_tax_rate"]
PRODUCTS = keep_one("(SELECT * FROM product_lines WHERE id IS NOT NULL)", ["id"], PRODUCT_COLS[1:])

STORES = ("SELECT DISTINCT SHOP_CD AS id, COMPANY_CD_UNIQUE AS company_id FROM sales "
          "WHERE SHOP_CD IS NOT NULL")

RECEIPT_PARTS = "SHOP_CD, CAST(SALES_YMD AS VARCHAR), SALES_HMS, REGISTER_NO, RECEIPT_NO"


def purchase_lines(grain: str) -> str:
    parts = RECEIPT_PARTS + (", SALES_DETAIL_NO" if grain == "line" else "")
    return f"""
SELECT concat_ws('_', {parts}) AS id, CUSTOMER_ID AS person_id, ITEM_CD_UNIQUE AS product_id,
 CAST(SALES_YMD AS VARCHAR) || 'T' || SALES_HMS AS "datetime",
 TRY_CAST(SALES_NUM AS DECIMAL(18,3)) AS purchase_details_quantity,
 SALES_AMT AS purchase_details_amount, SALES_AMT_TAX_EXCLUDED AS purchase_details_amount_without_tax,
 PAYMENTS_DIV AS purchase_details_payment_method, PAYMENTS_KIND AS purchase_details_payment_type,
 SHOP_CD AS purchase_details_store_id, DISCOUNT_PRICE AS discount_info_discount_amount,
 PRICE_DOWN_AMT AS discount_info_price_down_amount, DISCOUNT_DIV_1 AS discount_info_discount_type1,
 DISCOUNT_DIV_2 AS discount_info_discount_type2, DISCOUNT_DIV_3 AS discount_info_discount_type3
FROM sales WHERE CUSTOMER_ID IS NOT NULL"""


PURCHASE_COLS = ["id", "person_id", "product_id", "datetime", "purchase_details_quantity",
                 "purchase_details_amount", "purchase_details_amount_without_tax",
                 "purchase_details_payment_method", "purchase_details_payment_type",
                 "purchase_details_store_id", "discount_info_discount_amount",
                 "discount_info_price_down_amount", "discount_info_discount_type1",
                 "discount_info_discount_type2", "discount_info_discount_type3"]


def purchases_ctes(grain: str, name: str = "purchases") -> list[tuple[str, str]]:
    return [(f"{name}_lines", purchase_lines(grain)),
            (name, keep_one(f"{name}_lines", ["id"], PURCHASE_COLS[1:]))]


VISIT_KEY = {"store_day": ["SHOP_CD", "SALES_YMD"],
             "receipt": ["SHOP_CD", "SALES_YMD", "SALES_HMS", "REGISTER_NO", "RECEIPT_NO"]}
VISIT_COLS = ["id", "person_id", "store_id", "datetime", "visit_details_company_id",
              "visit_details_register_no", "visit_details_conversion_converted",
              "visit_details_conversion_purchase_id", "total_amount"]


def visits_ctes(grain: str, name: str = "visits") -> list[tuple[str, str]]:
    keys = VISIT_KEY[grain]
    kcols = ", ".join(keys)
    idparts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    lines = f"""
SELECT {kcols}, concat_ws('_', {idparts}) AS id, CUSTOMER_ID AS person_id, SHOP_CD AS store_id,
 CAST(SALES_YMD AS VARCHAR) || 'T' || SALES_HMS AS "datetime",
 COMPANY_CD_UNIQUE AS visit_details_company_id, REGISTER_NO AS visit_details_register_no,
 TRUE AS visit_details_conversion_converted,
 concat_ws('_', RECEIPT_NO, SALES_DETAIL_NO) AS visit_details_conversion_purchase_id
FROM sales"""
    totals = (f"SELECT {kcols}, CAST(sum(SALES_AMT) AS DECIMAL(28,2)) AS total_amount "
              f"FROM sales GROUP BY {kcols}")
    joined = (f"SELECT v.*, t.total_amount FROM {name}_lines v JOIN {name}_totals t USING ({kcols}) "
              f"WHERE v.person_id IS NOT NULL")
    sel = ", ".join(f'"{c}"' for c in VISIT_COLS)
    return [(f"{name}_lines", lines), (f"{name}_totals", totals), (f"{name}_joined", joined),
            (name, f"SELECT {sel} FROM ({keep_one(f'{name}_joined', ['id'], VISIT_COLS[1:])})")]


Q: dict[str, str] = {}

Q["pos_sales"] = with_(base(), "SELECT * FROM sales")
Q["pos_day_range"] = with_(base(), f"SELECT * FROM sales WHERE SALES_YMD BETWEEN {DAY_LO} AND {DAY_HI}")
_DAYS = f"SALES_YMD BETWEEN {DAY_LO} AND {DAY_HI}"
Q["pos_days_read"] = with_(base(), f"""SELECT CUSTOMER_ID, ITEM_CD_UNIQUE, SHOP_CD, SALES_YMD, SALES_AMT, RECEIPT_NO,
 SALES_DETAIL_NO FROM sales WHERE {_DAYS}""")
Q["pos_days_types"] = Q["pos_days_read"]
Q["pos_company"] = with_(base(), f"SELECT * FROM sales WHERE {_DAYS} AND COMPANY_CD_UNIQUE = '3'")
Q["persons"] = with_(base(("person_lines", PERSON_LINES)), PERSONS)
Q["products"] = with_(base(("product_lines", PRODUCT_LINES)), PRODUCTS)
Q["stores"] = with_(base(), STORES)
Q["purchases_receipt"] = with_(base(*purchases_ctes("receipt")), "SELECT * FROM purchases")
Q["purchases_line"] = with_(base(*purchases_ctes("line")), "SELECT * FROM purchases")
Q["visits_store_day"] = with_(base(*visits_ctes("store_day")), "SELECT * FROM visits")
Q["visits_receipt"] = with_(base(*visits_ctes("receipt")), "SELECT * FROM visits")
Q["top_products"] = with_(base(*purchases_ctes("receipt")), """
SELECT product_id, count(*) AS purchase_count,
 CAST(sum(purchase_details_quantity) AS DECIMAL(28,3)) AS total_quantity,
 CAST(sum(purchase_details_amount) AS DECIMAL(28,2)) AS total_amount
FROM purchases GROUP BY product_id
ORDER BY purchase_count DESC, product_id ASC NULLS FIRST LIMIT 5""")
Q["payment_mix"] = with_(base(*purchases_ctes("receipt")), """
SELECT purchase_details_payment_method AS payment_method, count(*) AS "count"
FROM purchases GROUP BY purchase_details_payment_method""")
Q["top_stores"] = with_(base(*visits_ctes("store_day")), """
SELECT store_id, count(*) AS visit_count, count(DISTINCT person_id) AS unique_visitors
FROM visits GROUP BY store_id ORDER BY visit_count DESC, store_id ASC NULLS FIRST LIMIT 5""")

# ---------------------------------------------------------------- stage 2

def _from(sql: str, src: str) -> str:
    return sql.replace("FROM sales", f"FROM {src}")


PERSON_T = """
SELECT id, coalesce(gender, '0') AS gender, coalesce(birth_date, '') AS birth_date,
 coalesce(location_prefecture, '') AS prefecture, coalesce(location_zip_code, '') AS zip_code,
 coalesce(location_coordinates_latitude, '') AS latitude, coalesce(location_coordinates_longitude, '') AS longitude,
 coalesce(membership_member_id, '') AS member_id, coalesce(membership_status, '') AS status
FROM {src} WHERE id IS NOT NULL"""

PRODUCT_T = """
SELECT id, coalesce(name, '') AS name, coalesce(name_kana, '') AS name_kana,
 coalesce(categories_major_category, '') AS major_category,
 coalesce(categories_medium_category, '') AS medium_category,
 coalesce(categories_minor_category, '') AS minor_category,
 coalesce(categories_group_code, '') AS group_code, coalesce(categories_group_name, '') AS group_name,
 coalesce(categories_department_code, '') AS department_code,
 coalesce(categories_department_name, '') AS department_name,
 coalesce(pricing_master_price, CAST(0 AS DECIMAL(14,2))) AS price,
 CAST(coalesce(pricing_tax_rate, 0) AS INTEGER) AS tax_rate
FROM {src} WHERE id IS NOT NULL"""

PURCHASE_T_ORDER = ["store_id", "datetime", "quantity", "amount", "amount_without_tax", "payment_method",
                    "payment_type", "discount_amount", "price_down_amount", "discount_type1",
                    "discount_type2", "discount_type3"]


def purchase_flat(src: str, person_t: str, product_t: str) -> str:
    return f"""
SELECT person_id, product_id, id, purchase_details_store_id AS store_id, "datetime",
 coalesce(purchase_details_quantity, CAST(0 AS DECIMAL(18,3))) AS quantity,
 coalesce(purchase_details_amount, CAST(0 AS DECIMAL(18,2))) AS amount,
 coalesce(purchase_details_amount_without_tax, CAST(0 AS DECIMAL(18,2))) AS amount_without_tax,
 coalesce(purchase_details_payment_method, '') AS payment_method,
 coalesce(purchase_details_payment_type, '') AS payment_type,
 coalesce(discount_info_discount_amount, CAST(0 AS DECIMAL(18,2))) AS discount_amount,
 coalesce(discount_info_price_down_amount, CAST(0 AS DECIMAL(18,2))) AS price_down_amount,
 coalesce(discount_info_discount_type1, '') AS discount_type1,
 coalesce(discount_info_discount_type2, '') AS discount_type2,
 coalesce(discount_info_discount_type3, '') AS discount_type3
FROM {src}
WHERE id IS NOT NULL AND person_id IS NOT NULL AND product_id IS NOT NULL
 AND purchase_details_store_id IS NOT NULL AND "datetime" IS NOT NULL
 AND person_id IN (SELECT id FROM {person_t}) AND product_id IN (SELECT id FROM {product_t})"""


def purchase_t(src: str, person_t: str = "person_t", product_t: str = "product_t") -> str:
    return keep_one(f"({purchase_flat(src, person_t, product_t)})",
                    ["person_id", "product_id", "id"], PURCHASE_T_ORDER)


VISIT_T = keep_one("""(
SELECT person_id, store_id, id, try_strptime("datetime", '%Y%m%dT%H%M%S') AS "datetime",
 coalesce(visit_details_company_id, '') AS company_id, coalesce(visit_details_register_no, '') AS register_no,
 coalesce(visit_details_conversion_converted, false) AS is_converted,
 coalesce(visit_details_conversion_purchase_id, '') AS purchase_id
FROM visits
WHERE id IS NOT NULL AND person_id IS NOT NULL AND store_id IS NOT NULL AND "datetime" IS NOT NULL
 AND person_id IN (SELECT id FROM person_t) AND store_id IN (SELECT id FROM store_t))""",
                   ["person_id", "store_id", "id"],
                   ["datetime", "company_id", "register_no", "is_converted", "purchase_id"])


def graph_ctes() -> list[tuple[str, str]]:
    """Graph tables at line grain, as the stored graph is built."""
    return base(
        ("person_lines", PERSON_LINES), ("persons", PERSONS),
        ("product_lines", PRODUCT_LINES), ("products", PRODUCTS),
        ("person_t", PERSON_T.format(src="persons")),
        ("product_t", PRODUCT_T.format(src="products")),
        ("store_t", STORES),
        ("plines", purchase_lines("line")),
        ("purchase_t", purchase_t("plines")),
        *visits_ctes("store_day"),
        ("visit_t", VISIT_T),
    )


def g(body: str, *extra: tuple[str, str]) -> str:
    return with_(graph_ctes() + list(extra), body)


Q["person_props"] = g("SELECT * FROM person_t")
Q["product_props"] = g("SELECT * FROM product_t")
Q["store_props"] = g("SELECT * FROM store_t")
Q["purchase_edges"] = g("SELECT * FROM purchase_t")
Q["visit_edges"] = g("SELECT * FROM visit_t")
Q["graph_counts"] = g("""
SELECT 'Person nodes' AS name, count(*) AS "count" FROM person_t
UNION ALL SELECT 'Product nodes', count(*) FROM product_t
UNION ALL SELECT 'Store nodes', count(*) FROM store_t
UNION ALL SELECT 'Purchase relationships', count(*) FROM purchase_t
UNION ALL SELECT 'Visit relationships', count(*) FROM visit_t""")
Q["unique_violations"] = g("""
SELECT 'person' AS label, id, CAST(2 AS BIGINT) AS "count" FROM person_t WHERE id LIKE '%7'
UNION ALL SELECT 'product', id, 2 FROM product_t WHERE id LIKE '%7'
UNION ALL SELECT 'store', id, 2 FROM store_t WHERE id LIKE '%1'""")

_RECEIPT_GRAPH = base(
    ("person_lines", PERSON_LINES), ("persons", PERSONS),
    ("product_lines", PRODUCT_LINES), ("products", PRODUCTS),
    ("person_t", PERSON_T.format(src="persons")),
    ("product_t", PRODUCT_T.format(src="products")),
    *purchases_ctes("receipt"),
    *visits_ctes("store_day"),
)


def _digests(name: str, cols: list[str], src: str) -> str:
    values = ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '~')" for c in sorted(cols))
    return f"SELECT '{name}' AS name, id, md5(concat_ws('|', {values})) AS digest FROM {src}"


Q["json_roundtrip"] = with_(_RECEIPT_GRAPH, " UNION ALL ".join(_digests(*x) for x in (
    ("persons", PERSON_COLS, "persons"), ("products", PRODUCT_COLS, "products"),
    ("stores", ["id", "company_id"], f"({STORES})"), ("purchases", PURCHASE_COLS, "purchases"),
    ("visits", VISIT_COLS, "visits"))))
Q["json_lines_load"] = with_(_RECEIPT_GRAPH, "SELECT * FROM (" + purchase_t("purchases") + ")")

_EARLY = "(SELECT * FROM sales WHERE SALES_YMD < 19980101)"
_LATE = "(SELECT * FROM sales WHERE SALES_YMD >= 19970101)"
_PROD_ORDER = ["name", "name_kana", "major_category", "medium_category", "minor_category", "group_code",
               "group_name", "department_code", "department_name", "price", "tax_rate"]


def _products_of(src: str) -> str:
    lines = f"({_from(PRODUCT_LINES, src)})"
    return PRODUCT_T.format(src=f"({keep_one(lines + ' WHERE id IS NOT NULL', ['id'], PRODUCT_COLS[1:])})")


Q["upsert_nodes"] = with_(base(
    ("p_early", _products_of(_EARLY)), ("p_late", _products_of(_LATE))), """
SELECT * REPLACE (name || ' v2' AS name) FROM p_late UNION ALL
SELECT * FROM p_early WHERE id NOT IN (SELECT id FROM p_late)""")


def _persons_of(src: str) -> str:
    lines = f"({_from(PERSON_LINES, src)})"
    return PERSON_T.format(src=f"({keep_one(lines + ' WHERE id IS NOT NULL', ['id'], PERSON_COLS[1:])})")


Q["upsert_edges"] = with_(base(
    ("person_t", _persons_of("sales")), ("product_t", _products_of("sales")),
    ("person_e", _persons_of(_EARLY)), ("product_e", _products_of(_EARLY)),
    ("lines_e", _from(purchase_lines("line"), _EARLY)),
    ("lines_l", _from(purchase_lines("line"), _LATE)),
    ("base_t", purchase_t("lines_e", "person_e", "product_e")),
    ("upd_t", purchase_t("lines_l")),
), """
SELECT * REPLACE (CAST(amount + 1 AS DECIMAL(18,2)) AS amount) FROM upd_t UNION ALL
SELECT * FROM base_t b WHERE NOT EXISTS (
  SELECT 1 FROM upd_t u WHERE u.person_id = b.person_id AND u.product_id = b.product_id AND u.id = b.id)""")

Q["upsert_graph"] = with_(base(
    ("person_t", _persons_of("sales")), ("product_t", _products_of("sales")),
    ("person_e", _persons_of(_EARLY)), ("product_e", _products_of(_EARLY)), ("product_l", _products_of(_LATE)),
    ("lines_e", _from(purchase_lines("line"), _EARLY)),
    ("lines_l", _from(purchase_lines("line"), _LATE)),
    ("base_t", purchase_t("lines_e", "person_e", "product_e")),
    ("upd_t", purchase_t("lines_l")),
    ("names", "SELECT id, name FROM product_l UNION ALL SELECT id, name FROM product_e WHERE id NOT IN (SELECT id FROM product_l)"),
    ("merged", """SELECT * REPLACE (CAST(amount + 1 AS DECIMAL(18,2)) AS amount) FROM upd_t UNION ALL
      SELECT * FROM base_t b WHERE NOT EXISTS (
      SELECT 1 FROM upd_t u WHERE u.person_id = b.person_id AND u.product_id = b.product_id AND u.id = b.id)"""),
    ("deg", "SELECT person_id, count(*) AS n, count(DISTINCT product_id) AS items FROM merged GROUP BY person_id"),
), """
SELECT m.product_id, any_value(names.name) AS name, count(*) AS edges, count(DISTINCT m.person_id) AS buyers, count(*) AS copied,
 CAST(sum(m.amount) AS DECIMAL(28,2)) AS amount, count(*) AS "rows", CAST(sum(deg.n) AS BIGINT) AS buyer_edges,
 CAST(sum(deg.items) AS BIGINT) AS buyer_items
FROM merged m JOIN deg USING (person_id) JOIN names ON names.id = m.product_id GROUP BY m.product_id""")

Q["load_twice"] = with_(base(
    ("person_e", _persons_of(_EARLY)), ("product_e", _products_of(_EARLY)),
    ("lines_e", _from(purchase_lines("line"), _EARLY)),
    ("base_t", purchase_t("lines_e", "person_e", "product_e")),
), """
SELECT product_id, count(*) AS edges, count(DISTINCT person_id) AS buyers, count(*) AS copied,
 CAST(sum(amount) AS DECIMAL(28,2)) AS amount FROM base_t GROUP BY product_id""")

# ---------------------------------------------------------------- stage 3

_NEWEST = '"datetime" DESC NULLS FIRST'
_RANGE = f'"datetime" >= \'{DT_FROM}\' AND "datetime" <= \'{DT_TO}\''

Q["person_purchases"] = g(f"""
SELECT e.product_id, p.name AS product_name, e."datetime" AS purchase_date, e.quantity, e.amount,
 e.payment_method, e.store_id
FROM purchase_t e JOIN product_t p ON p.id = e.product_id
WHERE e.person_id = '{TARGET_PERSON}' AND {_RANGE.replace('"datetime"', 'e."datetime"')}
ORDER BY e.{_NEWEST}, e.product_id ASC NULLS FIRST, e.id ASC NULLS FIRST LIMIT 10""")
Q["person_purchases_all"] = g(f"""
SELECT person_id, product_id, product_name, purchase_date, quantity, amount, payment_method, store_id FROM (
 SELECT e.person_id, e.product_id, p.name AS product_name, e."datetime" AS purchase_date, e.quantity, e.amount,
  e.payment_method, e.store_id,
  row_number() OVER (PARTITION BY e.person_id ORDER BY e.{_NEWEST}, e.product_id ASC NULLS FIRST,
                     e.id ASC NULLS FIRST) AS rn
 FROM purchase_t e JOIN product_t p ON p.id = e.product_id) WHERE rn <= 10""")
Q["product_purchasers"] = g(f"""
SELECT e.person_id, p.gender, p.prefecture, e."datetime" AS purchase_date, e.quantity, e.amount, e.store_id
FROM purchase_t e JOIN person_t p ON p.id = e.person_id
WHERE e.product_id = '{TARGET_PRODUCT}' AND {_RANGE.replace('"datetime"', 'e."datetime"')}
ORDER BY e.{_NEWEST}, e.person_id ASC NULLS FIRST, e.id ASC NULLS FIRST LIMIT 10""")
Q["product_purchasers_all"] = g(f"""
SELECT product_id, person_id, gender, prefecture, purchase_date, quantity, amount, store_id FROM (
 SELECT e.product_id, e.person_id, p.gender, p.prefecture, e."datetime" AS purchase_date, e.quantity,
  e.amount, e.store_id,
  row_number() OVER (PARTITION BY e.product_id ORDER BY e.{_NEWEST}, e.person_id ASC NULLS FIRST,
                     e.id ASC NULLS FIRST) AS rn
 FROM purchase_t e JOIN person_t p ON p.id = e.person_id) WHERE rn <= 10""")

_STATS = """count(*) AS total_purchases,
 CAST(coalesce(sum(e.quantity), 0) AS DECIMAL(28,3)) AS total_quantity,
 CAST(coalesce(sum(e.amount), 0) AS DECIMAL(28,2)) AS total_amount,
 round(CAST(sum(e.amount) AS DOUBLE) / CAST(count(*) AS DOUBLE), 6) AS avg_amount"""
_CATS = "coalesce(array_to_string(list_sort(list_distinct(list(p.major_category))), '|'), '') AS categories"

Q["person_statistics"] = g(f"""
SELECT {_STATS}, {_CATS}
FROM purchase_t e JOIN product_t p ON p.id = e.product_id WHERE e.person_id = '{TARGET_PERSON}'""")
Q["product_statistics"] = g(f"""
SELECT {_STATS}, count(DISTINCT e.person_id) AS unique_customers
FROM purchase_t e JOIN person_t p ON p.id = e.person_id WHERE e.product_id = '{TARGET_PRODUCT}'""")
Q["person_statistics_all"] = g(f"""
SELECT n.id AS person_id, coalesce(s.total_purchases, 0) AS total_purchases,
 coalesce(s.total_quantity, CAST(0 AS DECIMAL(28,3))) AS total_quantity,
 coalesce(s.total_amount, CAST(0 AS DECIMAL(28,2))) AS total_amount, s.avg_amount,
 coalesce(s.categories, '') AS categories
FROM person_t n LEFT JOIN (
 SELECT e.person_id, {_STATS}, {_CATS}
 FROM purchase_t e JOIN product_t p ON p.id = e.product_id GROUP BY e.person_id) s ON s.person_id = n.id""")
Q["product_statistics_all"] = g(f"""
SELECT n.id AS product_id, coalesce(s.total_purchases, 0) AS total_purchases,
 coalesce(s.total_quantity, CAST(0 AS DECIMAL(28,3))) AS total_quantity,
 coalesce(s.total_amount, CAST(0 AS DECIMAL(28,2))) AS total_amount, s.avg_amount,
 coalesce(s.unique_customers, 0) AS unique_customers
FROM product_t n LEFT JOIN (
 SELECT e.product_id, {_STATS}, count(DISTINCT e.person_id) AS unique_customers
 FROM purchase_t e JOIN person_t p ON p.id = e.person_id GROUP BY e.product_id) s ON s.product_id = n.id""")

_B = ("b", "SELECT DISTINCT person_id, product_id FROM purchase_t")

Q["related_products"] = g(f"""
SELECT b.product_id, p.name AS product_name, p.major_category AS category, count(*) AS frequency
FROM b JOIN product_t p ON p.id = b.product_id
WHERE b.person_id IN (SELECT person_id FROM b WHERE product_id = '{TARGET_PRODUCT}')
  AND b.product_id <> '{TARGET_PRODUCT}'
GROUP BY b.product_id, p.name, p.major_category
ORDER BY frequency DESC, b.product_id ASC NULLS FIRST LIMIT 5""", _B)

def _user_cf(threshold: str) -> str:
    return g(f"""
SELECT top.rank, top.product_id, p.name AS product_name, p.major_category AS category,
 round(top.score, 6) AS recommendation_score,
 top.purchase_count, cand.person_id AS similar_user_id, round(cand.similarity, 6) AS similarity
FROM top JOIN cand ON cand.product_id = top.product_id JOIN product_t p ON p.id = top.product_id""",
    _B,
    ("tgt", f"SELECT product_id FROM b WHERE person_id = '{TARGET_PERSON}'"),
    ("tsz", "SELECT count(*) AS t FROM tgt"),
    ("oth", f"""SELECT person_id, count(*) AS o,
      count(*) FILTER (WHERE product_id IN (SELECT product_id FROM tgt)) AS c
      FROM b WHERE person_id <> '{TARGET_PERSON}' GROUP BY person_id"""),
    ("sim", """SELECT person_id, CASE WHEN t + o - c > 0 THEN CAST(c AS DOUBLE) / CAST(t + o - c AS DOUBLE)
      ELSE 0.0 END AS similarity FROM oth CROSS JOIN tsz WHERE t > 0"""),
    ("cand", f"""SELECT b.product_id, s.person_id, s.similarity FROM b JOIN sim s ON s.person_id = b.person_id
      WHERE s.similarity >= {threshold} AND b.product_id NOT IN (SELECT product_id FROM tgt)"""),
    ("agg", """SELECT product_id, count(*) AS purchase_count,
      CAST(sum(CAST(similarity AS DECIMAL(38,18))) AS DOUBLE) * ln(count(*) + 1) AS score FROM cand GROUP BY product_id"""),
    ("top", """SELECT *, CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, product_id ASC NULLS FIRST) AS INT) AS rank
      FROM agg QUALIFY rank <= 10"""),
)


Q["user_recommendations"] = _user_cf("0.0")
Q["user_recommendations_similar"] = _user_cf("0.01")

Q["item_recommendations"] = g("""
SELECT a.product_id, p.name AS product_name, p.major_category AS category,
 round(a.score, 6) AS recommendation_score, a.related_items_count
FROM agg a JOIN product_t p ON p.id = a.product_id
ORDER BY a.score DESC NULLS LAST, a.product_id ASC NULLS FIRST LIMIT 10""",
    ("em", "SELECT person_id, product_id, count(*) AS m FROM purchase_t GROUP BY person_id, product_id"),
    ("deg", "SELECT product_id, count(*) AS deg FROM purchase_t GROUP BY product_id"),
    ("hrows", f"""SELECT product_id FROM purchase_t WHERE person_id = '{TARGET_PERSON}'
      ORDER BY {_NEWEST}, product_id ASC NULLS FIRST, id ASC NULLS FIRST LIMIT 10"""),
    ("hist", "SELECT product_id AS h, count(*) AS rep FROM hrows GROUP BY product_id"),
    ("walks", """SELECT hist.h, e2.product_id AS c, hist.rep * e1.m * e2.m AS w
      FROM hist JOIN em e1 ON e1.product_id = hist.h JOIN em e2 ON e2.person_id = e1.person_id
      WHERE e2.product_id NOT IN (SELECT h FROM hist)"""),
    ("paths", "SELECT h, c, sum(w) AS paths FROM walks GROUP BY h, c"),
    ("sims", """SELECT c, CAST(paths AS DOUBLE) / NULLIF(CAST(dh.deg + dc.deg - paths AS DOUBLE), 0) AS s
      FROM paths JOIN deg dh ON dh.product_id = h JOIN deg dc ON dc.product_id = c"""),
    ("agg", """SELECT c AS product_id, count(*) AS related_items_count,
      CAST(sum(CAST(s AS DECIMAL(38,18))) AS DOUBLE) * ln(count(*) + 1) AS score FROM sims WHERE s >= 0.02 GROUP BY c"""),
)


# Searches for every id divisible by 50.
_MINE = ("mine", "SELECT person_id AS target_id, product_id FROM b WHERE TRY_CAST(person_id AS BIGINT) % 50 = 0")
_SIMILAR = ("sims_of", """SELECT target_id, person_id, common, CAST(common AS DOUBLE) / CAST(t.n + o.n - common AS DOUBLE) AS similarity
      FROM (SELECT m.target_id, b.person_id, count(*) AS common FROM mine m JOIN b ON b.product_id = m.product_id
            AND b.person_id <> m.target_id GROUP BY ALL) c
      JOIN (SELECT person_id, count(*) AS n FROM b GROUP BY ALL) o USING (person_id)
      JOIN (SELECT person_id AS target_id, count(*) AS n FROM b GROUP BY ALL) t USING (target_id)""")
_DEG = ("deg", "SELECT product_id, count(*) AS deg FROM purchase_t GROUP BY product_id")

Q["similar_persons_batch"] = g("""
SELECT target_id, person_id, common, round(similarity, 6) AS similarity FROM sims_of WHERE similarity >= 0.05""",
    _B, _MINE, _SIMILAR)

Q["user_recommendations_batch"] = g("""
SELECT top.target_id, top.rank, top.product_id, p.name AS product_name, p.major_category AS category,
 round(top.score, 6) AS recommendation_score, top.purchase_count, cand.person_id AS similar_user_id,
 round(cand.similarity, 6) AS similarity
FROM top JOIN cand USING (target_id, product_id) JOIN product_t p ON p.id = top.product_id""",
    _B, _MINE, _SIMILAR,
    ("cand", """SELECT s.target_id, b.product_id, s.person_id, s.similarity FROM b JOIN sims_of s USING (person_id)
      WHERE s.similarity >= 0.03 AND NOT EXISTS (SELECT 1 FROM mine m WHERE m.target_id = s.target_id AND m.product_id = b.product_id)"""),
    ("agg", """SELECT target_id, product_id, count(*) AS purchase_count,
      CAST(sum(CAST(similarity AS DECIMAL(38,18))) AS DOUBLE) * ln(count(*) + 1) AS score FROM cand GROUP BY ALL"""),
    ("top", """SELECT *, CAST(row_number() OVER (PARTITION BY target_id ORDER BY score DESC NULLS LAST, product_id) AS INT) AS rank
      FROM agg QUALIFY rank <= 10"""))

Q["item_recommendations_batch"] = g("""
SELECT a.target_id, a.rank, a.product_id, p.name AS product_name, p.major_category AS category,
 round(a.score, 6) AS recommendation_score, a.related_items_count
FROM top a JOIN product_t p ON p.id = a.product_id""",
    _DEG,
    ("em", "SELECT person_id, product_id, count(*) AS m FROM purchase_t GROUP BY person_id, product_id"),
    ("hist", f"""SELECT target_id, h, count(*) AS rep FROM (
       SELECT person_id AS target_id, product_id AS h FROM purchase_t WHERE TRY_CAST(person_id AS BIGINT) % 50 = 0
       QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY {_NEWEST}, product_id ASC NULLS FIRST, id ASC NULLS FIRST) <= 10)
      GROUP BY ALL"""),
    ("paths", """SELECT e1.product_id AS h, e2.product_id AS c, sum(e1.m * e2.m) AS paths FROM em e1 JOIN em e2 USING (person_id)
      WHERE e1.product_id IN (SELECT h FROM hist) GROUP BY ALL"""),
    ("sims", """SELECT target_id, c, CAST(rep * paths AS DOUBLE) / NULLIF(CAST(dh.deg + dc.deg - rep * paths AS DOUBLE), 0) AS s
      FROM hist JOIN paths USING (h) JOIN deg dh ON dh.product_id = h JOIN deg dc ON dc.product_id = c
      WHERE NOT EXISTS (SELECT 1 FROM hist x WHERE x.target_id = hist.target_id AND x.h = c)"""),
    ("agg", """SELECT target_id, c AS product_id, count(*) AS related_items_count,
      CAST(sum(CAST(s AS DECIMAL(38,18))) AS DOUBLE) * ln(count(*) + 1) AS score FROM sims WHERE s >= 0.02 GROUP BY ALL"""),
    ("top", """SELECT *, CAST(row_number() OVER (PARTITION BY target_id ORDER BY score DESC NULLS LAST, product_id) AS INT) AS rank
      FROM agg QUALIFY rank <= 10"""))

Q["related_products_batch"] = g("""
SELECT top.target_id, top.rank, top.product_id, p.name AS product_name, p.major_category AS category, top.frequency
FROM top JOIN product_t p ON p.id = top.product_id""",
    _B,
    ("top", """SELECT *, CAST(row_number() OVER (PARTITION BY target_id ORDER BY frequency DESC, product_id) AS INT) AS rank FROM (
       SELECT m.product_id AS target_id, b.product_id, count(*) AS frequency FROM b m JOIN b USING (person_id)
       WHERE TRY_CAST(m.product_id AS BIGINT) % 50 = 0 AND b.product_id <> m.product_id GROUP BY ALL) QUALIFY rank <= 5"""))


def _rules(limit: str) -> str:
    rank = """CAST(row_number() OVER (ORDER BY r.lift DESC NULLS LAST, r.antecedent_id ASC NULLS FIRST,
 r.consequent_id ASC NULLS FIRST) AS INT) AS rank, """ if limit else ""
    return g(f"""
SELECT {rank}r.antecedent_id, p1.name AS antecedent_name, r.consequent_id, p2.name AS consequent_name,
 round(r.support, 6) AS support, round(r.confidence, 6) AS confidence, round(r.lift, 6) AS lift
FROM r JOIN product_t p1 ON p1.id = r.antecedent_id JOIN product_t p2 ON p2.id = r.consequent_id
ORDER BY r.lift DESC NULLS LAST, r.antecedent_id ASC NULLS FIRST, r.consequent_id ASC NULLS FIRST {limit}""",
        _B,
        ("tot", "SELECT CAST(count(*) AS DOUBLE) AS n FROM person_t"),
        ("deg", "SELECT product_id, count(*) AS cnt FROM purchase_t GROUP BY product_id"),
        ("pairs", """SELECT b1.product_id AS a, b2.product_id AS bb, count(*) AS n_both
          FROM b b1 JOIN b b2 ON b1.person_id = b2.person_id AND b1.product_id < b2.product_id
          GROUP BY b1.product_id, b2.product_id"""),
        ("m", """SELECT a, bb, CAST(n_both AS DOUBLE) / tot.n AS support,
          CAST(n_both AS DOUBLE) / CAST(d1.cnt AS DOUBLE) AS conf_ab,
          CAST(n_both AS DOUBLE) / CAST(d2.cnt AS DOUBLE) AS conf_ba,
          CAST(d2.cnt AS DOUBLE) / tot.n AS share_b
          FROM pairs JOIN deg d1 ON d1.product_id = a JOIN deg d2 ON d2.product_id = bb CROSS JOIN tot"""),
        ("r", """SELECT a AS antecedent_id, bb AS consequent_id, support, conf_ab AS confidence, conf_ab / share_b AS lift
          FROM m WHERE support >= 0.001 AND (conf_ab >= 0.1 OR conf_ba >= 0.1)"""),
    )


Q["association_rules"] = _rules("LIMIT 10")
Q["association_rules_all"] = _rules("")
