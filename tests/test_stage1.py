"""Stage 1: sources, node and edge projections, reports (hand-made cases)."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from posgraph.functions.dates import date_bounds, day_bounds, day_list
from posgraph.operators import edges, nodes, reports
from posgraph.sources import pos as pos_src
from tests.conftest import pos_frame


def test_day_list_ends_on_start_inclusive():
    assert day_list("20241211", 3) == ["20241209", "20241210", "20241211"]
    assert day_list("20240301", 2) == ["20240229", "20240301"]
    assert day_bounds("20241211", 1) == (20241211, 20241211)
    with pytest.raises(ValueError):
        day_list("2024-12-11", 1)


def test_date_bounds():
    assert date_bounds("2024-01-01", "2024-03-31") == ("20240101T000000", "20240331T235959")
    assert date_bounds("", None) == (None, None)
    with pytest.raises(ValueError):
        date_bounds("2024/01/01", None)


def test_sales_filter_and_company(spark):
    df = pos_frame(spark, [
        {"RECEIPT_NO": "1"},
        {"RECEIPT_NO": "2", "SALES_SIGN": "-"},
        {"RECEIPT_NO": "3", "COUNTRY_CD": "20"},
        {"RECEIPT_NO": "4", "COMPANY_CD_UNIQUE": "2"},
    ])
    assert sorted(r.RECEIPT_NO for r in pos_src.sales_rows(df).collect()) == ["1", "4"]
    assert [r.RECEIPT_NO for r in pos_src.sales_rows(df, "2").collect()] == ["4"]


def test_day_directories_and_conform(spark):
    """Day-directory layout: only the window's days are scanned; text prices are cast."""
    base = tempfile.mkdtemp(prefix="pos-days-", dir="/tmp")
    df = pos_frame(spark, [{"SALES_YMD": d, "RECEIPT_NO": str(d)} for d in (20241209, 20241210, 20241211)])
    for d in (20241209, 20241210, 20241211):
        (df.where(F.col("SALES_YMD") == d)
         .withColumn("MASTER_PRICE", F.lit("12.5"))
         .write.parquet(os.path.join(base, f"{d}_part")))
    got = pos_src.read_pos_days(spark, base, "20241211", periods=2)
    assert sorted(r.SALES_YMD for r in got.collect()) == [20241210, 20241211]
    assert got.select("MASTER_PRICE").first()[0] == Decimal("12.50")
    # a day without files raises, unless it is asked for
    assert pos_src.missing_days(spark, base, "20241212", 3) == ["20241212"]
    with pytest.raises(FileNotFoundError, match="20241212"):
        pos_src.read_pos_days(spark, base, "20241212", periods=3)
    assert pos_src.read_pos_days(spark, base, "20241212", periods=3, skip_missing=True).count() == 2
    assert pos_src.read_pos_days(spark, base, "20230101", periods=1, skip_missing=True).count() == 0
    # predicate form on a table with the day column
    assert pos_src.in_day_range(df, "20241210", 2).count() == 2


def test_null_customer_gives_no_person_or_edges_but_counts_in_total(spark):
    df = pos_frame(spark, [
        {"CUSTOMER_ID": None, "RECEIPT_NO": "R0", "SALES_AMT": 5},
        {"CUSTOMER_ID": "C1", "RECEIPT_NO": "R1", "SALES_AMT": 7},
    ])
    assert [r.id for r in nodes.persons(df).collect()] == ["C1"]
    assert [r.person_id for r in edges.purchases(df).collect()] == ["C1"]
    v = edges.visits(df, "store_day").collect()
    assert len(v) == 1 and v[0].person_id == "C1" and v[0].total_amount == Decimal("12.00")


def test_null_birth_month_and_bad_dates(spark):
    df = pos_frame(spark, [{"BIRTHDAY_M": None, "BIRTHDAY_Y": "1950", "BIRTHDAY_D": "1",
                            "EXPIRATION_DATE": "not-a-date", "MASTER_PRICE": None}])
    p = nodes.persons(df).first()
    assert p.birth_date == "1950-01"
    assert p.membership_expiration_date is None
    assert p.membership_start_date == dt.datetime(2010, 1, 15)
    assert p.membership_registration_date == dt.datetime(2009, 12, 1)  # compact yyyyMMdd
    assert p.contact_preferences_dm_stop is True and p.contact_preferences_email_stop is False


def test_null_flag_stays_null(spark):
    p = nodes.persons(pos_frame(spark, [{"DM_STOP_TYPE": None}])).first()
    assert p.contact_preferences_dm_stop is None


def test_receipt_vs_line_grain(spark):
    df = pos_frame(spark, [
        {"ITEM_CD_UNIQUE": "P1", "SALES_DETAIL_NO": "1"},
        {"ITEM_CD_UNIQUE": "P2", "SALES_DETAIL_NO": "2"},
    ])
    assert edges.purchases(df, "receipt").count() == 1
    assert edges.purchases(df, "line").count() == 2
    # deterministic survivor: smallest by the remaining columns
    assert edges.purchases(df, "receipt").first().product_id == "P1"


def test_store_day_vs_receipt_visits(spark):
    df = pos_frame(spark, [
        {"CUSTOMER_ID": "C1", "RECEIPT_NO": "R1"},
        {"CUSTOMER_ID": "C2", "RECEIPT_NO": "R2"},
    ])
    assert edges.visits(df, "store_day").count() == 1
    assert edges.visits(df, "receipt").count() == 2
    with pytest.raises(ValueError):
        edges.visits(df, "week")


def test_null_time_gives_null_datetime(spark):
    df = pos_frame(spark, [{"SALES_HMS": None}])
    assert edges.purchases(df, "line").first().datetime is None


def test_dedupe_is_independent_of_partitioning(spark):
    rows = [{"CUSTOMER_ID": f"C{i % 7}", "RECEIPT_NO": f"R{i % 5}", "ITEM_CD_UNIQUE": f"P{i}",
             "SALES_DETAIL_NO": str(i)} for i in range(40)]
    df = pos_frame(spark, rows)
    a = sorted(edges.purchases(df.repartition(1), "receipt").collect())
    b = sorted(edges.purchases(df.repartition(7), "receipt").collect())
    assert a == b


def test_reports(spark):
    df = pos_frame(spark, [
        {"ITEM_CD_UNIQUE": "P1", "RECEIPT_NO": "1", "SALES_NUM": 2, "SALES_AMT": 3},
        {"ITEM_CD_UNIQUE": "P1", "RECEIPT_NO": "2", "SALES_NUM": 1, "SALES_AMT": 4, "PAYMENTS_DIV": "card"},
        {"ITEM_CD_UNIQUE": "P2", "RECEIPT_NO": "3", "CUSTOMER_ID": "C2", "SHOP_CD": "S2"},
    ])
    p = edges.purchases(df, "receipt")
    top = reports.top_products(p).collect()
    assert (top[0].product_id, top[0].purchase_count, top[0].total_quantity, top[0].total_amount) == \
        ("P1", 2, Decimal("3.000"), Decimal("7.00"))
    mix = {r.payment_method: r["count"] for r in reports.payment_mix(p).collect()}
    assert mix == {"cash": 2, "card": 1}
    stores = reports.top_stores(edges.visits(df, "receipt")).collect()
    assert [(r.store_id, r.visit_count, r.unique_visitors) for r in stores] == [("S1", 2, 1), ("S2", 1, 1)]


def test_existing_session_is_not_reconfigured(spark):
    from posgraph.session import get_session, recommended_conf
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        same = get_session("local[2]", shuffle_partitions=99)
        assert same is spark
        assert same.conf.get("spark.sql.shuffle.partitions") == "5"
        assert same.sparkContext.getCheckpointDir()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    conf = recommended_conf(100 * 2**40)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20) + 1
    assert recommended_conf(1)["spark.sql.shuffle.partitions"] == "200"


def test_conform_raises_for_missing_columns(spark):
    df = spark.createDataFrame([("C1", "12.345")], "CUSTOMER_ID string, MASTER_PRICE string")
    cols = ["CUSTOMER_ID", "MASTER_PRICE", "PD_NM"]
    out = pos_src.conform(df, cols, optional=["PD_NM"]).first()
    assert out.CUSTOMER_ID == "C1" and out.MASTER_PRICE == Decimal("12.35") and out.PD_NM is None
    with pytest.raises(ValueError, match="PD_NM"):
        pos_src.conform(df, cols)
    with pytest.raises(ValueError, match="SHOP_CD"):  # a key column is never optional
        pos_src.conform(df, ["CUSTOMER_ID", "SHOP_CD"], optional=["SHOP_CD"])


def test_a_column_that_changes_type_between_days(spark):
    base = tempfile.mkdtemp(prefix="pos-drift-", dir="/tmp")
    df = pos_frame(spark, [{"SALES_YMD": 20241209, "MASTER_PRICE": 7}])
    df.write.parquet(f"{base}/20241209")
    df.withColumn("SALES_YMD", F.lit(20241210)).withColumn("MASTER_PRICE", F.lit("8.5")).write.parquet(f"{base}/20241210")
    got = pos_src.read_pos_days(spark, base, "20241210", periods=2, cols=["SALES_YMD", "MASTER_PRICE"])
    assert sorted(map(tuple, got.collect())) == [(20241209, Decimal("7.00")), (20241210, Decimal("8.50"))]
    with pytest.raises(ValueError, match="SALES_SIGN"):
        df.drop("SALES_SIGN").write.parquet(f"{base}/20241211")
        pos_src.read_pos_days(spark, base, "20241211", periods=1, cols=["CUSTOMER_ID"])


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_one_scan_for_each_schema(spark):
    """Many days plan as many scans as they have schemas, also where one day holds two."""
    base = tempfile.mkdtemp(prefix="pos-schemas-", dir="/tmp")
    df = pos_frame(spark, [{"MASTER_PRICE": 7}])
    for day in range(20241201, 20241213):
        price = F.lit("8.5") if day % 2 else F.lit(Decimal("7"))
        df.withColumn("SALES_YMD", F.lit(day)).withColumn(
            "MASTER_PRICE", price.cast("string" if day % 2 else "decimal(14,2)")).write.parquet(f"{base}/{day} a")
    cols = ["SALES_YMD", "MASTER_PRICE"]
    got = pos_src.read_pos_days(spark, base, "20241212", periods=12, cols=cols)
    want = [(d, Decimal("8.50") if d % 2 else Decimal("7.00")) for d in range(20241201, 20241213)]
    assert sorted(map(tuple, got.collect())) == want
    assert _scans(got) == 2
    # a type that changes inside one day: its files join the scans of their schemas
    df.withColumn("SALES_YMD", F.lit(20241212)).withColumn("MASTER_PRICE", F.lit("9.25")).write.mode("append").parquet(
        f"{base}/20241212 a")
    got = pos_src.read_pos_days(spark, base, "20241212", periods=12, cols=cols)
    assert sorted(map(tuple, got.collect())) == sorted([*want, (20241212, Decimal("9.25"))])
    assert _scans(got) == 2
    # partition folders inside a day keep their columns, in whole and in mixed folders
    odd = tempfile.mkdtemp(prefix="pos-nested-", dir="/tmp")
    line = df.withColumn("SALES_YMD", F.lit(20241201))
    line.write.partitionBy("SHOP_CD").parquet(f"{odd}/20241201")
    line.withColumn("MASTER_PRICE", F.lit("3")).write.mode("append").partitionBy("SHOP_CD").parquet(f"{odd}/20241201")
    line.withColumn("SALES_YMD", F.lit(20241202)).write.partitionBy("SHOP_CD").parquet(f"{odd}/20241202")
    got = pos_src.read_pos_days(spark, odd, "20241202", periods=2, cols=["SHOP_CD", "MASTER_PRICE"])
    assert sorted(map(tuple, got.collect())) == [("S1", Decimal("3.00")), ("S1", Decimal("7.00")), ("S1", Decimal("7.00"))]


def test_files_that_workers_cannot_open_are_read_with_sparks_schema(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="pos-closed-", dir="/tmp")
    for day in (20241201, 20241202):
        pos_frame(spark, [{"SALES_YMD": day}]).write.parquet(f"{base}/{day}")
    monkeypatch.setattr(pos_src, "_footers", lambda batches: (
        b.append_column("digest", pos_src.pa.nulls(b.num_rows, pos_src.pa.string())) for b in batches))
    got = pos_src.read_pos(spark, f"{base}/*", cols=["SALES_YMD"])
    assert sorted(r.SALES_YMD for r in got.collect()) == [20241201, 20241202]
    with pytest.raises(FileNotFoundError, match="nothing"):
        pos_src.read_pos(spark, [f"{base}/*", f"{base}/nothing"])


def test_checkpoint_folder_is_private_on_local_masters_only():
    from types import SimpleNamespace
    from posgraph.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *a: None, set=lambda *a: None)
    far = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(far)


def test_relationship_counts(spark):
    df = pos_frame(spark, [{"RECEIPT_NO": "1"}, {"RECEIPT_NO": "2", "CUSTOMER_ID": "C2"},
                           {"RECEIPT_NO": "2", "CUSTOMER_ID": "C2", "SALES_DETAIL_NO": "2"}])
    got = {r.name: r["count"] for r in edges.relationship_counts(*edges.extract_relationships(df)).collect()}
    assert got == {"purchases": 2, "visits": 1}
