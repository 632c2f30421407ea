"""Plan shape: the physical plans we rely on for scale."""

import os
import tempfile

import pytest

from posgraph.operators import edges
from posgraph.plans.catalog import QUERIES
from posgraph.sources import pos as pos_src
from tests.conftest import SF_SMALL, pos_frame


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udf_no_cartesian(spark, key):
    p = plan(QUERIES[key](spark, SF_SMALL))
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{key}: {bad}"


def test_dedupe_trims_before_shuffle(spark):
    df = pos_frame(spark, [{"RECEIPT_NO": str(i % 3), "ITEM_CD_UNIQUE": f"P{i}"} for i in range(9)])
    p = plan(edges.purchases(df, "receipt"))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_sales_filter_reaches_the_scan(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pos-scan-", dir="/tmp"), "pos")
    pos_frame(spark, [{"RECEIPT_NO": "1"}]).write.parquet(path)
    df = pos_src.read_pos(spark, path, cols=["CUSTOMER_ID", "ITEM_CD_UNIQUE"], comp_cd="1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(SALES_SIGN), IsNotNull(COUNTRY_CD)" in p
    assert "EqualTo(SALES_SIGN,+)" in p and "EqualTo(COMPANY_CD_UNIQUE,1)" in p
    # only the projected and filtered columns are read
    read_schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "SALES_AMT" not in read_schema and "ITEM_CD_UNIQUE" in read_schema


def test_visits_take_one_pass(spark):
    """Total and first line come from one aggregation: one scan of the lines, no join, no window."""
    path = os.path.join(tempfile.mkdtemp(prefix="pos-visits-", dir="/tmp"), "pos")
    pos_frame(spark, [{"RECEIPT_NO": str(i), "CUSTOMER_ID": f"C{i % 2}"} for i in range(6)]).write.parquet(path)
    for grain in ("store_day", "receipt"):
        p = plan(edges.visits(spark.read.parquet(path), grain))
        assert p.count("FileScan") == 1 and "Join" not in p and "Window" not in p
        assert "partial_sum" in p and "partial_min" in p


def test_lookups_rank_before_they_join(spark):
    """The node join stands above the row limit, so at most k rows a key reach it."""
    from posgraph.operators import lookups
    from tests.conftest import graph_of
    g = graph_of(spark, [("T", "A", "1", "x"), ("U", "A", "2", "x")])
    for df in (lookups.person_purchases_all(g, 3), lookups.product_purchasers_all(g, 3)):
        p = plan(df)
        assert 0 <= p.index("Join") < p.index("WindowGroupLimit")
    for df in (lookups.person_purchases(g, "T"), lookups.product_purchasers(g, "A")):
        p = plan(df)
        assert 0 <= p.index("Join") < p.index("TakeOrderedAndProject")


def test_building_a_frame_runs_no_job(spark):
    from posgraph.operators import lookups, recommend
    from posgraph.plans import pipeline
    from posgraph.sources import store
    df = pos_frame(spark, [{"CUSTOMER_ID": f"C{i % 3}", "ITEM_CD_UNIQUE": f"P{i % 4}", "RECEIPT_NO": str(i)}
                           for i in range(12)])
    g = store.read_graph(spark, pipeline.materialize_graph(df, tempfile.mkdtemp(prefix="pos-lazy-", dir="/tmp")))
    sc = spark.sparkContext
    sc.setJobGroup("lazy", "building frames")
    try:
        frames = [recommend.related_products(g, "P1"), recommend.user_recommendations(g, "C1"),
                  recommend.user_recommendations(g, "C1", similarity_threshold=0.1), recommend.item_recommendations(g, "C1"),
                  recommend.association_rules(g), lookups.person_purchases(g, "C1"), lookups.person_purchases_all(g),
                  lookups.product_purchasers(g, "P1"), lookups.person_statistics(g, "C1")]
        assert not sc.statusTracker().getJobIdsForGroup("lazy")
        frames[0].collect()
        assert sc.statusTracker().getJobIdsForGroup("lazy")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_hot_person_meets_stored_nodes(spark):
    """The edge table semi-joins stored node tables: an exchange on each side, which AQE can split."""
    from posgraph.plans import pipeline
    df = pos_frame(spark, [{"CUSTOMER_ID": "H" if i % 3 else f"C{i}", "RECEIPT_NO": str(i)} for i in range(30)])
    g, _ = pipeline.graph_from_pos(df)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(g.purchase)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    person_side = p[p.rindex("LeftSemi"):] if "LeftSemi" in p else ""
    assert p.count("LeftSemi") == 2 and "Window" not in person_side


def test_product_reads_use_the_product_clustered_copy(spark):
    from posgraph.operators import lookups, recommend
    from posgraph.plans import pipeline
    from posgraph.sources import store
    df = pos_frame(spark, [{"CUSTOMER_ID": f"C{i % 3}", "ITEM_CD_UNIQUE": f"P{i % 4}",
                            "RECEIPT_NO": str(i), "SALES_HMS": f"10{i:02d}00"} for i in range(12)])
    root = pipeline.materialize_graph(df, tempfile.mkdtemp(prefix="pos-rev-", dir="/tmp"))
    g = store.read_graph(spark, root)
    assert g.purchase_by_product is not None
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan(lookups.product_purchasers(g, "P1"))
        assert "purchase_by_product" in p and "EqualTo(product_id,P1)" in p
        assert "purchase_by_product" in plan(recommend.item_recommendations(g, "C1", similarity_threshold=0.0))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # same answers as reading the person-clustered table
    g2 = store.read_graph(spark, root)
    g2.purchase_by_product = None
    for f in (lambda x: lookups.product_purchasers(x, "P1"),
              lambda x: recommend.item_recommendations(x, "C1", similarity_threshold=0.0),
              lambda x: recommend.related_products(x, "P2")):
        assert sorted(f(g).collect()) == sorted(f(g2).collect())
