"""Stage 2: graph tables, JSON lines, integrity joins, upserts, checks."""

import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from posgraph.operators import edges, graph, nodes
from posgraph.plans import pipeline
from posgraph.sources import jsonl, store
from tests.conftest import pos_frame, table


def _tmp():
    return tempfile.mkdtemp(prefix="posgraph-test-", dir="/tmp")


def test_defaults_when_fields_missing(spark):
    persons = spark.createDataFrame([("C1", None, None)], "id string, gender string, birth_date string")
    for c in ("location_prefecture", "location_zip_code", "location_coordinates_latitude",
              "location_coordinates_longitude", "membership_member_id", "membership_status"):
        persons = persons.withColumn(c, F.lit(None).cast("string"))
    t, rejects = graph.person_props(persons)
    r = t.first()
    assert (r.gender, r.birth_date, r.prefecture, r.status) == ("0", "", "", "")
    assert rejects.count() == 0


def test_product_price_is_master_price_or_zero(spark):
    df = pos_frame(spark, [{"ITEM_CD_UNIQUE": "P1", "MASTER_PRICE": 9.5, "ZEIRITSU": "x"},
                           {"ITEM_CD_UNIQUE": "P2", "MASTER_PRICE": None, "ZEIRITSU": None}])
    t, _ = graph.product_props(nodes.products(df))
    got = {r.id: (r.price, r.tax_rate) for r in t.collect()}
    assert got == {"P1": (Decimal("9.50"), 0), "P2": (Decimal("0.00"), 0)}


def test_edges_to_unknown_nodes(spark):
    """Unknown person/product drop a purchase; unknown store keeps it but drops a visit."""
    df = pos_frame(spark, [
        {"CUSTOMER_ID": "C1", "ITEM_CD_UNIQUE": "P1", "SHOP_CD": "S1", "RECEIPT_NO": "1"},
        {"CUSTOMER_ID": "C2", "ITEM_CD_UNIQUE": "P2", "SHOP_CD": "S9", "RECEIPT_NO": "2"},
    ])
    person = table(spark, "person", [{"id": "C1"}, {"id": "C2"}])
    product = table(spark, "product", [{"id": "P1"}])
    store_t = table(spark, "store", [{"id": "S1"}])
    pe, _ = graph.purchase_edges(edges.purchase_lines(df, "line"), person, product)
    assert [r.product_id for r in pe.collect()] == ["P1"]
    pe2, _ = graph.purchase_edges(edges.purchase_lines(df, "line"), person,
                                  table(spark, "product", [{"id": "P1"}, {"id": "P2"}]))
    assert sorted(r.store_id for r in pe2.collect()) == ["S1", "S9"]
    ve, _ = graph.visit_edges(edges.visits(df, "receipt"), person, store_t)
    assert [r.store_id for r in ve.collect()] == ["S1"]


def test_missing_required_field_is_rejected_not_fatal(spark):
    df = pos_frame(spark, [{"RECEIPT_NO": "1"}, {"RECEIPT_NO": "2", "SALES_HMS": None}])
    person = table(spark, "person", [{"id": "C1"}])
    product = table(spark, "product", [{"id": "P1"}])
    pe, rejects = graph.purchase_edges(edges.purchase_lines(df, "line"), person, product)
    assert pe.count() == 1 and rejects.count() == 1


def test_edge_merge_key_keeps_one_row(spark):
    df = pos_frame(spark, [{"SALES_AMT": 1}, {"SALES_AMT": 2}])  # same person/product/line id
    person = table(spark, "person", [{"id": "C1"}])
    product = table(spark, "product", [{"id": "P1"}])
    pe, _ = graph.purchase_edges(edges.purchase_lines(df, "line"), person, product)
    rows = pe.collect()
    assert len(rows) == 1 and rows[0].amount == Decimal("1.00")


def test_visit_datetime_parsed(spark):
    df = pos_frame(spark, [{"SALES_YMD": 20241211, "SALES_HMS": "235958"}])
    g, _ = pipeline.graph_from_pos(df)
    import datetime as dt
    assert g.visit.first().datetime == dt.datetime(2024, 12, 11, 23, 59, 58)


def test_json_roundtrip_and_broken_lines(spark):
    df = pos_frame(spark, [
        {"CUSTOMER_ID": "C1", "ITEM_CD_UNIQUE": "P1", "RECEIPT_NO": "1", "SALES_AMT": 3.25,
         "SALES_NUM": 1.5},
        {"CUSTOMER_ID": "C2", "ITEM_CD_UNIQUE": "P2", "RECEIPT_NO": "2", "SALES_AMT": 4},
    ])
    root = _tmp()
    node_dir, rel_dir = os.path.join(root, "node"), os.path.join(root, "relation")
    pipeline.pos_to_files(df, node_dir, rel_dir)
    # add a blank line and a broken line to one node file
    pdir = os.path.join(node_dir, "persons.json")
    with open(os.path.join(pdir, "zz-extra.json"), "w") as fh:
        fh.write("\n{not json\n")
    g, rejects = pipeline.graph_from_files(spark, node_dir, rel_dir)
    assert g.person.count() == 2
    assert rejects["persons_lines"].count() == 1
    rows = {r.product_id: r for r in g.purchase.collect()}
    assert rows["P1"].amount == Decimal("3.25") and rows["P1"].quantity == Decimal("1.500")
    good, _ = jsonl.read_json_lines(spark, os.path.join(node_dir, "persons.json"), "persons")
    assert good.schema["membership"].dataType["start_date"].dataType.typeName() == "timestamp_ntz"


def test_the_five_sinks_are_written_at_the_same_time(spark, monkeypatch):
    """Each sink waits until all five are under way: one after another they would never start."""
    import threading

    together, write = threading.Barrier(5, timeout=60), jsonl.write_json

    def waiting(nested_df, path):
        together.wait()
        return write(nested_df, path)
    monkeypatch.setattr(jsonl, "write_json", waiting)
    root = _tmp()
    pipeline.pos_to_files(pos_frame(spark, [{"CUSTOMER_ID": "C1"}, {"CUSTOMER_ID": "C2", "RECEIPT_NO": "2"}]),
                          f"{root}/node", f"{root}/relation")
    for kind, folder, n in (("persons", "node", 2), ("products", "node", 1), ("stores", "node", 1),
                            ("purchases", "relation", 2), ("visits", "relation", 1)):
        good, bad = jsonl.read_flat(spark, f"{root}/{folder}/{kind}.json", kind)
        assert good.count() == n and bad.isEmpty()


def test_a_load_parses_once_and_keeps_its_rejects(spark):
    """Counts and rejects of a load come from its tables: they stay when the JSON files are gone."""
    import shutil

    from posgraph.plans.api import import_graph, reject_counts
    root = _tmp()
    pipeline.pos_to_files(pos_frame(spark, [{"CUSTOMER_ID": "C1"}, {"CUSTOMER_ID": "C2", "RECEIPT_NO": "2"}]),
                          f"{root}/node", f"{root}/relation")
    with open(f"{root}/node/persons.json/zz.json", "w") as fh:
        fh.write('\n{not json\n{"gender": "1"}\n')
    counts, rejects = import_graph(spark, f"{root}/node", f"{root}/relation", f"{root}/graph")
    shutil.rmtree(f"{root}/node")
    assert {r.name: r["count"] for r in counts.collect()}["Person nodes"] == 2
    lost = {r.name: r["count"] for r in reject_counts(rejects).collect()}
    assert {k: n for k, n in lost.items() if n} == {"persons_lines": 1, "person": 1} and len(lost) == 10
    line = rejects["persons_lines"].first()
    assert line[jsonl.CORRUPT] == "{not json" and line.file.endswith("zz.json")
    assert rejects["person"].first().gender == "1"


def test_staged_lines_equal_read_lines(spark):
    root = _tmp()
    df = pos_frame(spark, [{"CUSTOMER_ID": f"C{i}"} for i in range(5)])
    pipeline.pos_to_files(df, f"{root}/node", f"{root}/relation")
    path = f"{root}/node/persons.json"
    good, bad = jsonl.read_json_lines(spark, path, "persons")
    staged, broken = jsonl.stage_json_lines(spark, path, "persons", f"{root}/staged")
    assert staged.schema == good.schema and sorted(map(str, staged.collect())) == sorted(map(str, good.collect()))
    assert broken.columns == bad.columns and broken.isEmpty()


def test_unique_violations_and_counts(spark):
    person = table(spark, "person", [{"id": "A"}, {"id": "A"}, {"id": "B"}])
    g = graph.Graph(person, table(spark, "product", [{"id": "P"}]), table(spark, "store", []),
                    table(spark, "purchase", []), table(spark, "visit", []))
    v = graph.unique_violations(g).collect()
    assert [(r.label, r.id, r["count"]) for r in v] == [("person", "A", 2)]
    counts = {r.name: r["count"] for r in graph.graph_counts(g).collect()}
    assert counts["Person nodes"] == 3 and counts["Visit relationships"] == 0


def test_upsert_replaces_by_key_and_keeps_the_rest(spark):
    root = _tmp()
    base = table(spark, "product", [{"id": "P1", "name": "old"}, {"id": "P2", "name": "keep"}])
    store.write_table(base, f"{root}/v1/product", "product")
    updates = table(spark, "product", [{"id": "P1", "name": "new"}, {"id": "P3", "name": "added"}])
    out = store.upsert_table(spark, f"{root}/v1", f"{root}/v2", "product", updates)
    assert {r.id: r.name for r in out.collect()} == {"P1": "new", "P2": "keep", "P3": "added"}
    # the base version is untouched
    assert {r.id: r.name for r in store.read_table(spark, f"{root}/v1", "product").collect()} == \
        {"P1": "old", "P2": "keep"}


def test_write_graph_replaces_the_indexes_too(spark):
    from posgraph.operators import lookups
    rows = [{"CUSTOMER_ID": f"C{i % 3}", "ITEM_CD_UNIQUE": f"P{i % 4}", "RECEIPT_NO": str(i)} for i in range(12)]
    root = pipeline.materialize_graph(pos_frame(spark, rows), _tmp())
    g, _ = pipeline.graph_from_pos(pos_frame(spark, [{"CUSTOMER_ID": "N", "ITEM_CD_UNIQUE": "Q", "RECEIPT_NO": "1"}]))
    store.write_graph(g, root)
    g = store.read_graph(spark, root)
    assert g.purchase.count() == g.purchase_by_product.count() == 1
    assert [tuple(r) for r in g.person_degree.collect()] == [("N", 1, 1)]
    assert [r.person_id for r in lookups.product_purchasers(g, "Q").collect()] == ["N"]


def test_stage1_runs_its_source_once(spark):
    path = os.path.join(_tmp(), "pos")
    pos_frame(spark, [{"CUSTOMER_ID": f"C{i}", "RECEIPT_NO": str(i)} for i in range(5)]).write.parquet(path)
    with pipeline._staged(spark.read.parquet(path), True) as lines:
        assert all("lines-" in f for f in lines.inputFiles()) and lines.count() == 5
        scratch = os.path.dirname(lines.inputFiles()[0]).removeprefix("file://")
    assert not os.path.exists(scratch)  # removed afterwards


def test_stored_graph_has_no_dangling_edges(spark):
    df = pos_frame(spark, [{"CUSTOMER_ID": f"C{i % 3}", "ITEM_CD_UNIQUE": f"P{i % 4}",
                            "RECEIPT_NO": str(i)} for i in range(12)])
    root = pipeline.materialize_graph(df, _tmp())
    g = store.read_graph(spark, root)
    assert store.edge_ends_missing(g).count() == 0
    assert graph.unique_violations(g).count() == 0
    assert g.purchase.count() == 12


def test_hot_person_is_spread_over_several_files(spark):
    rows = [{"person_id": "H", "product_id": f"P{i:04d}", "id": str(i), "store_id": "S1",
             "datetime": "20240101T000000"} for i in range(400)]
    rows += [{"person_id": f"C{i}", "product_id": "P0000", "id": f"c{i}", "store_id": "S1",
              "datetime": "20240101T000000"} for i in range(40)]
    path = os.path.join(_tmp(), "purchase")
    # AQE would merge these tiny partitions into one; at scale they are not tiny.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write_table(table(spark, "purchase", rows), path, "purchase")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = (spark.read.parquet(path).where(F.col("person_id") == "H")
             .select(F.input_file_name().alias("f")).distinct().count())
    assert files > 1


def test_pipeline_entry_points_and_query_api(spark):
    import pytest
    from posgraph.plans.api import PurchaseGraphQueries, import_graph, transform_pos
    df = pos_frame(spark, [{"CUSTOMER_ID": f"C{i % 3}", "ITEM_CD_UNIQUE": f"P{i % 4}",
                            "RECEIPT_NO": str(i // 2), "SALES_DETAIL_NO": str(i),
                            "SALES_AMT": i + 1} for i in range(12)])
    root = _tmp()
    reports = transform_pos(df, f"{root}/node", f"{root}/relation")
    assert set(reports) == {"top_products", "payment_mix", "top_stores"}
    counts, rejects = import_graph(spark, f"{root}/node", f"{root}/relation", f"{root}/graph")
    got = {r.name: r["count"] for r in counts.collect()}
    assert got["Person nodes"] == 3 and got["Purchase relationships"] == 6   # receipt grain
    assert rejects["purchase"].count() == 0
    q = PurchaseGraphQueries.open(spark, f"{root}/graph")
    assert q.get_person_purchases("C0").count() > 0
    assert q.get_purchase_statistics("P1", "product").first().total_purchases > 0
    with pytest.raises(ValueError):
        q.get_purchase_statistics("P1", "store")
    for df_ in (q.get_product_purchasers("P1"), q.get_related_products("P1"),
                q.get_user_based_recommendations("C0"), q.get_item_based_recommendations("C0"),
                q.get_association_rules(min_support=0.0)):
        df_.collect()


def test_degree_index_matches_computed_and_answers_agree(spark):
    from posgraph.operators import recommend
    from posgraph.operators.graph import person_degree, product_degree
    df = pos_frame(spark, [{"CUSTOMER_ID": f"C{i % 4}", "ITEM_CD_UNIQUE": f"P{(i * 7) % 5}",
                            "RECEIPT_NO": str(i // 3), "SALES_DETAIL_NO": str(i % 2),
                            "SALES_HMS": f"1{i % 10}0000"} for i in range(30)])
    root = pipeline.materialize_graph(df, _tmp())
    g = store.read_graph(spark, root)
    assert g.person_degree is not None and g.product_degree is not None
    assert sorted(g.person_degree.collect()) == sorted(person_degree(g.purchase).collect())
    assert sorted(g.product_degree.collect()) == sorted(product_degree(g.purchase).collect())
    bare = store.read_graph(spark, root)
    bare.person_degree = bare.product_degree = bare.purchase_by_product = None
    for f in (lambda x: recommend.item_recommendations(x, "C1", limit=None, similarity_threshold=0.0),
              lambda x: recommend.item_recommendations(x, "C2", limit=None, similarity_threshold=0.0,
                                                       counting="buyers"),
              lambda x: recommend.association_rules(x, 0.0, 0.0, limit=None, basis="buyers"),
              lambda x: recommend.association_rules(x, 0.0, 0.0, limit=None)):
        assert sorted(f(g).collect()) == sorted(f(bare).collect())
