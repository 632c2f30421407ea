"""Versions, commits and upserts of the graph store."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from posgraph.operators import graph, lookups, recommend
from posgraph.plans import pipeline
from posgraph.sources import store
from tests.conftest import graph_of, pos_frame, table


def _tmp():
    return tempfile.mkdtemp(prefix="pos-store-", dir="/tmp")


def lines(spark, n=24, first=0, **over):
    return pos_frame(spark, [{"CUSTOMER_ID": f"C{i % 5}", "ITEM_CD_UNIQUE": f"P{(i * 7) % 6}", "RECEIPT_NO": str(i // 2),
                              "SALES_DETAIL_NO": str(i), "SALES_AMT": i + 1, **over} for i in range(first, first + n)])


def edge(person, product, n, amount=10):
    return {"person_id": person, "product_id": product, "id": n, "store_id": "S1", "datetime": "20240101T000000",
            "quantity": 1, "amount": amount}


def answers(g):
    """Every kind of query on the graph."""
    ids = g.person.select("id")
    frames = [lookups.person_purchases_all(g, 3), lookups.product_purchasers_all(g, 3), lookups.person_statistics_all(g),
              lookups.product_statistics_all(g), recommend.related_products_batch(g, g.product.select("id")),
              recommend.user_recommendations_batch(g, ids, 3, 0.1), recommend.item_recommendations_batch(g, ids, 3, 0.05),
              recommend.user_recommendations(g, "C1"), recommend.item_recommendations(g, "C1", similarity_threshold=0.0),
              recommend.related_products(g, "P1"), recommend.association_rules(g, 0.0, 0.0, None),
              g.person_degree, g.product_degree, g.purchase, g.purchase_by_product, graph.graph_counts(g)]
    return [sorted((tuple(r) for r in f.collect()), key=repr) for f in frames]


def state(g):
    return [sorted((tuple(r) for r in f.collect()), key=repr) for f in (g.purchase, g.purchase_by_product, g.product_degree)]


def test_a_load_that_dies_halfway_leaves_the_old_graph(spark, monkeypatch):
    root = pipeline.materialize_graph(lines(spark), _tmp())
    before = state(store.read_graph(spark, root))

    def killed(*args, **kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(store, "write_indexes", killed)
        with pytest.raises(RuntimeError):
            pipeline.materialize_graph(lines(spark, 5), root)
        assert len([f for f in os.listdir(root) if f.startswith("v-")]) == 2  # nodes and edges of the new version are there
        assert state(store.read_graph(spark, root)) == before
    pipeline.materialize_graph(lines(spark, 5), root)
    assert store.read_graph(spark, root).purchase.count() == 5


def test_a_reader_keeps_its_version(spark):
    root = pipeline.materialize_graph(lines(spark), _tmp())
    old = store.read_graph(spark, root)
    pipeline.materialize_graph(lines(spark, 3), root)
    assert old.purchase.count() == 24 and store.read_graph(spark, root).purchase.count() == 3
    gone = store.expire(spark, root, keep=1)
    assert len(gone) == 1 and store.read_graph(spark, root).purchase.count() == 3


def test_the_second_of_two_writers_fails(spark):
    root = pipeline.materialize_graph(lines(spark), _tmp())
    now = store.current(spark, root)
    store.commit(spark, root, now["tables"], now["buckets"], now)
    with pytest.raises(FileExistsError):
        store.commit(spark, root, now["tables"], now["buckets"], now)
    assert store.current(spark, root)["number"] == 2
    assert not [f for f in os.listdir(f"{root}/_commits") if f.startswith(".") and not f.endswith(".crc")]


def test_upsert_answers_like_a_full_rebuild(spark):
    first, second = lines(spark, 24), lines(spark, 14, first=18, SALES_NUM=3)
    root = pipeline.materialize_graph(first, _tmp(), buckets=4)
    later, _ = pipeline.graph_from_pos(second)
    g = store.upsert_graph(spark, root, later.tables())
    merged = {n: store.upsert(t, u, store.TABLE_KEYS[n]) for (n, t), u in zip(
        pipeline.graph_from_pos(first)[0].tables().items(), later.tables().values(), strict=True)}
    whole = store.read_graph(spark, store.write_graph(graph.Graph(**merged), _tmp()))
    assert answers(g) == answers(whole)
    assert store.edge_ends_missing(g).count() == 0


def test_upsert_touches_only_its_buckets(spark):
    rows = [(f"C{i % 40}", f"P{i % 30}", str(i), "20240101T000000") for i in range(200)]
    root = store.write_graph(graph_of(spark, rows), _tmp(), buckets=8)

    def files():
        now = store.read_graph(spark, root)
        return {n: set(df.inputFiles()) for n, df in (*now.tables().items(), ("copy", now.purchase_by_product),
                                                      ("pd", now.person_degree), ("qd", now.product_degree))}
    before = files()
    g = store.upsert_graph(spark, root, {"purchase": table(spark, "purchase", [
        edge("C1", "P1", "1", 99), edge("C1", "P2", "new"), edge("C1", "P2", "new2"), edge("nobody", "P1", "x")])})
    after = files()
    assert all(before[n] == after[n] for n in ("person", "product", "store", "visit"))
    for n, most in (("purchase", 1), ("pd", 1), ("copy", 2), ("qd", 2)):  # one person, two products
        moved = {f.split("bucket=")[1].split("/")[0] for f in after[n] - before[n]}
        assert 1 <= len(moved) <= most and before[n] & after[n]
        assert {f for f in before[n] if f.split("bucket=")[1].split("/")[0] not in moved} <= after[n]
    got = {r.id: r.amount for r in g.purchase.where("person_id = 'C1'").collect()}
    assert got["1"] == 99 and got["new"] == 10 and "x" not in {r.id for r in g.purchase.collect()}
    assert sorted(g.person_degree.collect()) == sorted(graph.person_degree(g.purchase).collect())
    assert sorted(g.product_degree.collect()) == sorted(graph.product_degree(g.purchase).collect())
    assert sorted(g.purchase.collect()) == sorted(g.purchase_by_product.collect())


def test_upsert_of_nothing_and_of_new_nodes(spark):
    root = store.write_graph(graph_of(spark, [("C1", "P1", "1", "x")]), _tmp())
    before = state(store.read_graph(spark, root))
    assert state(store.upsert_graph(spark, root, {"purchase": table(spark, "purchase", []), "person": table(spark, "person", [])})) == before
    g = store.upsert_graph(spark, root, {"person": table(spark, "person", [{"id": "C9", "gender": "2"}, {"id": "C1", "gender": "7"}]),
                                         "purchase": table(spark, "purchase", [edge("C9", "P1", "2"), edge("C9", "P7", "3")])})
    assert {r.id: r.gender for r in g.person.collect()} == {"C1": "7", "C9": "2"}
    assert [tuple(r) for r in g.product_degree.collect()] == [("P1", 2, 2)]
    assert g.visit.count() == 0


def test_upsert_needs_a_committed_graph(spark):
    with pytest.raises(ValueError):
        store.upsert_graph(spark, _tmp(), {})
    root = store.write_graph(graph_of(spark, [("C1", "P1", "1", "x")]), _tmp())
    with pytest.raises(ValueError):
        store.upsert_graph(spark, root, {"people": spark.range(1)})


def test_point_lookup_reads_few_buckets_worth_of_files(spark):
    """A hot person is split over files inside its bucket."""
    rows = [("H", f"P{i:03d}", str(i), "x") for i in range(300)] + [(f"C{i}", "P000", f"c{i}", "x") for i in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        g = store.read_graph(spark, store.write_graph(graph_of(spark, rows), _tmp(), buckets=4))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = g.purchase.where("person_id = 'H'").select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) > 1 and len({r.f.split("bucket=")[1].split("/")[0] for r in files}) == 1


def test_merge_in_the_range_shuffle(spark, tmp_path):
    """Rows of a merge key become one while the table is put in order: updates before base, then the total order."""
    edge = {"person_id": "p", "product_id": "q", "id": "1", "store_id": "s", "datetime": "d"}
    base = table(spark, "purchase", [edge | {"amount": 1}, edge | {"id": "2", "amount": 5}])
    updates = table(spark, "purchase", [edge | {"amount": 9}, edge | {"amount": 8}, edge | {"id": "3", "amount": 7}])
    both = store._both(base, updates)
    plan = store._ranged(both, store.CLUSTER["purchase"], merge=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    for buckets in (None, 4):
        path = str(tmp_path / f"b{buckets}")
        store.write_table(both, path, "purchase", buckets=buckets, merge=True)
        got = {(r["id"], int(r["amount"])) for r in spark.read.parquet(path).collect()}
        assert got == {("1", 8), ("2", 5), ("3", 7)}


def test_merged_edges_are_not_sorted_before_their_shuffle(spark):
    lines = table(spark, "purchase", [{"person_id": "p", "product_id": "q", "id": "1"}])
    plan = graph._merged(lines, "purchase")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.rindex("WindowGroupLimit") < plan.index("Exchange")
