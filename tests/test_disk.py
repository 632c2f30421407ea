"""Loads hold few bytes on disk at once, and broadcast nothing that grows with the input."""

import glob
import os
import time

from pyspark.sql import functions as F

from posgraph.operators import graph
from posgraph.plans import catalog, pipeline
from posgraph.session import shuffles_dropped
from posgraph.sources import store
from tests.conftest import SF_SMALL, table
from tests.test_store import edge, lines


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(os.path.join(d, "*", "shuffle_*.data"))}


def left_by(spark, job):
    """The shuffle files that are there a little after ``job`` and were not before it (Spark drops them in the background)."""
    before = shuffle_files(spark)
    job()
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_a_load_leaves_no_shuffle_files(spark, tmp_path):
    root = str(tmp_path / "g")
    pos = lines(spark)
    assert not left_by(spark, lambda: pipeline.materialize_graph(pos, root, stage_lines=True))
    assert not left_by(spark, lambda: pipeline.pos_to_files(pos, f"{root}-n", f"{root}-r"))
    assert not left_by(spark, lambda: pipeline.load_files(spark, f"{root}-n", f"{root}-r", f"{root}-2"))
    batch = {"purchase": table(spark, "purchase", [edge("C1", "P1", "new")])}
    assert not left_by(spark, lambda: store.upsert_graph(spark, root, batch))


def test_the_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with shuffles_dropped(spark):
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before


def test_scratch_copies_go(spark, tmp_path):
    def scratch():
        return set(glob.glob(os.path.join(spark.sparkContext.getCheckpointDir().removeprefix("file:"), "posgraph", "*")))
    root, before = pipeline.materialize_graph(lines(spark), str(tmp_path / "g")), scratch()
    store.upsert_graph(spark, root, {"purchase": table(spark, "purchase", [edge("C1", "P1", "new")])})
    assert not scratch() - before


def test_edges_without_an_end_are_left_out(spark):
    rows = [edge("p1", "q1", "1"), edge("p1", "gone", "2"), edge("gone", "q1", "3"), edge("p2", "q2", "4"), edge("gone", "gone", "5")]
    person = table(spark, "person", [{"id": "p1"}, {"id": "p2"}, {"id": "p2"}])  # a repeated node repeats no edge
    product = table(spark, "product", [{"id": "q1"}, {"id": "q2"}])
    ends = {"person_id": person, "product_id": product}
    got = graph.with_ends(table(spark, "purchase", rows), ends)
    assert got.columns == table(spark, "purchase", []).columns
    assert sorted(r["id"] for r in got.collect()) == ["1", "4"]
    assert graph.with_ends(table(spark, "purchase", []), ends).count() == 0
    none = {"person_id": person.limit(0), "product_id": product}
    assert graph.with_ends(table(spark, "purchase", rows), none).count() == 0


def test_edges_are_not_shuffled_to_find_their_ends(spark, tmp_path):
    rows = [edge(f"p{i % 7}", f"q{i % 5}", str(i)) for i in range(50)]
    table(spark, "purchase", rows).write.parquet(str(tmp_path / "e"))
    person = table(spark, "person", [{"id": f"p{i}"} for i in range(7)])
    product = table(spark, "product", [{"id": f"q{i}"} for i in range(5)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = graph.with_ends(spark.read.parquet(str(tmp_path / "e")), {"person_id": person, "product_id": product})
        first = df._jdf.queryExecution().executedPlan().toString()
        below = first[first.rindex("LeftSemi"):]  # the exact joins meet only rows that passed a bitmap
        assert first.count("LeftSemi") == 2 and ("getbit" in below or "bit_get" in below)
        assert len(df.collect()) == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Union" not in final and "amount" not in "".join(p.split("FileScan")[0] for p in final.split("Exchange hashpartitioning")[1:])


def test_node_ids_are_not_broadcast(spark, tmp_path):
    nodes = table(spark, "person", [{"id": "C1"}])
    edges = table(spark, "purchase", [edge("C1", "P1", "1")])
    df = graph.with_ends(edges, {"person_id": nodes})
    before = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [person_id" in before and "LeftAnti" in before and "BroadcastHashJoin [person_id" not in before


def test_upserts_read_the_lines_of_the_joins_once(spark, monkeypatch):
    seen = []
    upsert = store.upsert_table

    def watched(s, root, new_root, name, updates):
        seen.append(updates.inputFiles())
        return upsert(s, root, new_root, name, updates)
    monkeypatch.setattr(store, "upsert_table", watched)
    out = catalog.q_upsert_edges(spark, SF_SMALL)
    assert seen and seen[0] and not [f for f in seen[0] if "lineitem" in f]
    assert out.where(F.col("amount").isNull()).count() == 0
