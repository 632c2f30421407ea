"""The two pipelines as compositions of the operators.

``pos_to_files``  POS lines -> node and edge JSON lines + reports (stage 1)
``graph_from_pos`` POS lines -> five graph tables directly (stage 1 + 2)
``graph_from_files`` JSON lines written by stage 1 -> five graph tables (stage 2)
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from posgraph.operators import edges, graph, nodes, reports
from posgraph.operators.graph import Graph
from posgraph.session import remove_path, scratch_path, shuffles_dropped
from posgraph.sources import jsonl, store


def stage1_frames(pos: DataFrame, purchase_grain: str = "receipt",
                  visit_grain: str = "store_day") -> dict[str, DataFrame]:
    """The five flat stage-1 frames: nodes deduplicated on id, edges on their id."""
    purchases, visits = edges.extract_relationships(pos, purchase_grain, visit_grain)
    return {**nodes.transform_all(pos), "purchases": purchases, "visits": visits}


@contextmanager
def _staged(pos: DataFrame, stage_lines: bool) -> Iterator[DataFrame]:
    """``pos``, or a scratch copy of it while the block runs: its plan then runs once for all sinks.

    Worth it where the lines come out of joins; stored parquet lines are
    better read again, column by column.
    """
    if not stage_lines:
        yield pos
        return
    spark = pos.sparkSession
    path = scratch_path(spark, "lines")
    with shuffles_dropped(spark):
        pos.write.parquet(path)
    try:
        yield spark.read.schema(pos.schema).parquet(path)
    finally:
        remove_path(spark, path)


def staged_lines(pos: DataFrame) -> AbstractContextManager[DataFrame]:
    """A scratch copy of ``pos`` while the block runs, for several loads from the same lines."""
    return _staged(pos, True)


def pos_to_files(pos: DataFrame, node_dir: str, relation_dir: str, purchase_grain: str = "receipt",
                 visit_grain: str = "store_day", stage_lines: bool = True) -> dict[str, DataFrame]:
    """Write persons/products/stores under ``node_dir`` and purchases/visits
    under ``relation_dir`` (JSON lines), then return the three reports (lazy)
    computed from the written edges, so reports and files agree.  With
    ``stage_lines`` the plan of ``pos`` runs once for the five sinks, which are
    written as concurrent jobs."""
    with _staged(pos, stage_lines) as lines, shuffles_dropped(pos.sparkSession):
        frames = stage1_frames(lines, purchase_grain, visit_grain)
        store.in_parallel(
            partial(jsonl.write_frames, {k: frames[k] for k in ("persons", "products", "stores")}, node_dir),
            partial(jsonl.write_frames, {k: frames[k] for k in ("purchases", "visits")}, relation_dir))
    spark = pos.sparkSession
    purchases, _ = jsonl.read_flat(spark, os.path.join(relation_dir, "purchases.json"), "purchases")
    visits, _ = jsonl.read_flat(spark, os.path.join(relation_dir, "visits.json"), "visits")
    return reports.analyze_relationships(purchases, visits)


def _flat_files(spark: SparkSession, node_dir: str, relation_dir: str, staged: str
                ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The five flat frames of the JSON lines, and the lines that do not parse, each set parsed once into ``staged``."""
    dirs = {"persons": node_dir, "products": node_dir, "stores": node_dir,
            "purchases": relation_dir, "visits": relation_dir}
    flat, bad = {}, {}

    def stage(kind: str, d: str) -> None:
        flat[kind], bad[f"{kind}_lines"] = jsonl.read_flat(spark, os.path.join(d, f"{kind}.json"), kind,
                                                           f"{staged}/{kind}")
    with shuffles_dropped(spark):
        store.in_parallel(*[partial(stage, kind, d) for kind, d in dirs.items()])
    return flat, bad


def _kept_rejects(spark: SparkSession, rejects: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The rejects as tables under ``folder``: their counts come from footers."""
    store.in_parallel(*[partial(df.write.parquet, f"{folder}/{name}") for name, df in rejects.items()])
    return {name: spark.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in rejects.items()}


def stored_nodes(persons: DataFrame, products: DataFrame, stores: DataFrame, root: str, buckets: int | None = None
                  ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Node tables written under ``root`` and read back, and their rejects.

    Edges semi-join the stored nodes: the deduplication is not repeated, and
    both sides of the join are plain exchanges, which AQE splits for a hot key.
    """
    spark = persons.sparkSession
    made = {"person": graph.person_props(persons), "product": graph.product_props(products),
            "store": graph.store_props(stores)}
    with shuffles_dropped(spark):
        _write_all({k: good for k, (good, _) in made.items()}, root, buckets)
    return {k: store.read_table(spark, root, k) for k in made}, {k: bad for k, (_, bad) in made.items()}


def _graph(frames: dict[str, DataFrame], root: str, buckets: int | None = None, merge: bool = True
           ) -> tuple[Graph, dict[str, DataFrame]]:
    """Stored nodes and lazy edges of flat stage-1 frames (without ``merge`` for ``_write_edges``, which merges them)."""
    n, rejects = stored_nodes(frames["persons"], frames["products"], frames["stores"], root, buckets)
    purchase, rejects["purchase"] = graph.purchase_edges(frames["purchases"], n["person"], n["product"], merge)
    visit, rejects["visit"] = graph.visit_edges(frames["visits"], n["person"], n["store"], merge)
    return Graph(n["person"], n["product"], n["store"], purchase, visit), rejects


def _write_edges(g: Graph, root: str, buckets: int | None = None) -> None:
    _write_all({"purchase": g.purchase, "visit": g.visit}, root, buckets, merge=True)


def _write_indexes(spark: SparkSession, root: str, buckets: int | None = None) -> None:
    store.write_indexes(store.read_table(spark, root, "purchase"), root, buckets)


@contextmanager
def _new_version(spark: SparkSession, root: str, buckets: int) -> Iterator[str]:
    """The folder of a new version of the graph, committed when the block ends without an error."""
    before, version = store.current(spark, root), store.new_version(root)
    yield os.path.join(root, version)
    store.commit(spark, root, store.whole_version(version), buckets, before)


def graph_from_files(spark: SparkSession, node_dir: str, relation_dir: str
                     ) -> tuple[Graph, dict[str, DataFrame]]:
    """Load the JSON lines of stage 1 into graph tables (parsed lines and nodes in scratch tables, edges lazy).

    Returns (graph, rejects); rejects holds malformed lines (``*_lines``) and
    rows missing a required field, per table.
    """
    flat, bad = _flat_files(spark, node_dir, relation_dir, scratch_path(spark, "json-lines"))
    g, rejects = _graph(flat, scratch_path(spark, "nodes"))
    return g, rejects | bad


def load_files(spark: SparkSession, node_dir: str, relation_dir: str, root: str,
               buckets: int = store.BUCKETS) -> dict[str, DataFrame]:
    """C7 into ``root``, replacing all tables and indexes there by one commit; returns the rejects.

    The JSON files are read and parsed by one job a set; the parse is a scratch
    table that is removed before the indexes are made, the rejects are kept beside the tables
    of the version (``rejects/``).
    """
    staged = scratch_path(spark, "json-lines")
    with shuffles_dropped(spark), _new_version(spark, root, buckets) as folder:
        try:
            flat, bad = _flat_files(spark, node_dir, relation_dir, staged)
            g, rejects = _graph(flat, folder, buckets, merge=False)
            _write_edges(g, folder, buckets)
            kept = _kept_rejects(spark, rejects | bad, f"{folder}/rejects")
        finally:
            remove_path(spark, staged)
        _write_indexes(spark, folder, buckets)
    return kept


def graph_from_pos(pos: DataFrame, purchase_grain: str = "line",
                   visit_grain: str = "store_day", merge: bool = True) -> tuple[Graph, dict[str, DataFrame]]:
    """Graph tables straight from POS lines.

    At ``line`` grain the purchase edges come from every sales line, merged on
    (person, product, line id) — a line id that carries several products
    keeps all of them.  At ``receipt`` grain the stage-1 frame (one line per
    receipt) is loaded, exactly as the file-based chain does.  Without ``merge`` a merge
    key may have several edges: for writers that merge (``sources.store.write_table``).
    """
    return _graph(_flat_pos(pos, purchase_grain, visit_grain), scratch_path(pos.sparkSession, "nodes"), merge=merge)


def _flat_pos(pos: DataFrame, purchase_grain: str, visit_grain: str) -> dict[str, DataFrame]:
    """Flat frames of POS lines; at line grain every sales line is a purchase."""
    lines = edges.purchase_lines(pos, "line") if purchase_grain == "line" else edges.purchases(pos, purchase_grain)
    return {"persons": nodes.persons(pos), "products": nodes.products(pos), "stores": nodes.stores(pos),
            "purchases": lines, "visits": edges.visits(pos, visit_grain)}


def _write_all(tables: dict[str, DataFrame], root: str, buckets: int | None = None, merge: bool = False) -> None:
    """Write independent tables as concurrent Spark jobs."""
    store.in_parallel(*[partial(store.write_table, df, f"{root}/{name}", name, buckets=buckets, merge=merge)
                        for name, df in tables.items()])


def materialize_graph(pos: DataFrame, root: str, purchase_grain: str = "line",
                      visit_grain: str = "store_day", stage_lines: bool = False, buckets: int = store.BUCKETS) -> str:
    """Build and write the graph tables under ``root`` in stages, replacing what is there by one commit.

    1. with ``stage_lines``, the sales lines are written to a scratch table
       that is removed before step 4 (for lines that come out of joins);
    2. node tables are derived from the lines and written;
    3. edge tables semi-join against the *stored* node tables;
    4. the stored purchase edges are copied clustered by product (the
       reverse adjacency used by product-filtered reads), and the degree
       index (edges and products per person, edges and buyers per product) is
       written.

    Tables of one step are independent and are written as concurrent jobs; the shuffles
    of a job are dropped when it ends.
    Readers of ``root`` see what was there until all tables are written.
    """
    spark = pos.sparkSession
    with shuffles_dropped(spark), _new_version(spark, root, buckets) as folder:
        with _staged(pos, stage_lines) as lines:
            g, _ = _graph(_flat_pos(lines, purchase_grain, visit_grain), folder, buckets, merge=False)
            _write_edges(g, folder, buckets)
        _write_indexes(spark, folder, buckets)
    return root
