"""Graph store: the five flat tables and their indexes as parquet, in versions.

Layout: ``{root}/{version}/{table}/bucket=k/part-*.parquet`` and one small file
per commit, ``{root}/_commits/{number}.json``, which names the folders that make
up each table.  A load writes a new version folder and commits it last, so
readers see the old graph whole until then and a failed load changes
nothing.  Of two writers that start from the same commit the second fails.

Buckets are hashes of a table's key column (purchases and visits by person, the
product-clustered copy by product, nodes by id, degrees by their id).  Within a
bucket edges are range partitioned and sorted on (person, product), so a
lookup reads few row groups, and a person holding a third of all edges is
spread over several files.  The second copy of the purchase edges, clustered
by (product, person), is the reverse adjacency; the degree index holds edges
and products per person, edges and buyers per product.

``upsert_graph`` merges a batch (insert-or-replace by key, the last batch wins,
like MERGE ... SET): only the buckets that hold keys of the batch are read and
written; all others stay in the folders where they are.  The reverse copy is
merged the same way, the degrees by the difference that the new edges make.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posgraph.operators.dedupe import keep_one
from posgraph.operators.graph import Graph, conform_table, person_degree, product_degree, with_ends
from posgraph.schemas import TABLE_KEYS, TABLES
from posgraph.session import matching_paths, path_exists, put_text, read_text, remove_path, scratch_path, shuffles_dropped

CLUSTER = {"purchase": ["person_id", "product_id", "id"], "visit": ["person_id", "store_id", "id"]}
BY_PRODUCT = "purchase_by_product"
BY_PRODUCT_CLUSTER = ["product_id", "person_id", "id"]
DEGREE_SCHEMAS = {"person_degree": "person_id string, n bigint, items bigint",
                  "product_degree": "product_id string, edges bigint, buyers bigint"}
NODES, EDGES = ("person", "product", "store"), ("purchase", "visit")
BUCKET_KEY = {**dict.fromkeys(NODES, "id"), **dict.fromkeys(EDGES, "person_id"), BY_PRODUCT: "product_id",
              "person_degree": "person_id", "product_degree": "product_id"}
AGE = "_age"  # of two rows of a merge key the one with the smaller age stays (0: update, 1: base)
BUCKETS = 8  # by default; a batch rewrites whole buckets, so large graphs want thousands


def write_table(df: DataFrame, path: str, name: str, cluster: list[str] | None = None, buckets: int | None = None,
                key: str | None = None, merge: bool = False) -> str:
    """A graph table sorted on its cluster columns, cut into ``buckets`` by ``key`` if given.

    With ``merge`` edge rows may repeat a merge key; the first in the total order stays.  Where there is
    a column ``AGE`` it decides before the others.
    """
    age = [AGE] if merge and AGE in df.columns else []
    df = conform_table(df, name, *age)
    cluster = cluster or CLUSTER.get(name)
    if buckets:
        return _write_buckets(df, path, cluster or [], key or BUCKET_KEY[name], buckets, merge)
    if cluster:
        df = _ranged(df, cluster, merge)
    df.write.mode("overwrite").parquet(path)
    return path


def _ranged(df: DataFrame, order: list[str], merge: bool = False) -> DataFrame:
    """Rows in ranges of ``order``, sorted, merged on it where asked.

    Files hold contiguous key ranges, and a key or a pair with a third of all
    edges is split over several files instead of landing in one task.  The range
    shuffle brings the rows of a merge key together too, so the full rows are
    shuffled once for the merge and the order.
    """
    df = df.repartitionByRange(*order)
    if merge:
        rest = [c for c in df.columns if c not in order]
        df = keep_one(df, order, [c for c in rest if c == AGE] + [c for c in rest if c != AGE]).drop(AGE)
    return df.sortWithinPartitions(*order)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, path: str, cluster: list[str], key: str, buckets: int, merge: bool = False) -> str:
    order = ["bucket", *(cluster or [key])]
    df = df.withColumn("bucket", bucket_of(key, buckets))
    if cluster:
        df = _ranged(df, order, merge)
    else:  # nodes and degrees: one row a key
        df = df.repartition("bucket").sortWithinPartitions(*order)
    df.write.mode("overwrite").partitionBy("bucket").parquet(path)
    return path


def write_indexes(purchase: DataFrame, root: str, buckets: int | None = None) -> None:
    """Reverse adjacency and degree index of stored purchase edges, as concurrent jobs."""
    def degree(df: DataFrame, name: str) -> None:
        path = os.path.join(root, name)
        if buckets:
            _write_buckets(df, path, [], BUCKET_KEY[name], buckets)
        else:
            df.write.mode("overwrite").parquet(path)
    in_parallel(lambda: write_table(purchase, os.path.join(root, BY_PRODUCT), "purchase", BY_PRODUCT_CLUSTER, buckets,
                                    BUCKET_KEY[BY_PRODUCT]),
                lambda: degree(person_degree(purchase), "person_degree"),
                lambda: degree(product_degree(purchase), "product_degree"))


def in_parallel(*jobs) -> list:
    """Independent Spark jobs, one driver thread each."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


# ------------------------------------------------------------------ versions

def new_version(root: str) -> str:
    """The name of a version folder, to be written and then committed."""
    return f"v-{uuid.uuid4().hex[:12]}"


def _commits(spark: SparkSession, root: str) -> list[str]:
    return sorted(matching_paths(spark, os.path.join(root, "_commits", "*.json")))


def current(spark: SparkSession, root: str) -> dict | None:
    """The latest commit: its number, bucket count and the folders of every table (None before the first)."""
    found = _commits(spark, root)
    return json.loads(read_text(spark, found[-1])) if found else None


def commit(spark: SparkSession, root: str, tables: dict[str, list[str]], buckets: int | None, before: dict | None) -> int:
    """Make ``tables`` (name -> folders under ``root``) the graph, if ``before`` is still the latest commit."""
    number = before["number"] + 1 if before else 1
    text = json.dumps({"number": number, "buckets": buckets, "tables": tables})
    put_text(spark, os.path.join(root, "_commits", f"{number:012d}.json"), text)
    return number


def whole_version(version: str) -> dict[str, list[str]]:
    """The tables of a version folder that a full load has written."""
    return {name: [f"{version}/{name}"] for name in (*NODES, *EDGES, BY_PRODUCT, *DEGREE_SCHEMAS)}


def write_graph(g: Graph, root: str, buckets: int = BUCKETS) -> str:
    """S9 + load: a new version of everything under ``root``, the tables and the indexes made from them."""
    spark = g.purchase.sparkSession
    before, version = current(spark, root), new_version(root)
    folder = os.path.join(root, version)
    with shuffles_dropped(spark):
        for name, df in g.tables().items():
            write_table(df, os.path.join(folder, name), name, buckets=buckets)
        write_indexes(read_table(spark, folder, "purchase"), folder, buckets)
    commit(spark, root, whole_version(version), buckets, before)
    return root


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the version folders that none of the last ``keep`` commits uses; returns their names.

    Only while no load is under way: a version that is being written is in no commit yet.
    """
    found = _commits(spark, root)
    tables = [json.loads(read_text(spark, c))["tables"] for c in found[-keep:]]
    used = {folder.split("/")[0] for t in tables for folders in t.values() for folder in folders}
    gone = [p for p in matching_paths(spark, os.path.join(root, "v-*")) if os.path.basename(p) not in used]
    for path in [*gone, *found[:-keep]]:
        remove_path(spark, path)
    return [os.path.basename(p) for p in gone]


def _schema(name: str):
    return DEGREE_SCHEMAS.get(name) or TABLES["purchase" if name == BY_PRODUCT else name]


def _read_folders(spark: SparkSession, root: str, name: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], _schema(name))
    df = spark.read.schema(_schema(name)).parquet(*[os.path.join(root, f) for f in folders])
    return df.drop("bucket")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current graph, or of a plain folder without commits."""
    now = current(spark, root)
    return _read_folders(spark, root, name, now["tables"][name] if now else [name])


def read_graph(spark: SparkSession, root: str) -> Graph:
    """The graph of the latest commit (of a plain folder of tables if there is none)."""
    now = current(spark, root)
    tables = now["tables"] if now else {n: [n] for n in (*NODES, *EDGES, BY_PRODUCT, *DEGREE_SCHEMAS)
                                        if n in TABLES or path_exists(spark, os.path.join(root, n))}
    read = {name: _read_folders(spark, root, name, folders) for name, folders in tables.items()}
    g = Graph(*[read[n] for n in (*NODES, *EDGES)])
    g.purchase_by_product = read.get(BY_PRODUCT)
    for name in DEGREE_SCHEMAS:
        setattr(g, name, read.get(name))
    return g


def write_item_index(g: Graph, items: DataFrame, path: str, counting: str = "paths") -> DataFrame:
    """The item-item path counts of ``items``, stored sorted by item and read back (``recommend.item_recommendations_batch``)."""
    from posgraph.operators.similarity import item_paths

    rows = item_paths(g, items, counting)
    with shuffles_dropped(rows.sparkSession):
        rows.repartitionByRange("h", "c").sortWithinPartitions("h", "c").write.mode("overwrite").parquet(path)
    return g.purchase.sparkSession.read.schema("h string, c string, paths bigint").parquet(path)


# ------------------------------------------------------------------ upserts

def upsert(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-or-replace by key: all update rows (one per key) plus base rows whose key is new.

    One anti join on the key: AQE broadcasts the update side when the batch
    is small, otherwise both sides are shuffled once on the key.
    """
    updates = keep_one(updates, keys)
    return updates.unionByName(base.join(updates.select(*keys), keys, "left_anti"))


def upsert_table(spark: SparkSession, root: str, new_root: str, name: str, updates: DataFrame) -> DataFrame:
    """Merge ``updates`` into table ``name`` of ``root``; write the result under ``new_root``."""
    base, updates = read_table(spark, root, name), conform_table(updates, name)
    path = os.path.join(new_root, name)
    with shuffles_dropped(spark):
        if name in CLUSTER:
            write_table(_both(base, updates), path, name, merge=True)
        else:
            write_table(upsert(base, updates, TABLE_KEYS[name]), path, name)
    return spark.read.schema(TABLES[name]).parquet(path)


def _both(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Rows for ``write_table`` with ``merge``: an ``upsert`` of edges within the shuffle that orders them."""
    return updates.withColumn(AGE, F.lit(0)).unionByName(base.withColumn(AGE, F.lit(1)))


class _Merge:
    """One upsert under way: a new version folder and the folders of every table after it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.before = current(spark, root)
        if not self.before or not self.before["buckets"]:
            raise ValueError(f"no committed graph with buckets under {root}")
        self.buckets: int = self.before["buckets"]
        self.tables: dict[str, list[str]] = {k: list(v) for k, v in self.before["tables"].items()}
        self.version = new_version(root)

    def folders(self, name: str) -> dict[int, str]:
        """Bucket -> folder under the root, of the table as it now is."""
        out = {}
        for folder in self.tables[name]:
            inside = [folder] if "/bucket=" in folder else [
                f"{folder}/{os.path.basename(p)}" for p in matching_paths(self.spark, os.path.join(self.root, folder, "bucket=*"))]
            out.update({int(f.rsplit("=", 1)[1]): f for f in inside})
        return out

    def touched(self, name: str, updates: DataFrame) -> tuple[list[int], DataFrame]:
        """The buckets of the updates' keys (at most ``buckets`` numbers) and the rows that these now hold."""
        rows = updates.select(bucket_of(BUCKET_KEY[name], self.buckets).alias("b")).distinct().collect()
        have = self.folders(name)
        numbers = sorted(r["b"] for r in rows)
        return numbers, _read_folders(self.spark, self.root, name, [have[b] for b in numbers if b in have])

    def replace(self, name: str, numbers: list[int], rows: DataFrame, merge: bool = False) -> None:
        """Write the new rows of the buckets ``numbers``; all other buckets stay where they are."""
        if not numbers:
            return
        path = os.path.join(self.root, self.version, name)
        if name in DEGREE_SCHEMAS:
            _write_buckets(rows, path, [], BUCKET_KEY[name], self.buckets)
        else:
            cluster = BY_PRODUCT_CLUSTER if name == BY_PRODUCT else None
            write_table(rows, path, "purchase" if name == BY_PRODUCT else name, cluster, self.buckets, BUCKET_KEY[name], merge)
        written = {b: f"{self.version}/{name}/bucket={b}" for b in numbers}
        self.tables[name] = [f for _, f in sorted((self.folders(name) | written).items())]

    def table(self, name: str) -> DataFrame:
        return _read_folders(self.spark, self.root, name, self.tables[name])


def upsert_graph(spark: SparkSession, root: str, updates: dict[str, DataFrame]) -> Graph:
    """Merge batches of node and edge rows into the graph under ``root``; one commit at the end.

    ``updates`` maps table names to rows with the table's columns.  Nodes come first;
    edges without end nodes in the merged graph are left out, as in a load.  The
    reverse copy and the degrees follow the purchases, so every query answers
    as on a full rebuild.
    """
    unknown = set(updates) - set(TABLES)
    if unknown:
        raise ValueError(f"no such tables: {', '.join(sorted(unknown))}")
    m = _Merge(spark, root)
    with shuffles_dropped(spark):
        for name in NODES:
            if name in updates:
                with _staged(keep_one(conform_table(updates[name], name), TABLE_KEYS[name])) as rows:
                    _upsert_buckets(m, name, rows)
        for name, other in (("purchase", "product"), ("visit", "store")):
            if name in updates:
                rows = keep_one(conform_table(updates[name], name), TABLE_KEYS[name])
                with _staged(rows, {f"{n}_id": m.table(n) for n in ("person", other)}) as rows:
                    if name == "purchase":
                        _upsert_degrees(m, rows)
                        _upsert_buckets(m, BY_PRODUCT, rows)
                    _upsert_buckets(m, name, rows)
    commit(spark, root, m.tables, m.buckets, m.before)
    return read_graph(spark, root)


@contextmanager
def _staged(rows: DataFrame, ends: dict[str, DataFrame] | None = None) -> Iterator[DataFrame]:
    """A scratch copy of a batch, which several merges read, while the block runs.

    With ``ends`` only the edges whose end nodes exist (``with_ends``) stay in it; they are looked for in
    a first copy, as that reads the batch several times.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "batch")
    try:
        if ends:
            with _staged(rows) as all_rows:
                with_ends(all_rows, ends).write.parquet(path)
        else:
            rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove_path(spark, path)


def _upsert_buckets(m: _Merge, name: str, rows: DataFrame) -> None:
    numbers, base = m.touched(name, rows)
    if name in NODES:
        keys = TABLE_KEYS[name]
        m.replace(name, numbers, rows.unionByName(base.join(rows.select(*keys), keys, "left_anti")))
    else:
        m.replace(name, numbers, _both(base, rows), merge=True)


def _upsert_degrees(m: _Merge, rows: DataFrame) -> None:
    """Add what the batch changes: edges with new keys, and (person, product) pairs not seen before."""
    _, base = m.touched("purchase", rows)
    keys = TABLE_KEYS["purchase"]
    fresh = rows.join(base.select(*keys), keys, "left_anti").groupBy("person_id", "product_id").agg(F.count(F.lit(1)).alias("edges"))
    known = base.select("person_id", "product_id", F.lit(True).alias("known")).distinct()
    fresh = fresh.join(known, ["person_id", "product_id"], "left").withColumn("pair", F.col("known").isNull().cast("long"))
    with _staged(fresh.drop("known")) as fresh:
        for name, (key, edges, pairs) in (("person_degree", ("person_id", "n", "items")), ("product_degree", ("product_id", "edges", "buyers"))):
            delta = fresh.groupBy(key).agg(F.sum("edges").alias(edges), F.sum("pair").alias(pairs))
            numbers, old = m.touched(name, delta)
            both = old.unionByName(delta).groupBy(key).agg(F.sum(edges).alias(edges), F.sum(pairs).alias(pairs))
            m.replace(name, numbers, both)


def edge_ends_missing(g: Graph) -> DataFrame:
    """Integrity check: edges whose person/product/store node is absent -> (table, id)."""
    pid = g.person.select(F.col("id").alias("person_id"))
    prod = g.product.select(F.col("id").alias("product_id"))
    sid = g.store.select(F.col("id").alias("store_id"))
    a = g.purchase.join(pid, "person_id", "left_anti").select(F.lit("purchase").alias("table"), "id")
    b = g.purchase.join(prod, "product_id", "left_anti").select(F.lit("purchase").alias("table"), "id")
    c = g.visit.join(pid, "person_id", "left_anti").select(F.lit("visit").alias("table"), "id")
    d = g.visit.join(sid, "store_id", "left_anti").select(F.lit("visit").alias("table"), "id")
    return a.unionByName(b).unionByName(c).unionByName(d)
