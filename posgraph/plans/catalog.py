"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the POS adapter, so its work
grows with the data.  Parameters of the single-target queries are fixed here
(the same literals the SQL oracle uses).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posgraph.operators import edges, graph, lookups, nodes, recommend, reports, similarity
from posgraph.plans import pipeline
from posgraph.plans.fixture import stored_graph
from posgraph.session import scratch_path, shuffles_dropped
from posgraph.sources import jsonl, store
from posgraph.sources import pos as pos_src
from posgraph.sources.tpch import pos_from_tpch

# Fixed parameters shared with the SQL oracle.
DAY_RANGE_START = "19970630"
DAY_RANGE_PERIODS = 30
TARGET_PERSON = "0000000005"
TARGET_PRODUCT = "0000000000042"
DATE_FROM = "1996-01-01"
DATE_TO = "1999-12-31"


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines of all five companies (no company filter)."""
    return pos_src.sales_rows(pos_from_tpch(spark, sf_dir))


def q_pos_sales(spark, sf_dir):
    return sales(spark, sf_dir)


def q_pos_day_range(spark, sf_dir):
    return pos_src.in_day_range(sales(spark, sf_dir), DAY_RANGE_START, DAY_RANGE_PERIODS)


DAY_COLS = ["CUSTOMER_ID", "ITEM_CD_UNIQUE", "SHOP_CD", "SALES_YMD", "SALES_AMT", "RECEIPT_NO", "SALES_DETAIL_NO"]
COMPANY = "3"


def _day_directories(spark, sf_dir) -> str:
    """All POS lines of the window (returns and foreign lines too) in one directory a day."""
    base = scratch_path(spark, "days")
    lines = pos_src.in_day_range(pos_from_tpch(spark, sf_dir), DAY_RANGE_START, DAY_RANGE_PERIODS)
    lines.repartition("SALES_YMD").write.partitionBy("SALES_YMD").parquet(base)
    return base


def q_pos_days_read(spark, sf_dir):
    """Day directories scanned by glob, some columns (a day without sales has no directory)."""
    return pos_src.read_pos_days(spark, _day_directories(spark, sf_dir), DAY_RANGE_START, DAY_RANGE_PERIODS,
                                 cols=DAY_COLS, dir_prefix="SALES_YMD=", skip_missing=True)


def q_pos_days_types(spark, sf_dir):
    """The same window from day directories where some files of a day store the amount as text."""
    base = scratch_path(spark, "days")
    lines = pos_src.in_day_range(pos_from_tpch(spark, sf_dir), DAY_RANGE_START, DAY_RANGE_PERIODS)
    as_text = F.crc32(F.col("RECEIPT_NO").cast("binary")) % 2 == 0
    drifted = lines.where(as_text).withColumn("SALES_AMT", F.col("SALES_AMT").cast("string"))
    for part in (lines.where(~as_text), drifted):
        part.repartition("SALES_YMD").write.mode("append").partitionBy("SALES_YMD").parquet(base)
    return pos_src.read_pos_days(spark, base, DAY_RANGE_START, DAY_RANGE_PERIODS,
                                 cols=DAY_COLS, dir_prefix="SALES_YMD=", skip_missing=True)


def q_pos_company(spark, sf_dir):
    """Day directories scanned by glob, one company, all columns."""
    return pos_src.read_pos_days(spark, _day_directories(spark, sf_dir), DAY_RANGE_START, DAY_RANGE_PERIODS,
                                 comp_cd=COMPANY, dir_prefix="SALES_YMD=", skip_missing=True)


def q_persons(spark, sf_dir):
    return nodes.persons(sales(spark, sf_dir))


def q_products(spark, sf_dir):
    return nodes.products(sales(spark, sf_dir))


def q_stores(spark, sf_dir):
    return nodes.stores(sales(spark, sf_dir))


def q_purchases_receipt(spark, sf_dir):
    return edges.purchases(sales(spark, sf_dir), "receipt")


def q_purchases_line(spark, sf_dir):
    return edges.purchases(sales(spark, sf_dir), "line")


def q_visits_store_day(spark, sf_dir):
    return edges.visits(sales(spark, sf_dir), "store_day")


def q_visits_receipt(spark, sf_dir):
    return edges.visits(sales(spark, sf_dir), "receipt")


def q_top_products(spark, sf_dir):
    return reports.top_products(edges.purchases(sales(spark, sf_dir), "receipt"))


def q_payment_mix(spark, sf_dir):
    return reports.payment_mix(edges.purchases(sales(spark, sf_dir), "receipt"))


def q_top_stores(spark, sf_dir):
    return reports.top_stores(edges.visits(sales(spark, sf_dir), "store_day"))


# ---------------------------------------------------------------- stage 2

def _graph_from_pos(spark, sf_dir):
    g, _ = pipeline.graph_from_pos(sales(spark, sf_dir), "line")
    return g


def q_person_props(spark, sf_dir):
    return _graph_from_pos(spark, sf_dir).person


def q_product_props(spark, sf_dir):
    return _graph_from_pos(spark, sf_dir).product


def q_store_props(spark, sf_dir):
    return _graph_from_pos(spark, sf_dir).store


def q_purchase_edges(spark, sf_dir):
    return _graph_from_pos(spark, sf_dir).purchase


def q_visit_edges(spark, sf_dir):
    return _graph_from_pos(spark, sf_dir).visit


def q_graph_counts(spark, sf_dir):
    return graph.graph_counts(stored_graph(spark, sf_dir))


def q_unique_violations(spark, sf_dir):
    """Node tables in which the ids that end in 7 (stores: in 1) come twice."""
    g = stored_graph(spark, sf_dir)

    def doubled(df, digit):
        return df.unionByName(df.where(F.col("id").endswith(digit)))
    return graph.unique_violations(graph.Graph(doubled(g.person, "7"), doubled(g.product, "7"), doubled(g.store, "1"),
                                               g.purchase, g.visit))


def q_load_twice(spark, sf_dir):
    """A second load into one root replaces the tables and the indexes made from them."""
    root = scratch_path(spark, "twice")
    with pipeline.staged_lines(sales(spark, sf_dir)) as lines:
        early, _ = _split_days(lines)
        pipeline.materialize_graph(lines, root)
        pipeline.materialize_graph(early, root)
    g = store.read_graph(spark, root)
    by_product = (g.purchases_of_products().groupBy("product_id")
                  .agg(F.count(F.lit(1)).alias("copied"), F.sum("amount").cast("decimal(28,2)").alias("amount")))
    return g.product_edge_stats().join(by_product, "product_id", "full")


def _stage1_files(spark, sf_dir):
    """Run stage 1 into fresh JSON directories; return (node_dir, relation_dir)."""
    root = scratch_path(spark, "json")
    node_dir, rel_dir = f"{root}/node", f"{root}/relation"
    pipeline.pos_to_files(sales(spark, sf_dir), node_dir, rel_dir)
    return node_dir, rel_dir


def q_json_roundtrip(spark, sf_dir):
    """Stage-1 frames written as JSON lines and read back: a digest of every row's values."""
    node_dir, rel_dir = _stage1_files(spark, sf_dir)
    parts = []
    for kind, d in (("persons", node_dir), ("products", node_dir), ("stores", node_dir),
                    ("purchases", rel_dir), ("visits", rel_dir)):
        good, _ = jsonl.read_flat(spark, f"{d}/{kind}.json", kind)
        values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(good.columns)]
        parts.append(good.select(F.lit(kind).alias("name"), "id", F.md5(F.concat_ws("|", *values)).alias("digest")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_json_lines_load(spark, sf_dir):
    """The file-based chain end to end: stage-1 JSON lines -> purchase table."""
    node_dir, rel_dir = _stage1_files(spark, sf_dir)
    g, _ = pipeline.graph_from_files(spark, node_dir, rel_dir)
    return g.purchase


UPSERT_BASE_BEFORE = 19980101
UPSERT_UPDATE_FROM = 19970101


def _split_days(s):
    return (s.where(F.col("SALES_YMD") < UPSERT_BASE_BEFORE),
            s.where(F.col("SALES_YMD") >= UPSERT_UPDATE_FROM))


def q_upsert_nodes(spark, sf_dir):
    """Products: base table from the early days, upserted with a later batch."""
    early, late = _split_days(sales(spark, sf_dir))
    base, _ = graph.product_props(nodes.products(early))
    updates, _ = graph.product_props(nodes.products(late))
    updates = updates.withColumn("name", F.concat("name", F.lit(" v2")))  # so that an update shows
    root = scratch_path(spark, "upsert")
    store.write_table(base, f"{root}/v1/product", "product")
    return store.upsert_table(spark, f"{root}/v1", f"{root}/v2", "product", updates)


def q_upsert_edges(spark, sf_dir):
    """Purchase edges: base from the early days, upserted with a later batch."""
    root = scratch_path(spark, "upsert")
    with pipeline.staged_lines(sales(spark, sf_dir)) as lines, shuffles_dropped(spark):
        early, late = _split_days(lines)
        g_base, _ = pipeline.graph_from_pos(early, "line", merge=False)  # merged where they are written
        g_all, _ = pipeline.graph_from_pos(lines, "line")
        updates, _ = graph.purchase_edges(edges.purchase_lines(late, "line"), g_all.person, g_all.product, merge=False)
        updates = updates.withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))  # so that an update shows
        store.write_table(g_base.purchase, f"{root}/v1/purchase", "purchase", merge=True)
        return store.upsert_table(spark, f"{root}/v1", f"{root}/v2", "purchase", updates)


def q_upsert_graph(spark, sf_dir):
    """The graph of the early days with the later batch merged in, as its queries see it.

    Edges and buyers come from the degree index, copies and amounts from the reverse
    copy, the rest from the edge table itself.
    """
    root = scratch_path(spark, "upsert-graph")
    with pipeline.staged_lines(sales(spark, sf_dir)) as lines:
        early, late = _split_days(lines)
        pipeline.materialize_graph(early, root)
        batch, _ = pipeline.stored_nodes(nodes.persons(late), nodes.products(late), nodes.stores(late), f"{root}-late")
        person, product = batch["person"], batch["product"]
        everyone = store.read_graph(spark, root)
        rows, _ = graph.purchase_edges(edges.purchase_lines(late, "line"), everyone.person.unionByName(person),
                                       everyone.product.unionByName(product), merge=False)  # the upsert merges them
        rows = rows.withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))  # so that an update shows
        g = store.upsert_graph(spark, root, {"person": person, "product": product, "purchase": rows})
    copied = g.purchases_of_products().groupBy("product_id").agg(
        F.count(F.lit(1)).alias("copied"), F.sum("amount").cast("decimal(28,2)").alias("amount"))
    own = g.purchase.join(g.person_degree.select("person_id", "n", "items"), "person_id").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("buyer_edges"), F.sum("items").alias("buyer_items"))
    return (g.product.select(F.col("id").alias("product_id"), "name").join(g.product_degree, "product_id")
            .join(copied, "product_id").join(own, "product_id"))


# ---------------------------------------------------------------- stage 3

def q_person_purchases(spark, sf_dir):
    return lookups.person_purchases(stored_graph(spark, sf_dir), TARGET_PERSON, 10, DATE_FROM, DATE_TO)


def q_person_purchases_all(spark, sf_dir):
    return lookups.person_purchases_all(stored_graph(spark, sf_dir), 10)


def q_product_purchasers(spark, sf_dir):
    return lookups.product_purchasers(stored_graph(spark, sf_dir), TARGET_PRODUCT, 10, DATE_FROM, DATE_TO)


def q_product_purchasers_all(spark, sf_dir):
    return lookups.product_purchasers_all(stored_graph(spark, sf_dir), 10)


def _joined_categories(df):
    return df.withColumn("categories", F.array_join("categories", "|"))


def _round_avg(df):
    return df.withColumn("avg_amount", F.round("avg_amount", 6))


def q_person_statistics(spark, sf_dir):
    return _round_avg(_joined_categories(lookups.person_statistics(stored_graph(spark, sf_dir), TARGET_PERSON)))


def q_product_statistics(spark, sf_dir):
    return _round_avg(lookups.product_statistics(stored_graph(spark, sf_dir), TARGET_PRODUCT))


def q_person_statistics_all(spark, sf_dir):
    return _round_avg(_joined_categories(lookups.person_statistics_all(stored_graph(spark, sf_dir))))


def q_product_statistics_all(spark, sf_dir):
    return _round_avg(lookups.product_statistics_all(stored_graph(spark, sf_dir)))


def q_related_products(spark, sf_dir):
    return recommend.related_products(stored_graph(spark, sf_dir), TARGET_PRODUCT, 5)


def _round(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def q_user_recommendations(spark, sf_dir):
    out = recommend.user_recommendations(stored_graph(spark, sf_dir), TARGET_PERSON, 10, 0.0)
    return _round(out, "recommendation_score", "similarity")


def q_user_recommendations_similar(spark, sf_dir):
    """Only persons with a similarity above 0."""
    out = recommend.user_recommendations(stored_graph(spark, sf_dir), TARGET_PERSON, 10, 0.01)
    return _round(out, "recommendation_score", "similarity")


def q_item_recommendations(spark, sf_dir):
    out = recommend.item_recommendations(stored_graph(spark, sf_dir), TARGET_PERSON, 10, 0.02, 10)
    return _round(out, "recommendation_score")


def q_association_rules(spark, sf_dir):
    return _round(recommend.association_rules(stored_graph(spark, sf_dir), 0.001, 0.1, 10), "support", "confidence", "lift")


def q_association_rules_all(spark, sf_dir):
    """Every rule passing the default thresholds (no top-k)."""
    rules = recommend.association_rules(stored_graph(spark, sf_dir), 0.001, 0.1, None).drop("rank")
    return _round(rules, "support", "confidence", "lift")


# Searches for every id divisible by 50, against all rows.
SIMILAR_AT, USER_CF_AT, ITEM_CF_AT = 0.05, 0.03, 0.02


def _targets(nodes_table: DataFrame) -> DataFrame:
    return nodes_table.where(F.col("id").try_cast("bigint") % 50 == 0).select("id")


def q_similar_persons_batch(spark, sf_dir):
    g = stored_graph(spark, sf_dir)
    return _round(similarity.similar_persons(g, _targets(g.person), SIMILAR_AT), "similarity")


def q_user_recommendations_batch(spark, sf_dir):
    g = stored_graph(spark, sf_dir)
    out = recommend.user_recommendations_batch(g, _targets(g.person), 10, USER_CF_AT)
    return _round(out, "recommendation_score", "similarity")


def q_item_recommendations_batch(spark, sf_dir):
    """From a stored index of the history items."""
    g = stored_graph(spark, sf_dir)
    items = recommend.target_history(g, _targets(g.person)).select("h")
    index = store.write_item_index(g, items, scratch_path(spark, "item-paths"))
    return _round(recommend.item_recommendations_batch(g, _targets(g.person), 10, ITEM_CF_AT, index=index), "recommendation_score")


def q_related_products_batch(spark, sf_dir):
    g = stored_graph(spark, sf_dir)
    return recommend.related_products_batch(g, _targets(g.product), 5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pos_sales": q_pos_sales,
    "pos_day_range": q_pos_day_range,
    "pos_days_read": q_pos_days_read,
    "pos_days_types": q_pos_days_types,
    "pos_company": q_pos_company,
    "persons": q_persons,
    "products": q_products,
    "stores": q_stores,
    "purchases_receipt": q_purchases_receipt,
    "purchases_line": q_purchases_line,
    "visits_store_day": q_visits_store_day,
    "visits_receipt": q_visits_receipt,
    "top_products": q_top_products,
    "payment_mix": q_payment_mix,
    "top_stores": q_top_stores,
    "person_props": q_person_props,
    "product_props": q_product_props,
    "store_props": q_store_props,
    "purchase_edges": q_purchase_edges,
    "visit_edges": q_visit_edges,
    "graph_counts": q_graph_counts,
    "unique_violations": q_unique_violations,
    "load_twice": q_load_twice,
    "json_roundtrip": q_json_roundtrip,
    "json_lines_load": q_json_lines_load,
    "upsert_nodes": q_upsert_nodes,
    "upsert_edges": q_upsert_edges,
    "upsert_graph": q_upsert_graph,
    "person_purchases": q_person_purchases,
    "person_purchases_all": q_person_purchases_all,
    "product_purchasers": q_product_purchasers,
    "product_purchasers_all": q_product_purchasers_all,
    "person_statistics": q_person_statistics,
    "product_statistics": q_product_statistics,
    "person_statistics_all": q_person_statistics_all,
    "product_statistics_all": q_product_statistics_all,
    "related_products": q_related_products,
    "user_recommendations": q_user_recommendations,
    "user_recommendations_similar": q_user_recommendations_similar,
    "item_recommendations": q_item_recommendations,
    "similar_persons_batch": q_similar_persons_batch,
    "user_recommendations_batch": q_user_recommendations_batch,
    "item_recommendations_batch": q_item_recommendations_batch,
    "related_products_batch": q_related_products_batch,
    "association_rules": q_association_rules,
    "association_rules_all": q_association_rules_all,
}
FLAGSHIP = "top_products"
