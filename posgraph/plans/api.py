"""Call shapes of the original pipeline and query functions, over DataFrames.

``PurchaseGraphQueries`` answers the seven graph questions with the original
argument names and defaults; every method returns a lazy DataFrame (the
caller collects or writes it; building it runs no job).  ``transform_pos`` and ``import_graph`` are the
two pipeline entry points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posgraph.operators import lookups, recommend
from posgraph.operators.graph import Graph, graph_counts
from posgraph.plans import pipeline
from posgraph.sources import store


class PurchaseGraphQueries:
    def __init__(self, graph: Graph):
        self.graph = graph

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> "PurchaseGraphQueries":
        return cls(store.read_graph(spark, root))

    def get_person_purchases(self, person_id: str, limit: int = 10, start_date: str | None = None,
                             end_date: str | None = None) -> DataFrame:
        return lookups.person_purchases(self.graph, person_id, limit, start_date, end_date)

    def get_product_purchasers(self, product_id: str, limit: int = 10, start_date: str | None = None,
                               end_date: str | None = None) -> DataFrame:
        return lookups.product_purchasers(self.graph, product_id, limit, start_date, end_date)

    def get_purchase_statistics(self, entity_id: str, entity_type: str = "person") -> DataFrame:
        if entity_type == "person":
            return lookups.person_statistics(self.graph, entity_id)
        if entity_type == "product":
            return lookups.product_statistics(self.graph, entity_id)
        raise ValueError(f"entity_type must be 'person' or 'product', not {entity_type!r}")

    def get_related_products(self, product_id: str, limit: int = 5) -> DataFrame:
        return recommend.related_products(self.graph, product_id, limit)

    def get_user_based_recommendations(self, person_id: str, limit: int = 10,
                                       similarity_threshold: float = 0) -> DataFrame:
        return recommend.user_recommendations(self.graph, person_id, limit, similarity_threshold)

    def get_item_based_recommendations(self, person_id: str, limit: int = 10,
                                       similarity_threshold: float = 0.1,
                                       max_history_items: int = 10) -> DataFrame:
        return recommend.item_recommendations(self.graph, person_id, limit, similarity_threshold,
                                              max_history_items)

    def get_association_rules(self, min_support: float = 0.001, min_confidence: float = 0.1,
                              limit: int = 10) -> DataFrame:
        return recommend.association_rules(self.graph, min_support, min_confidence, limit)


def transform_pos(pos: DataFrame, node_dir: str, relation_dir: str) -> dict[str, DataFrame]:
    """POS lines -> node and relation JSON lines; returns the three reports (lazy)."""
    return pipeline.pos_to_files(pos, node_dir, relation_dir)


def import_graph(spark: SparkSession, node_dir: str, relation_dir: str, root: str
                 ) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Node and relation JSON lines -> graph tables under ``root`` (replaced).

    Returns the five counts (name, count) of the written tables and the
    rejects (malformed lines, rows missing a required field), which
    ``reject_counts`` counts.  The load reads the files once and stores both, so
    tables and rejects are counted from their footers, without another scan.
    """
    rejects = pipeline.load_files(spark, node_dir, relation_dir, root)
    return graph_counts(store.read_graph(spark, root)), rejects


def reject_counts(rejects: dict[str, DataFrame]) -> DataFrame:
    """(name, count) of the rows and lines that a load left out."""
    parts = [df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("name"), "count")
             for name, df in rejects.items()]
    return reduce(DataFrame.unionByName, parts)
