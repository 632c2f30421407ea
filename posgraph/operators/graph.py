"""Stage 2: node/edge frames -> five flat graph tables.

P10-P14  flatten with defaults (a missing value becomes '' / 0 / '0' / false)
J2, J3   edges keep only rows whose end nodes exist (``with_ends``, left semi joins; the
         purchase's store is not checked, the visit's store is)
S7/S8    one row per node id / edge merge key (D1 total order)
B15      rows missing a required field are returned as rejects, not loaded
S10      uniqueness check, A13 counts

Inputs are the flat frames of stage 1 (``operators.nodes`` / ``operators.edges``)
or the same shapes read back from JSON lines (``sources.jsonl``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posgraph.functions.columns import parse_compact_datetime
from posgraph.operators.bitmaps import likely_in, surely_not_in
from posgraph.operators.dedupe import keep_one
from posgraph.schemas import TABLE_KEYS, TABLES

NODE_LABELS = {"person": "Person nodes", "product": "Product nodes", "store": "Store nodes",
               "purchase": "Purchase relationships", "visit": "Visit relationships"}


def _d(c: str, default) -> Column:
    return F.coalesce(F.col(c), F.lit(default))


def _dec0(c: str, dtype: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0).cast(dtype))


def _split(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    ok = None
    for c in required:
        cond = F.col(c).isNotNull()
        ok = cond if ok is None else ok & cond
    return df.where(ok), df.where(~ok)


def person_props(persons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(person table, rejects): id required; gender -> '0', other text -> ''."""
    good, bad = _split(persons, ["id"])
    flat = good.select(
        "id",
        _d("gender", "0").alias("gender"),
        _d("birth_date", "").alias("birth_date"),
        _d("location_prefecture", "").alias("prefecture"),
        _d("location_zip_code", "").alias("zip_code"),
        _d("location_coordinates_latitude", "").alias("latitude"),
        _d("location_coordinates_longitude", "").alias("longitude"),
        _d("membership_member_id", "").alias("member_id"),
        _d("membership_status", "").alias("status"),
    )
    return keep_one(flat, ["id"]), bad


def product_props(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(product table, rejects): text -> '', price = master price or 0, tax rate -> 0."""
    good, bad = _split(products, ["id"])
    flat = good.select(
        "id",
        *[_d(src, "").alias(dst) for src, dst in (
            ("name", "name"), ("name_kana", "name_kana"),
            ("categories_major_category", "major_category"),
            ("categories_medium_category", "medium_category"),
            ("categories_minor_category", "minor_category"),
            ("categories_group_code", "group_code"), ("categories_group_name", "group_name"),
            ("categories_department_code", "department_code"),
            ("categories_department_name", "department_name"))],
        _dec0("pricing_master_price", "decimal(14,2)").alias("price"),
        _d("pricing_tax_rate", 0).cast("int").alias("tax_rate"),
    )
    return keep_one(flat, ["id"]), bad


def store_props(stores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(store table, rejects): id required, company id kept as is."""
    good, bad = _split(stores, ["id"])
    return keep_one(good.select("id", "company_id"), ["id"]), bad


def _merged(flat: DataFrame, name: str) -> DataFrame:
    """One row per merge key.  The keys are as fine as the lines, so rows are not sorted to trim them before their shuffle."""
    return keep_one(flat.repartition(*TABLE_KEYS[name]), TABLE_KEYS[name])


def with_ends(edges: DataFrame, ends: dict[str, DataFrame]) -> DataFrame:
    """The edges whose end nodes exist (key column of the edges -> node table).

    Nearly all do, so the edges are not shuffled to find out: only their distinct keys meet the node
    ids, and bitmaps of fixed size part off the edges whose keys may be without a node.  Those
    few go through exact semi joins; where every key has its node AQE drops their branches.  The node ids are not
    to be broadcast: planned from their compressed files, millions of them look small.
    """
    ids = {key: nodes.select(F.col("id").alias(key)).hint("merge") for key, nodes in ends.items()}
    parted, rest = [], edges
    for key in ends:
        dangling = edges.select(key).distinct().join(ids[key], key, "left_anti")
        parted.append(likely_in(rest, key, dangling))
        rest = surely_not_in(rest, key, dangling)
    # The keys come out of a generator: else Spark moves the semi joins below the bitmaps, where they meet all edges.
    doubtful = reduce(DataFrame.unionByName, parted).withColumn("_keys", F.explode(F.array(F.struct(*ends))))
    doubtful = doubtful.withColumns({key: F.col(f"_keys.{key}") for key in ends}).select(*edges.columns)
    for key in ends:
        doubtful = doubtful.join(ids[key], key, "left_semi")
    return rest.unionByName(doubtful)


def purchase_edges(purchases: DataFrame, person: DataFrame, product: DataFrame, merge: bool = True
                   ) -> tuple[DataFrame, DataFrame]:
    """(purchase table, rejects).  Required: id, person, product, store, datetime.

    Without ``merge`` a merge key may have several rows: for writers that merge
    in the shuffle which orders the table (``sources.store.write_table``).
    """
    good, bad = _split(purchases, ["id", "person_id", "product_id",
                                   "purchase_details_store_id", "datetime"])
    flat = good.select(
        "person_id", "product_id", "id",
        F.col("purchase_details_store_id").alias("store_id"),
        "datetime",
        _dec0("purchase_details_quantity", "decimal(18,3)").alias("quantity"),
        _dec0("purchase_details_amount", "decimal(18,2)").alias("amount"),
        _dec0("purchase_details_amount_without_tax", "decimal(18,2)").alias("amount_without_tax"),
        _d("purchase_details_payment_method", "").alias("payment_method"),
        _d("purchase_details_payment_type", "").alias("payment_type"),
        _dec0("discount_info_discount_amount", "decimal(18,2)").alias("discount_amount"),
        _dec0("discount_info_price_down_amount", "decimal(18,2)").alias("price_down_amount"),
        _d("discount_info_discount_type1", "").alias("discount_type1"),
        _d("discount_info_discount_type2", "").alias("discount_type2"),
        _d("discount_info_discount_type3", "").alias("discount_type3"),
    )
    flat = with_ends(flat, {"person_id": person, "product_id": product})
    return _merged(flat, "purchase") if merge else flat, bad


def visit_edges(visits: DataFrame, person: DataFrame, store: DataFrame, merge: bool = True
                ) -> tuple[DataFrame, DataFrame]:
    """(visit table, rejects).  Required: id, person, store, datetime; datetime parsed (UTC)."""
    good, bad = _split(visits, ["id", "person_id", "store_id", "datetime"])
    flat = good.select(
        "person_id", "store_id", "id",
        parse_compact_datetime("datetime").alias("datetime"),
        _d("visit_details_company_id", "").alias("company_id"),
        _d("visit_details_register_no", "").alias("register_no"),
        _d("visit_details_conversion_converted", False).alias("is_converted"),
        _d("visit_details_conversion_purchase_id", "").alias("purchase_id"),
    )
    # Visits are few beside the lines; the person ids are not to be broadcast (``with_ends``).
    flat = (flat.join(person.select(F.col("id").alias("person_id")).hint("merge"), "person_id", "left_semi")
                .join(store.select(F.col("id").alias("store_id")), "store_id", "left_semi"))
    return _merged(flat, "visit") if merge else flat, bad


@dataclass
class Graph:
    person: DataFrame
    product: DataFrame
    store: DataFrame
    purchase: DataFrame
    visit: DataFrame
    # Optional copy of ``purchase`` clustered by product (the reverse
    # adjacency); product-filtered reads use it when present.
    purchase_by_product: DataFrame | None = None
    # Optional degree index written by the graph build:
    # person_degree (person_id, n, items) and product_degree (product_id, edges, buyers).
    person_degree: DataFrame | None = None
    product_degree: DataFrame | None = None

    def person_edge_counts(self) -> DataFrame:
        """(person_id, n): purchase edges per person (stored index or computed)."""
        if self.person_degree is not None:
            return self.person_degree.select("person_id", "n")
        return self.purchase.groupBy("person_id").agg(F.count(F.lit(1)).alias("n"))

    def person_item_counts(self) -> DataFrame:
        """(person_id, items): distinct products per person (stored index or computed)."""
        index = self.person_degree if self.person_degree is not None else person_degree(self.purchase)
        return index.select("person_id", "items")

    def product_edge_stats(self) -> DataFrame:
        """(product_id, edges, buyers): purchase edges and distinct buyers per product."""
        if self.product_degree is not None:
            return self.product_degree
        return product_degree(self.purchase)

    def purchases_of_products(self) -> DataFrame:
        """Purchase edges for reads filtered by product id."""
        return self.purchase_by_product if self.purchase_by_product is not None else self.purchase

    def tables(self) -> dict[str, DataFrame]:
        return {"person": self.person, "product": self.product, "store": self.store,
                "purchase": self.purchase, "visit": self.visit}


def person_degree(purchase: DataFrame) -> DataFrame:
    """Edges and distinct products per person."""
    m = purchase.groupBy("person_id", "product_id").agg(F.count(F.lit(1)).alias("m"))
    return m.groupBy("person_id").agg(F.sum("m").alias("n"), F.count(F.lit(1)).alias("items"))


def product_degree(purchase: DataFrame) -> DataFrame:
    """Edges and distinct buyers per product: two aggregation levels, both
    combined map-side (a hot product never gathers its buyers in one buffer)."""
    m = purchase.groupBy("person_id", "product_id").agg(F.count(F.lit(1)).alias("m"))
    return m.groupBy("product_id").agg(F.sum("m").alias("edges"), F.count(F.lit(1)).alias("buyers"))


def graph_counts(g: Graph) -> DataFrame:
    """(name, count) for the five tables, one small job per count."""
    parts = [df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(NODE_LABELS[n]).alias("name"), "count")
             for n, df in g.tables().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_violations(g: Graph) -> DataFrame:
    """Ids appearing more than once in a node table -> (label, id, count)."""
    parts = []
    for name in ("person", "product", "store"):
        parts.append(g.tables()[name].groupBy("id").agg(F.count(F.lit(1)).alias("count"))
                     .where(F.col("count") > 1)
                     .select(F.lit(name).alias("label"), "id", "count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def conform_table(df: DataFrame, name: str, *more: str) -> DataFrame:
    """Select a graph table's declared columns in declared order and types (and the columns ``more``)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields] + list(more))
