"""Operator 9: exact deduplication with disk-backed streaming state (DataFrame operations only).

Texts are equal when they are identical after every run of ``[\\x20\\x09-\\x0D]``
becomes one space (null counts as empty).  Arrivals (digest, id, content
locator) flow through a Structured Streaming aggregation keyed by digest whose
state lives in RocksDB under the shared checkpoint folder and never expires:
per digest the smallest identifier with its locator, and the number of rows.
A later batch continues from the same state (``DedupState.ingest`` again).

A row whose digest is held by more than one row is a hit: its full normalised
text is compared with that of the row that stays, fetched through the locator.
Rows that differ in spite of an equal digest are grouped by their full text,
so a collision never drops a document.

Rows: one output row per input row.  A null ``doc_id`` sorts after every other
id: such a row stays only if its whole group has null ids (``keep_id`` null).
Of rows that repeat the same id and text, all carry the same ``keep_id`` and
one of them is kept (the one first by locator).  An empty table gives no rows;
extra columns are ignored by ``exact_dedup`` and carried through by
``keep_first``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posgraph.llm.common import drop_rows, may_contain, stored
from posgraph.session import scratch_path

ROWS_PER_SALT = 1000
ARRIVAL = "doc_id long, sha binary, loc struct<file:long,row:long>"
# State on disk; a partition's store is closed when its task ends, so an executor holds few at a time.
_STATE_CONF = {
    "stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "stateStore.unloadOnCommit": "true",
    "stateStore.rocksdb.boundedMemoryUsage": "true",
    "stateStore.rocksdb.maxMemoryUsageMB": "64",
    "stateStore.rocksdb.writeBufferSizeMB": "2",
    "stateStore.rocksdb.blockCacheSizeMB": "2",
    "minBatchesToRetain": "2",
}


def normalized(text: Column) -> Column:
    # A lone blank is already one space; every other run is replaced.
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


class DedupState:
    """Keyed deduplication state under one folder; ``ingest`` may be called for every new batch."""

    def __init__(self, spark: SparkSession, root: str, digest_bytes: int = 32):
        self.spark, self.root, self.digest_bytes = spark, root, digest_bytes
        self.session = spark.newSession()  # the state store settings stay out of the caller's session
        for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
            self.session.conf.set(key, spark.conf.get(key))
        for key, value in _STATE_CONF.items():
            self.session.conf.set(f"spark.sql.streaming.{key}", value)

    def ingest(self, arrivals: DataFrame) -> None:
        """Append ``arrivals`` (doc_id, sha, loc) and advance the state over them."""
        arrivals.write.mode("append").parquet(f"{self.root}/arrivals")
        stream = self.session.readStream.schema(ARRIVAL).parquet(f"{self.root}/arrivals")
        # nulls last: (1, null) is larger than (0, id)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "loc"))
        query = (stream.withColumn("digest", _digest(self.digest_bytes)).groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
                 .writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", f"{self.root}/state").trigger(availableNow=True).start())
        query.awaitTermination()

    def groups(self) -> DataFrame:
        """(digest, keep_id, keep_loc, n) as the state holds them."""
        s = self.spark.read.format("statestore").load(f"{self.root}/state")
        first, n = s.schema["value"].dataType.names
        v = F.col("value")
        return s.select(F.col("key").getField("digest").alias("digest"), v.getField(first).getField("doc_id").alias("keep_id"),
                        v.getField(first).getField("loc").alias("keep_loc"), v.getField(n).alias("n"))


def _digest(n: int) -> Column:
    return F.substring("sha", 1, n).alias("digest")


def located(docs: DataFrame) -> DataFrame:
    """(doc_id, text, loc, row) of every row; ``loc`` is its file and position, ``row`` all its columns.

    A frame that does not come straight from Parquet files is written to the
    scratch folder first, so that every row has a stable place.
    """
    def rows(df: DataFrame) -> DataFrame:
        place = df.metadataColumn("_metadata")
        loc = F.struct(F.xxhash64(place.getField("file_path")).alias("file"), place.getField("row_index").alias("row"))
        return df.select("doc_id", "text", loc.alias("loc"), F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))
    try:
        return rows(docs)
    except AnalysisException:
        return rows(stored(docs, "documents"))


def _loc_key(loc: str) -> Column:
    return F.xxhash64(F.col(f"{loc}.file"), F.col(f"{loc}.row"))


def decide(rows: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """loc, doc_id, keep_id, group_size, kept, sha for every row of ``located`` documents (stored)."""
    spark = rows.sparkSession
    sha = F.unhex(F.sha2(normalized(F.col("text")).cast("binary"), 256))
    state = DedupState(spark, scratch_path(spark, "llm-exact"), digest_bytes)
    state.ingest(rows.select("doc_id", sha.alias("sha"), "loc"))
    arrivals = spark.read.schema(ARRIVAL).parquet(f"{state.root}/arrivals")
    found = stored(arrivals.withColumn("digest", _digest(digest_bytes)).join(state.groups(), "digest"), "exact-found")

    # Hits only: fetch the texts through the locator and compare them byte by byte.
    hits = found.where("n > 1")
    texts = may_contain(rows.select("text", "loc"), _loc_key("loc"), hits.select(_loc_key("loc").alias("k")))
    texts = (texts.where("_may").select("loc", normalized(F.col("text")).cast("binary").alias("norm"))
             .join(hits, "loc"))
    texts = stored(texts, "exact-hits")
    # A group of n rows is spread over n / ROWS_PER_SALT salts; the text that stays is repeated for each.
    salts = F.ceil(F.col("n") / ROWS_PER_SALT).cast("int")
    keepers = texts.where("loc = keep_loc").select(
        "digest", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("norm").alias("keep_norm"))
    salted = texts.withColumn("salt", F.pmod(_loc_key("loc"), salts).cast("int"))
    same = F.col("norm") == F.col("keep_norm")
    compared = stored(salted.join(keepers, ["digest", "salt"]).withColumn("same", same).drop("keep_norm", "salt")
                      .withColumn("norm", F.when(~F.col("same"), F.col("norm"))), "exact-compared")
    other = compared.where("not same")  # equal digest, different text
    by_text = (other.groupBy("digest", "norm").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "loc")).alias("f"), F.count(F.lit(1)).alias("m")))
    less = other.groupBy("digest").agg(F.count(F.lit(1)).alias("less"))

    def shape(df: DataFrame, keep_id: str, keep_loc: str, size: str) -> DataFrame:
        return df.select("loc", "doc_id", F.expr(keep_id).alias("keep_id"), F.expr(size).alias("group_size"),
                         F.expr(f"loc = {keep_loc}").alias("kept"), "sha")
    out = (shape(found.where("n = 1"), "keep_id", "keep_loc", "n")
           .unionAll(shape(compared.where("same").join(less, "digest", "left"), "keep_id", "keep_loc",
                           "n - coalesce(less, 0)"))
           .unionAll(shape(other.join(by_text, ["digest", "norm"]), "f.doc_id", "f.loc", "m")))
    return stored(out, "exact-decided")


def exact_dedup(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    return decide(located(docs), digest_bytes).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = located(docs)
    dropped = decide(rows).where("not kept").select("loc")
    return drop_rows(rows, ["loc"], dropped, _loc_key("loc")).select("row.*")
