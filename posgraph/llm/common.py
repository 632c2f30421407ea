"""Helpers shared by the operators: table reads, scratch tables, sampling, id filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posgraph.session import scratch_path

FILTER_BITS = 1 << 24  # an id bitmap is 2 MB, whatever the input


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer's file (installed with the library, never copied)."""
    import public_tokenizers
    return public_tokenizers.path(name)


# Rows and bytes that go to a Python worker at once while a table is stored.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written under the shared scratch folder and read back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = {k: spark.conf.get(k, None) for k in _BATCH}
    try:
        for k, v in _BATCH.items():
            spark.conf.set(k, v)
        df.write.option("compression", compression).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def rows_of(spark: SparkSession, values: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed table as a literal (no Python rows are shipped)."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in values]
    return spark.range(1).select(F.inline(F.array(*structs)))


def id_mod(col: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (null for a null id)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows of ``df``, those with the smallest hash of ``key``."""
    return df.orderBy(F.xxhash64(key), F.col(key)).limit(n)


def _bitmaps(positions: DataFrame) -> DataFrame:
    """(_bucket, _bits): bitmaps of 4 kB over the positive longs in ``p``.

    Positions are dealt out by bucket before they are gathered, so the shuffle
    carries positions, not a set of bitmaps from every task.
    """
    once = positions.select("p").distinct()  # an id on many rows counts once
    return (once.select("p", F.bitmap_bucket_number("p").alias("_bucket")).repartition("_bucket")
            .groupBy("_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits")))


def bitmap(df: DataFrame, col: str, bits: int = FILTER_BITS) -> np.ndarray:
    """Packed bits with bit ``value mod bits`` set for every value of a long column."""
    maps = _bitmaps(df.select((F.pmod(F.col(col), F.lit(bits)) + 1).alias("p")))
    size = 4096  # bytes of one bitmap: at most bits / 8 / 4096 of them reach the driver
    out = np.zeros(bits // 8, np.uint8)
    for r in maps.collect():
        out[(r["_bucket"] - 1) * size:r["_bucket"] * size] = np.frombuffer(r["_bits"], np.uint8)
    return out


def may_contain(df: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """``df`` with ``_may``: false only where ``key`` (long) surely is not in ``ids`` (one long column).

    A bitmap of fixed size (``FILTER_BITS``, 2 MB) built by Spark's bitmap
    aggregates and broadcast in 4 kB pieces.  It never misses an id; false
    positives grow with the set, so callers still join on the exact ids.  It
    only keeps most other rows, with their texts, out of that join's shuffle.
    """
    def slot(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1
    maps = _bitmaps(ids.select(slot(F.col(ids.columns[0])).alias("p")))
    at = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_slot) div 8 as int) + 1, 1)")), 16, 10)
    bit = F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1
    return (df.withColumn("_slot", F.coalesce(slot(key), F.lit(1)))
            .withColumn("_bucket", F.bitmap_bucket_number("_slot"))
            .join(F.broadcast(maps), "_bucket", "left")  # at most FILTER_BITS / 8 bytes
            .withColumn("_may", F.coalesce(bit, F.lit(False))).drop("_bits", "_slot", "_bucket"))


def drop_rows(df: DataFrame, cols: list[str], ids: DataFrame, key: Column) -> DataFrame:
    """The rows of ``df`` whose ``cols`` are not in ``ids``; nulls stay.  ``key`` is a long made of ``cols``.

    Rows that the bitmap rules out pass through without a shuffle; only the
    rest meets the exact ids in an anti join.
    """
    marked = may_contain(df, key, ids.select(key.alias("k")))
    rest = marked.where("_may").join(ids.select(*cols).distinct(), cols, "left_anti")
    return marked.where("not _may").unionAll(rest.select(marked.columns)).drop("_may")


def drop_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``doc_id`` is not in ``ids``."""
    rows = docs.select("doc_id", F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    return drop_rows(rows, ["doc_id"], ids, F.col("doc_id")).select("_row.*")
