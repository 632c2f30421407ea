"""JSON-lines sinks and sources for the nested node/edge frames.

Writes are plain ``df.write.json`` (one part file per task, overwrite).
Reads always declare the schema: inference would turn decimals into doubles,
timestamps into strings, and lose any field that was null on every row
(Spark's JSON writer omits null fields).  Malformed lines are kept apart in a
reject frame instead of failing the load; blank lines are skipped by the
reader.  Only ``*.json`` files of the directory are read; a missing
directory raises.
"""

from __future__ import annotations

import os
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posgraph.functions.columns import flatten, nest
from posgraph.schemas import NESTED
from posgraph.sources.store import in_parallel

CORRUPT = "_corrupt_record"
BROKEN = "broken"


def write_json(nested_df: DataFrame, path: str) -> str:
    nested_df.write.mode("overwrite").json(path)
    return path


def write_frames(flat_frames: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write flat stage-1 frames as nested JSON lines, ``{out_dir}/{name}.json``, as concurrent jobs."""
    def write(name: str, flat: DataFrame) -> str:
        return write_json(nest(flat, NESTED[name]), os.path.join(out_dir, f"{name}.json"))
    return dict(zip(flat_frames, in_parallel(*[partial(write, name, flat) for name, flat in flat_frames.items()])))


def _parsed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Every line that is not blank: the declared fields in ``r``, its file, its text and whether it is broken.

    The parse stands in a generator, so a filter on its result does not repeat it.
    """
    schema = T.StructType(NESTED[kind].fields + [T.StructField(CORRUPT, T.StringType(), True)])
    lines = (spark.read.option("pathGlobFilter", "*.json").text(path)
             .where(F.trim(F.col("value")) != ""))
    parsed = lines.select(
        F.explode(F.array(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})))
        .alias("r"), F.col("value"))
    is_bad = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    return parsed.select("r", F.input_file_name().alias("file"), "value", is_bad.alias(BROKEN))


def read_json_lines(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """(good nested rows, rejected raw lines) of one node/edge set.

    The files are scanned as text and parsed with ``from_json`` against the
    declared schema; a line that does not parse keeps its raw text in
    ``_corrupt_record`` and goes to the reject frame.  Both frames are lazy and
    each reads the files; ``stage_json_lines`` reads them once for both.
    """
    parsed = _parsed(spark, path, kind)
    good = parsed.where(~F.col(BROKEN)).select("r.*").drop(CORRUPT)
    return good, parsed.where(BROKEN).select("file", F.col("value").alias(CORRUPT))


def stage_json_lines(spark: SparkSession, path: str, kind: str, out: str) -> tuple[DataFrame, DataFrame]:
    """``read_json_lines`` with one read and one parse: a single job writes good
    rows and rejected lines to two partitions of a table at ``out``.

    Every frame and count made from it reads columns of that table, or only its
    footers.  Counts come from the files, not from accumulators or observed
    metrics, which count a task twice that a lost executor makes Spark repeat.
    """
    good = F.when(~F.col(BROKEN), F.col("r").dropFields(CORRUPT)).alias("r")
    raw = F.when(F.col(BROKEN), F.col("value")).alias(CORRUPT)
    rows = _parsed(spark, path, kind).select(good, "file", raw, BROKEN)
    rows.write.partitionBy(BROKEN).parquet(out)
    staged = spark.read.schema(rows.schema).parquet(out)
    return staged.where(~F.col(BROKEN)).select("r.*"), staged.where(BROKEN).select("file", CORRUPT)


def read_flat(spark: SparkSession, path: str, kind: str, staged: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Like ``read_json_lines`` (``stage_json_lines`` with ``staged``) but returns the flat (leaf-column) shape."""
    good, bad = stage_json_lines(spark, path, kind, staged) if staged else read_json_lines(spark, path, kind)
    return flatten(good, NESTED[kind]), bad
