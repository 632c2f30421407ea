"""POS detail scans: day selection, column conformance, sales-row filter.

Two layouts are supported for day selection:

* one directory per day whose name starts with ``yyyymmdd`` (the layout the
  pipeline was written against): ``day_paths`` lists the globs and
  ``read_pos_days`` scans only those directories;
* a table partitioned by ``SALES_YMD`` (or any table with that column):
  ``in_day_range`` is a plain predicate, which Catalyst turns into partition
  pruning and parquet row-group skipping.

Files are grouped by the schema in their footers (``schema_groups``) and each
distinct schema is one scan, so ten years of days plan like one day, and a
column whose type changes, also inside one day, is converted to its declared type.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Collection, Iterator, Sequence
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posgraph.functions.dates import day_bounds, day_list
from posgraph.schemas import POS_SCHEMA
from posgraph.session import matching_paths

FILTER_COLUMNS = ("SALES_SIGN", "COUNTRY_CD", "COMPANY_CD_UNIQUE")
REQUIRED = {*FILTER_COLUMNS, "CUSTOMER_ID", "ITEM_CD_UNIQUE", "SHOP_CD", "SALES_YMD", "SALES_HMS", "REGISTER_NO",
            "RECEIPT_NO", "SALES_DETAIL_NO"}


def day_paths(base: str, campaign_start_date: str, periods: int = 1,
              dir_prefix: str = "") -> list[str]:
    """Globs for ``periods`` days ending on the start date (inclusive)."""
    base = base.rstrip("/")
    return [f"{base}/{dir_prefix}{day}*/*" for day in day_list(campaign_start_date, periods)]


def conform(df: DataFrame, cols: Sequence[str] | None = None, optional: Collection[str] = ()) -> DataFrame:
    """Select the declared POS columns with the declared types.

    Columns stored with another type (e.g. prices as text) are cast with
    ``try_cast`` so a bad value becomes null instead of failing the job.
    ``cols`` restricts the projection (unknown names raise).  A column that the
    input lacks raises, unless it is named in ``optional``: then it is null.
    Filter and key columns are never optional.
    """
    wanted = list(cols) if cols else [f.name for f in POS_SCHEMA.fields]
    have = dict(df.dtypes)
    missing = [c for c in wanted if c not in have and (c in REQUIRED or c not in optional)]
    if missing:
        raise ValueError(f"POS columns missing from the input: {', '.join(missing)}")
    out = []
    for name in wanted:
        field = POS_SCHEMA[name]
        if name not in have:
            out.append(F.lit(None).cast(field.dataType).alias(name))
        elif have[name] == field.dataType.simpleString():
            out.append(F.col(name))
        else:
            out.append(F.col(name).try_cast(field.dataType).alias(name))
    return df.select(out)


def sales_rows(df: DataFrame, comp_cd: str | None = None) -> DataFrame:
    """Sales lines of the domestic country, optionally of one company.

    ``SALES_SIGN='+' AND COUNTRY_CD='10' [AND COMPANY_CD_UNIQUE=comp_cd]`` —
    pushed into the parquet scan as data filters.
    """
    cond = (F.col("SALES_SIGN") == "+") & (F.col("COUNTRY_CD") == "10")
    if comp_cd is not None:
        cond = cond & (F.col("COMPANY_CD_UNIQUE") == str(comp_cd))
    return df.where(cond)


def in_day_range(df: DataFrame, campaign_start_date: str, periods: int = 1,
                 day_col: str = "SALES_YMD") -> DataFrame:
    """Rows of the ``periods`` days ending on the start date (partition pruning form)."""
    lo, hi = day_bounds(campaign_start_date, periods)
    return df.where(F.col(day_col).between(lo, hi))


def _plain(path: str) -> str:
    """A path without scheme, authority and closing slash."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


def _schema_digest(path: str) -> str:
    if path.startswith("file:"):
        files, name = pafs.LocalFileSystem(), _plain(path)
    else:
        files, name = pafs.FileSystem.from_uri(quote(path, safe="/:@"))
    with files.open_input_file(name) as f:
        schema = pq.read_schema(f)
    spark_types = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    return hashlib.md5(str(schema.remove_metadata()).encode() + spark_types).hexdigest()


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each file's schema; null for a file that the worker's own file systems cannot open."""
    for batch in batches:
        keys = []
        for path in batch["path"].to_pylist():
            try:
                keys.append(_schema_digest(path))
            except (pa.ArrowException, OSError):
                keys.append(None)
        yield pa.RecordBatch.from_arrays([batch["path"], pa.array(keys, pa.string())], ["path", "digest"])


def schema_groups(spark: SparkSession, roots: Sequence[str]) -> list[tuple[list[str], str | None]]:
    """What to scan together: (paths, base path) for each distinct schema of the files under ``roots``.

    The tasks of one job read the footers; the driver gets a path and a digest
    a file, no more than the file listing that it holds for any scan.  A folder
    whose files agree is named as a whole; of a folder with several schemas the
    files are named, with the folder as base path where it holds partition
    folders.  Files that the workers cannot open by themselves (a store only
    Spark has the credentials for) form one group a folder, with the schema
    that Spark finds there.  A root without files raises ``FileNotFoundError``.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(roots))
              .select("path").mapInArrow(_footers, "path string, digest string").collect())
    by_plain = {_plain(r): r for r in roots}
    files: dict[str, dict[str, str | None]] = {r: {} for r in by_plain}
    for path, digest in listed:
        root = _plain(path)
        while root not in files and root != os.path.dirname(root):
            root = os.path.dirname(root)
        files[root][path] = digest
    empty = [by_plain[r] for r, found in files.items() if not found]
    if empty:
        raise FileNotFoundError(f"no POS files under {', '.join(sorted(empty))}")
    groups: dict[tuple, list[str]] = defaultdict(list)
    for root, found in files.items():
        folders = tuple(sorted({part.partition("=")[0] for path in found
                                for part in _plain(path)[len(root):].split("/")[:-1] if "=" in part}))
        whole = len(set(found.values())) == 1
        for path, digest in found.items():
            own = digest is None or (folders and not whole)
            group = groups[digest, folders, root if own else None, None if whole or not folders else by_plain[root]]
            if not whole:
                group.append(path)
            elif not group or group[-1] != by_plain[root]:
                group.append(by_plain[root])
    return [(paths, base) for (_, _, _, base), paths in groups.items()]


def read_pos(spark: SparkSession, paths: str | Sequence[str], cols: Sequence[str] | None = None,
             comp_cd: str | None = None, base_path: str | None = None, optional: Collection[str] = ()) -> DataFrame:
    """Scan POS parquet (any number of paths/globs), conform, keep sales rows.

    Files are read with the types of their own footers, one scan for each
    distinct schema, and conformed to the declared schema before the union, so
    a column whose type changes from one file to the next is converted, not
    misread.  The filter is applied on the conformed columns; where a column is
    stored with the declared type it reaches the scan as ``PushedFilters``.
    With ``cols`` only those and the filter columns need to exist.  A path that
    is named twice is read once; one that matches nothing raises.
    """
    if isinstance(paths, str):
        paths = [paths]
    found = {p: matching_paths(spark, p) for p in dict.fromkeys(paths)}
    gone = [p for p, m in found.items() if not m]
    if gone or not found:
        raise FileNotFoundError(f"no POS files at {', '.join(gone)}")
    return _read(spark, list(dict.fromkeys(r for m in found.values() for r in m)), cols, comp_cd, base_path, optional)


def _read(spark: SparkSession, roots: Sequence[str], cols: Sequence[str] | None, comp_cd: str | None,
          base_path: str | None, optional: Collection[str]) -> DataFrame:
    needed = None if not cols else [*cols, *[c for c in FILTER_COLUMNS if c not in cols]]
    parts = []
    for group, base in schema_groups(spark, roots):
        base = base_path or base
        reader = spark.read.option("basePath", base) if base else spark.read
        parts.append(sales_rows(conform(reader.parquet(*group), needed, optional), comp_cd))
    df = reduce(DataFrame.unionByName, parts)
    return df.select(*cols) if cols else df


def _day_folders(spark: SparkSession, base: str, days: Sequence[str], dir_prefix: str) -> dict[str, list[str]]:
    """The folders of each day that hold something, from one listing of the base."""
    found = matching_paths(spark, f"{base.rstrip('/')}/{dir_prefix}{{{','.join(days)}}}*/*")
    folders: dict[str, list[str]] = {day: [] for day in days}
    for folder in dict.fromkeys(os.path.dirname(p) for p in found):
        folders[os.path.basename(folder)[len(dir_prefix):][:8]].append(folder)
    return folders


def missing_days(spark: SparkSession, base: str, campaign_start_date: str, periods: int = 1,
                 dir_prefix: str = "") -> list[str]:
    """The days of the window that have no files."""
    folders = _day_folders(spark, base, day_list(campaign_start_date, periods), dir_prefix)
    return [day for day, found in folders.items() if not found]


def read_pos_days(spark: SparkSession, base: str, campaign_start_date: str, periods: int = 1,
                  cols: Sequence[str] | None = None, comp_cd: str | None = None,
                  dir_prefix: str = "", skip_missing: bool = False, optional: Collection[str] = ()) -> DataFrame:
    """Scan only the day directories of the window.

    A day without files raises ``FileNotFoundError``; with ``skip_missing`` the
    days that exist are read (``missing_days`` tells which do not).
    """
    folders = _day_folders(spark, base, day_list(campaign_start_date, periods), dir_prefix)
    gone = [day for day, found in folders.items() if not found]
    if gone and not skip_missing:
        raise FileNotFoundError(f"no POS files under {base} for {', '.join(gone)}")
    roots = [folder for found in folders.values() for folder in found]
    if not roots:
        return spark.createDataFrame([], POS_SCHEMA).select(*(cols or POS_SCHEMA.fieldNames()))
    return _read(spark, roots, cols, comp_cd, base if dir_prefix else None, optional)
