"""Scalar column helpers.  All built-in expressions: they stay inside
whole-stage codegen, no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(c: str | Column) -> Column:
    """'Y' -> true, anything else -> false, null stays null."""
    return col(c) == F.lit("Y")


def try_cast(c: str | Column, dtype: str) -> Column:
    """Cast that yields null on bad input instead of failing (ANSI mode)."""
    return col(c).try_cast(dtype)


def parse_timestamp(c: str | Column) -> Column:
    """Date/time text -> timestamp_ntz; ISO forms and compact yyyyMMdd; bad text -> null."""
    c = col(c)
    return F.coalesce(
        F.try_to_timestamp(c),
        F.try_to_timestamp(c, F.lit("yyyyMMdd")),
    ).cast("timestamp_ntz")


def parse_compact_datetime(c: str | Column) -> Column:
    """'yyyyMMddTHHmmss' text -> timestamp_ntz (null when malformed)."""
    return F.try_to_timestamp(col(c), F.lit("yyyyMMdd'T'HHmmss")).cast("timestamp_ntz")


def birth_date(y: str, m: str, d: str) -> Column:
    """Y-MM-DD text; concat_ws skips null parts, so a null month gives '1950-01'."""
    return F.concat_ws("-", F.col(y), F.lpad(F.col(m), 2, "0"), F.lpad(F.col(d), 2, "0"))


def joined_id(*parts: str) -> Column:
    """Underscore-joined id; null parts are skipped (concat_ws)."""
    return F.concat_ws("_", *[F.col(p).cast("string") for p in parts])


def compact_datetime(ymd: str = "SALES_YMD", hms: str = "SALES_HMS") -> Column:
    """'yyyyMMddTHHmmss' text; null when any part is null (concat)."""
    return F.concat(F.col(ymd).cast("string"), F.lit("T"), F.col(hms))


# ---------------------------------------------------------------- nesting

def leaf_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    out: list[tuple[tuple[str, ...], T.DataType]] = []
    for f in schema.fields:
        path = prefix + (f.name,)
        if isinstance(f.dataType, T.StructType):
            out.extend(leaf_paths(f.dataType, path))
        else:
            out.append((path, f.dataType))
    return out


def flat_name(path: tuple[str, ...]) -> str:
    return "_".join(path)


def flat_names(schema: T.StructType) -> list[str]:
    return [flat_name(p) for p, _ in leaf_paths(schema)]


def flatten(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Nested frame -> one column per leaf, named by its path joined with '_'."""
    return df.select([F.col("`" + "`.`".join(p) + "`").alias(flat_name(p))
                      for p, _ in leaf_paths(schema)])


def nest(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Flat frame (leaf columns named as ``flatten`` names them) -> nested frame."""

    def build(st: T.StructType, prefix: tuple[str, ...]) -> list[Column]:
        cols = []
        for f in st.fields:
            path = prefix + (f.name,)
            if isinstance(f.dataType, T.StructType):
                cols.append(F.struct(*build(f.dataType, path)).alias(f.name))
            else:
                cols.append(F.col(flat_name(path)).cast(f.dataType).alias(f.name))
        return cols

    return df.select(build(schema, ()))
