"""Small frames and plain-Python versions of the contracts."""

import re

from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns of the same names as the operators' own, and some with odd names.
CLASHES = ("kept string, score string, keep_id string, component_id string, row string, _row string, _may string, "
           "loc string, th string, n_shingles string, `a.b` string, spans string, label string")


def docs(spark, rows, clashes=False):
    """Documents from (doc_id, text) or (doc_id, text, lang)."""
    full = [(*r, *([None] * (3 - len(r))), None, None) for r in rows]
    if not clashes:
        return spark.createDataFrame(full, DOCS)
    return spark.createDataFrame([(*r, *["x"] * 13) for r in full], f"{DOCS}, {CLASHES}")


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower_ascii(text or "")) if w]


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
