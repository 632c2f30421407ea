"""Operator 3: licence scan with a positional rare-token index (DataFrame operations only).

1. One pass over the texts keeps, per document, the places of the words that
   occur in a licence template (the positional index) and the word count.
2. The words' document frequencies over all documents give their weights
   (inverse document frequency).
3. Each file's occurrences of a template's rarest key-phrase word are looked up
   in the template postings; place minus place in the template is the relative
   position, and each distinct one is an alignment.
4. At an alignment the key phrase must stand word by word; the score is the
   weight of all template words that match there over the template's weight.

Templates that are a bare phrase (the base labels) are matched wherever their
words stand consecutively.  Longer templates add their label when at least
``ACCEPT`` of their weight matches around the key phrase.

Rows: one per input row.  A null or empty text has no words, empty labels and
score 0.  Null and repeated ``doc_id`` are carried through.  An empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posgraph.llm.common import rows_of, stored

ACCEPT = 0.6
UNIT = 1000  # weights are whole thousandths, so sums do not depend on their order
# Words as the contract gives them, on text that still has its capitals.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# (label, key phrase, text around it); base templates have no other text.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
TEMPLATES = [
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted",
     "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl", "gnu general public license", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "lesser general public license", "licensed under the gnu lesser general public license version 3"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use",
     "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "public domain", "this is free software released into the public domain"),
    ("proprietary", "without prior written permission", "may be reproduced without prior written permission"),
]


def template_rows() -> list[tuple[int, str, int, int, str, int, int]]:
    """(template, label, base, words, word, place, in key phrase) of every template word."""
    out = []
    for k, (label, key, text) in enumerate([(a, b, b) for a, b in BASE] + TEMPLATES):
        words, phrase = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
        out += [(k, label, int(k < len(BASE)), len(words), w, i, int(at <= i < at + len(phrase)))
                for i, w in enumerate(words)]
    return out


VOCABULARY = sorted({r[4] for r in template_rows()})


def _positions() -> Column:
    words = F.transform("words", lambda w, i: F.struct(F.lower(w).alias("word"), i.alias("pos"),
                                                       (F.octet_length(w) == F.length(w)).alias("ascii")))
    return F.filter(words, lambda x: x["word"].isin(VOCABULARY) & x["ascii"])


def index(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, hits): the positional index of the licence words (stored)."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    rows = docs.select("doc_id", words.alias("words"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                              F.size("words").cast("long").alias("n_words"),
                              F.transform(_positions(), lambda x: F.struct(x["word"], x["pos"])).alias("hits")),
                  "licence-index")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row."""
    idx = index(docs)
    spark = docs.sparkSession
    n = idx.count()
    words = F.explode(F.array_distinct(F.transform("hits", lambda x: x["word"]))).alias("word")
    df = {r["word"]: r["count"] for r in idx.select(words).groupBy("word").count().collect()}  # one row a template word
    template = template_rows()
    weight = {w: math.floor(UNIT * math.log((n + 1) / (df.get(w, 0) + 1))) + 1 for w in VOCABULARY}
    # The postings: a few hundred fixed rows.
    postings = rows_of(spark, [(*r, weight[r[4]]) for r in template],
                       ["template", "label", "base", "size", "word", "place", "key", "weight"])
    seeds = {}
    for k, _, _, _, w, place, key in template:
        if key and (k not in seeds or (weight[w], -place) > (weight[seeds[k][0]], -seeds[k][1])):
            seeds[k] = (w, place)
    seed = rows_of(spark, [(k, w, p) for k, (w, p) in seeds.items()], ["template", "word", "place"])

    rare = sorted({w for w, _ in seeds.values()})
    some = idx.where(F.exists("hits", lambda x: x["word"].isin(rare)))
    hits = some.select("row", F.explode("hits").alias("h")).select("row", "h.word", "h.pos")
    start = (F.col("pos") - F.col("place")).alias("start")
    aligned = hits.join(F.broadcast(seed), "word").select("row", "template", start).distinct()
    wanted = aligned.join(F.broadcast(postings), "template").withColumn("pos", F.col("start") + F.col("place"))
    got = (wanted.join(hits.withColumn("here", F.lit(1)), ["row", "pos", "word"], "left")
           .groupBy("row", "template", "label", "base", "size", "start")
           .agg(F.sum(F.when(F.col("key") == 1, F.coalesce("here", F.lit(0)) - 1)).alias("missing"),
                F.sum(F.when(F.col("here") == 1, F.col("weight")).otherwise(0)).alias("found"),
                F.sum("weight").alias("total")).where("missing = 0"))
    got = got.withColumn("score", F.col("found") / F.col("total")).where(f"base = 1 or score >= {ACCEPT}")
    base = F.col("base") == 1
    labels = (got.groupBy("row").agg(
        F.sum("base").alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), F.max("score").alias("score"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels")))
    zero, none = F.lit(0), F.lit("")
    return idx.select("row", "doc_id", "n_words").join(labels, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", zero).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", none).alias("base_labels"), F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
