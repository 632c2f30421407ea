"""Operator 8: best-fit packing of tokenised documents by the sum-of-squares rule.

A document becomes its token ids and one end id; only documents longer than a
sequence are cut (the first piece takes the remainder, the others are full).
Pieces go to shards of about ``SHARD_PIECES`` by a random-like key, so no
source and no repeated id fills a shard; each shard packs its pieces, largest
first: every piece goes where the sum over residual gaps g of N(g)^2 becomes
smallest, N(g) being the number of open sequences with gap g (a new sequence
is one of the choices; ties go to the tightest fit).

Tokens and pieces are made in one pass and stored, so no text is shuffled and
a lost executor costs no retokenising elsewhere.

Rows: a null or empty text is one piece of one token (the end id).  A null or
repeated ``doc_id`` is packed like any other row (its piece rows carry the
same id).  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posgraph.llm.common import stored

LENGTH = 2048
END_ID = 0
SHARD_PIECES = 50_000
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, _key long")
_LONG_BLANK = re.compile(r"\s{50000}")
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids exactly as ``tokenizers`` gives them for a byte-level BPE file.

    The same vocabulary and merges run through ``tiktoken``, about four times
    as fast, for texts within Latin-1, where the two libraries' character
    classes agree; any other text goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path, self._exact = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        self.fast = None
        if spec["normalizer"] is None and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex")) == (
                "ByteLevel", False, True):
            printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
            hidden = [b for b in range(256) if b not in printable]
            to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            ranks = {bytes(to_byte[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in special}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    @property
    def exact(self):
        """The ``tokenizers`` object; loaded when a text needs it."""
        if self._exact is None:
            from tokenizers import Tokenizer
            self._exact = Tokenizer.from_file(self.path)
        return self._exact

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not (len(text) > 50000 and _LONG_BLANK.search(text)):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), _key."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        rng = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows: list[tuple] = []
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    ids = np.append(enc.ids(text) if text else np.zeros(0, "<u4"), np.uint32(end_id)).astype("<u4")
                    edges = [0, *range(len(ids) % length or length, len(ids) + 1, length)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        row = (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), int(rng.integers(1 << 62)))
                        rows.append(row + ((ids[a:b].astype(np.int32),) if with_ids else ()))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                types += [pa.list_(pa.int32())] * with_ids
                names = [f.split()[0] for f in PIECES.split(", ")] + ["ids"] * with_ids
                cols = list(zip(*rows, strict=True)) if rows else [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)
    return docs.select("doc_id", "text").mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece; pieces are placed largest first."""
    order = np.argsort(-lengths, kind="stable")
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1, np.int64)  # open sequences by gap; full ones do not count
    made = 0
    for i in order:
        s = int(lengths[i])
        gap = capacity
        if s < capacity:
            have = n[s:capacity]
            cost = 2 * (n[:capacity - s] - have) + 2  # N(g) loses one, N(g - s) gains one
            cost[0] -= 1                              # a sequence that becomes full is counted no more
            cost[have == 0] = np.iinfo(np.int64).max
            best = int(cost.argmin()) if len(cost) else 0
            if len(cost) and cost[best] <= 2 * n[capacity - s] + 1:
                gap = s + best
        if gap == capacity:
            seq, made = made, made + 1
        else:
            seq = open_by_gap[gap].pop()
            n[gap] -= 1
        where[i], offset[i] = seq, capacity - gap
        if gap > s:
            open_by_gap[gap - s].append(seq)
            n[gap - s] += 1
    return where, offset


def pack(rows: DataFrame, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``rows`` (stored pieces) with sequence_id and offset."""
    shards = max(1, -(-rows.count() // shard_pieces))
    names = [c for c in rows.columns if c != "ids"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "ids")

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "_key"], ascending=[False, True], kind="stable", ignore_index=True)
        seq, offset = sum_of_squares(group["length"].to_numpy(np.int64), length)
        shard = int(group["_shard"].iat[0])
        return group[names].assign(sequence_id=seq * shards + shard, offset=offset)
    placed = (rows.select(names).withColumn("_shard", F.pmod(F.col("_key"), F.lit(shards))).groupBy("_shard")
              .applyInPandas(place, kinds + ", sequence_id long, offset long"))
    if "ids" not in rows.columns:
        return placed.drop("_key")
    # Token ids meet their piece after the placing, so that no shard holds them.
    ids = rows.select("_key", F.col("doc_id").alias("_doc"), F.col("piece").alias("_piece"), "ids")
    same = (placed["_key"] == ids["_key"]) & placed["doc_id"].eqNullSafe(ids["_doc"]) & (placed["piece"] == ids["_piece"])
    return placed.join(ids, same).select(*names[:-1], "ids", "sequence_id", "offset")


def best_fit(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID,
             with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32 (, ids), sequence_id, offset."""
    return pack(stored(pieces(docs, tokenizer, length, end_id, with_ids), "pieces"), length)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed token sequences (``best_fit(..., with_ids=True)``): sequence_id, ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most one sequence length of tokens
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
