import random
import zlib

import numpy as np
from posgraph.llm import packing
from posgraph.llm.common import tokenizer_path
from tokenizers import Tokenizer

from tests.llm.util import docs, documents, texts

PATH = tokenizer_path()


def ids_of(tok, text):
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check(rows, source, length=2048):
    """Pieces rebuild every document, sequences are gapless from 0 and not too long."""
    tok = Tokenizer.from_file(PATH)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(source)
    for d, parts in by_doc.items():
        ids, parts = ids_of(tok, source[d]), sorted(parts, key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert sum(r["length"] for r in parts) == len(ids)
        assert all(r["length"] == length for r in parts[1:]) and parts[0]["length"] <= length
        for r in parts:
            assert zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    for places in by_seq.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(by_seq), -(-sum(r["length"] for r in rows) // length)


def test_sample_round_trip(spark):
    rows = packing.best_fit(documents(spark), PATH).collect()
    used, least = check(rows, texts(spark))
    assert used <= least + max(2, least // 50)


def test_packed_sequences_hold_the_ids(spark):
    packed = packing.best_fit(documents(spark).limit(40), PATH, with_ids=True)
    seqs = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert seqs[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]


def test_encoder_equals_the_tokenizers_library():
    rng = random.Random(3)
    enc, tok = packing.encoder(PATH), Tokenizer.from_file(PATH)
    some = [*map(chr, range(256)), "<|endoftext|>", "'ll", "  ", "\n\n", "é", "ß", "猫", "😀", "\u2003", "ा", "\x85"]
    for _ in range(2000):
        t = "".join(rng.choice(some) for _ in range(rng.randrange(60)))
        assert enc.ids(t).tolist() == tok.encode(t, add_special_tokens=False).ids
    for t in (" " * 120_000, "a" * 3000, "x" + "\n" * 60_000 + "y"):
        assert enc.ids(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_each_piece_goes_where_the_sum_of_squares_is_smallest():
    rng = np.random.default_rng(5)
    for _ in range(30):
        cap = int(rng.integers(5, 40))
        lengths = rng.integers(1, cap + 1, rng.integers(1, 60))
        where, offset = packing.sum_of_squares(lengths, cap)
        fill = {}
        for i in np.argsort(-lengths, kind="stable"):
            def squares(f):
                gaps = [cap - v for v in f.values() if v < cap]
                return sum(c * c for c in np.bincount(gaps, minlength=1)) if gaps else 0
            choices = [squares(fill | {s: v + lengths[i]}) for s, v in fill.items() if v + lengths[i] <= cap]
            choices.append(squares(fill | {-1: lengths[i]}))
            assert offset[i] == fill.get(where[i], 0)
            fill[where[i]] = fill.get(where[i], 0) + lengths[i]
            assert fill[where[i]] <= cap and squares(fill) == min(choices)


def test_nulls_long_repeated_and_clashing(spark):
    pairs = [(1, None), (2, ""), (3, "word " * 30_000), (4, "short"), (5, "猫 " * 3_000)]
    rows = packing.best_fit(docs(spark, pairs, clashes=True), PATH).collect()
    check(rows, dict(pairs))
    odd = packing.best_fit(docs(spark, [(None, "a"), (7, "b"), (7, "b"), (None, None)]), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in odd) == [(0, 1), (0, 2), (7, 2), (7, 2)]
    assert len({(r["sequence_id"], r["offset"]) for r in odd}) == 4


def test_many_shards(spark):
    rows = packing.pieces(docs(spark, [(i, f"text number {i} " * (i % 90)) for i in range(600)]), PATH)
    from posgraph.llm.common import stored
    out = packing.pack(stored(rows, "p"), shard_pieces=100).collect()
    check(out, {i: f"text number {i} " * (i % 90) for i in range(600)})


def test_empty_table(spark):
    assert packing.best_fit(docs(spark, []), PATH).count() == 0
