"""Word hashes of many texts at once (numpy), used inside tasks.

Texts are UTF-8 bytes; A-Z are lower-cased and words are runs of bytes other
than ``[\\x20\\x09-\\x0D]``.  A word's hash is a 64-bit polynomial over mixed byte
values, taken from one running sum, so a chunk of texts costs a few array passes that stay in the cache.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# Everything but ASCII letters and digits and bytes of other characters.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_P = 0x9E3779B97F4A7C13 | 3
_P_INVERSE = pow(_P, -1, 1 << 64)
_powers = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(P^i, P^-i) for i < n, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def running(data: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """c with c[j] - c[i] = sum of table[data[k]] * P^k over i <= k < j."""
    c = np.zeros(len(data) + 1, _U)
    np.cumsum(table[data] * powers(len(data))[0][:len(data)], out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes in [start, end), independent of where they stand."""
    return mix((c[end] - c[start]) * powers(len(c))[1][start] + (end - start).astype(_U))


def word_hashes(texts: list[bytes], between: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every text), in order; ``between`` marks the separating bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer((b"\n".join(texts) + b"\n").translate(_LOWER), np.uint8)
    blank = between[data]
    turn = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        turn = np.concatenate([[0], turn])
    start, end = turn[::2], turn[1::2]  # the data end with a blank
    hashes = np.empty(len(start), _U)
    at = 0
    while at < len(start):  # block by block, so that a very long text needs no long arrays of sums
        stop = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK_BYTES, "right")))
        base = start[at]
        c = running(data[base:end[stop - 1]])
        hashes[at:stop] = span_hash(c, start[at:stop] - base, end[at:stop] - base)
        at = stop
    ends = np.cumsum(sizes + 1)
    counts = np.diff(np.searchsorted(start, ends), prepend=0)
    return hashes, counts


def chunks(batch: pa.RecordBatch, column: str = "text", fold: bool = False) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) of the batch in pieces of about ``CHUNK_BYTES``; null is empty.

    ``fold`` lower-cases all letters, not only A-Z.
    """
    values = pc.utf8_lower(batch[column]) if fold else batch[column]
    texts = [t or b"" for t in values.cast(pa.binary()).to_pylist()]
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= CHUNK_BYTES:
            yield first, texts[first:i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def ngram_hashes(words: np.ndarray, n: int, seed: int = 5) -> np.ndarray:
    """Hash of every run of ``n`` words (fewer words: none)."""
    if len(words) < n:
        return np.zeros(0, _U)
    q = constants(n, seed)
    total = np.zeros(len(words) - n + 1, _U)
    for j in range(n):
        total += words[j:len(words) - n + 1 + j] * q[j]
    return mix(total + _U(n))
