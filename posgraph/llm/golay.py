"""The binary Golay code [23, 12, 7] and the codewords near a 23-bit segment (numpy).

The code is perfect: every segment has exactly one codeword within 3 bits, its
own.  Codewords at distance 4 exist only for segments at distance 3 from their
own, five each.  So a segment that differs from another in one bit has the
other's own codeword among its at most six near ones (3 + 1 bits).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECK = 23, 11
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
NEAR = 6


def _remainder(word: int) -> int:
    for k in range(LENGTH - 1, CHECK - 1, -1):
        if word >> k & 1:
            word ^= GENERATOR << (k - CHECK)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bit = [_remainder(1 << k) for k in range(LENGTH)]
    syndromes = np.zeros(1 << 12, np.uint32)
    for k in range(12):
        syndromes[1 << k:2 << k] = syndromes[:1 << k] ^ bit[k]
    high = np.zeros(1 << 11, np.uint32)
    for k in range(11):
        high[1 << k:2 << k] = high[:1 << k] ^ bit[12 + k]
    # Errors by syndrome: the one of weight up to 3, then those of weight 4 (none, or five).
    errors: list[list[int]] = [[] for _ in range(1 << CHECK)]
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            s = 0
            for k in places:
                s ^= bit[k]
            if weight < 4 or errors[s][0].bit_count() == 3:
                errors[s].append(sum(1 << k for k in places))
    table = np.zeros((1 << CHECK, NEAR), np.uint32)
    for s, e in enumerate(errors):
        table[s, :len(e)] = e
    return syndromes, high, table


_LOW, _HIGH, _ERRORS = _tables()


def near_codewords(segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the codewords within 4 bits, own first; which of the ``NEAR`` places are filled).

    A codeword's index is its 12 message bits.
    """
    x = segments.astype(np.uint32)
    error = _ERRORS[_LOW[x & np.uint32(4095)] ^ _HIGH[x >> np.uint32(12)]]
    there = error != 0
    there[:, 0] = True
    return (x[:, None] ^ error) >> np.uint32(CHECK), there
