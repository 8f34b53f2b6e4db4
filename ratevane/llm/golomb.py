"""Golomb-Rice codes of sorted unsigned integers; a code's unary ends are found one after the other, all else is vectorised."""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray, universe: int) -> tuple[bytes, int]:
    """Code of ascending `values` below `universe`, and its parameter: each gap is a quotient in unary and `k` low bits."""
    n = len(values)
    k = max(0, int(np.log2(max(1, universe // max(1, n)))))
    if not n:
        return b"", k
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(quotient + 1 + k)])
    bits = np.zeros(int(at[-1]), np.uint8)
    stop = at[:-1] + quotient
    ones = np.ones(int(at[-1]), np.uint8)
    for j in range(k + 1):
        ones[stop + j] = 0
    bits |= ones
    for j in range(k):
        bits[stop + 1 + j] = ((gaps >> np.uint64(k - 1 - j)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).tobytes(), k


def decode(code: bytes, n: int, k: int) -> np.ndarray:
    """The `n` values of encode()."""
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    zeros = np.flatnonzero(bits == 0)
    following = np.searchsorted(zeros, np.arange(len(bits) + 1))
    stop = np.empty(n, np.int64)
    zero_list, next_list, at = zeros.tolist(), following.tolist(), 0
    for i in range(n):
        z = zero_list[next_list[at]]
        stop[i] = z
        at = z + 1 + k
    start = np.concatenate([[0], stop[:-1] + 1 + k])
    low = np.zeros(n, np.uint64)
    for j in range(k):
        low = (low << np.uint64(1)) | bits[stop + 1 + j].astype(np.uint64)
    return np.cumsum(((stop - start).astype(np.uint64) << np.uint64(k)) | low)


def bitmap(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(np.uint8)).tobytes()


def flags(code: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(code, np.uint8), count=n).astype(bool)
