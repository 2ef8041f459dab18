"""Golomb codes (power-of-two parameter) for sorted integers, in numpy."""

from __future__ import annotations

import numpy as np


def parameter(universe: int, n: int) -> int:
    """Bits of the binary part for ``n`` values spread over ``universe``."""
    return max(0, (universe // max(n, 1)).bit_length() - 1)


def encode(values: np.ndarray, bits: int) -> bytes:
    """Gaps of ascending unsigned ``values``: quotients in unary, then ``bits``-bit remainders."""
    if not len(values):
        return b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    quotients = (gaps >> np.uint64(bits)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    places = np.arange(bits, dtype=np.uint64)
    binary = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    return np.packbits(unary).tobytes() + np.packbits(binary.ravel()).tobytes()


def decode(code: bytes, n: int, bits: int) -> np.ndarray:
    """The ``n`` values that :func:`encode` was given."""
    if not n:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(code, np.uint8)
    tail = (n * bits + 7) // 8
    ends = np.flatnonzero(np.unpackbits(raw[:len(raw) - tail]))[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(bits)
    if bits:
        binary = np.unpackbits(raw[len(raw) - tail:], count=n * bits).reshape(n, bits)
        places = np.arange(bits, dtype=np.uint64)
        gaps += (binary.astype(np.uint64) << places).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)
