"""Golomb codes with a power of two as parameter, for sorted whole numbers, in numpy."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parameter(values: np.ndarray, span: int) -> int:
    """Bits of the fixed part: near the binary logarithm of the mean gap."""
    return max(0, int(np.log2(max(1.0, 0.69 * span / max(1, len(values))))))


def encode(values: np.ndarray, bits: int) -> bytes:
    """Gaps of ascending values: all unary parts first, then all fixed parts of ``bits`` bits."""
    if not len(values):
        return b""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    high = (gaps >> np.uint64(bits)).astype(np.int64)
    unary = np.ones(int(high.sum()) + len(high), np.uint8)
    unary[np.cumsum(high + 1) - 1] = 0
    fixed = (gaps[:, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)
    head = np.packbits(unary)
    return len(head).to_bytes(4, "big") + head.tobytes() + np.packbits(fixed.astype(np.uint8).ravel()).tobytes()


def decode(data: bytes, bits: int, count: int) -> np.ndarray:
    if not count:
        return np.empty(0, np.uint64)
    cut = 4 + int.from_bytes(data[:4], "big")
    unary = np.unpackbits(np.frombuffer(data[4:cut], np.uint8))
    ends = np.flatnonzero(unary == 0)[:count]
    high = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    low = np.zeros(count, np.uint64)
    if bits:
        fixed = np.unpackbits(np.frombuffer(data[cut:], np.uint8))[: count * bits].reshape(count, bits)
        for column in range(bits):
            low = (low << np.uint64(1)) | fixed[:, column].astype(np.uint64)
    return np.cumsum((high << np.uint64(bits)) | low, dtype=np.uint64)
