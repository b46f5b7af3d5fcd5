"""Elias-Fano sequences in memory-mapped files, read many values at a time.

A rising sequence of integers is split bit-wise: low bits are packed side by side, high parts are written in unary into a
bit vector.  Finding where a value stands takes two selects in the bit vector, which give the run of elements with the
same high part, and a binary search among their low bits.
"""

from __future__ import annotations

import json
import mmap
import os
import uuid

import numpy as np

_ONE = np.uint64(1)


def pack(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of the Elias-Fano form of ``values`` (int64, not negative, rising)."""
    values = values.astype(np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = min(56, max(0, int(np.log2((top + 1) / n)))) if n else 0
    high = (values >> np.uint64(low_bits)).astype(np.int64)
    bits = np.zeros((int(high[-1]) + n + 64) // 64 + 1, np.uint64) if n else np.zeros(1, np.uint64)
    at = high + np.arange(n)
    np.bitwise_or.at(bits, at >> 6, _ONE << (at & 63).astype(np.uint64))
    zeros = 64 - np.bitwise_count(bits).astype(np.int64)
    packed = np.zeros((n * low_bits) // 8 + 16, np.uint8)
    if low_bits and n:
        low = values & np.uint64((1 << low_bits) - 1)
        start = np.arange(n, dtype=np.int64) * low_bits
        shifted = low << (start & 7).astype(np.uint64)
        for byte in range((low_bits + 7 + 7) // 8):
            # neighbours share bytes, but no bits, so adding is as good as an or
            np.add.at(packed, (start >> 3) + byte, ((shifted >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.uint8))
    return {
        "size": np.array([n, low_bits], np.int64), "bits": bits, "zeros": np.concatenate([[0], np.cumsum(zeros)]).astype(np.int64), "low": packed,
    }


def _nth_zero(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the zero number ``nth`` (from 0) within each 64-bit word."""
    rest, at = ~words, np.zeros(len(words), np.int64)
    nth = nth.copy()
    for width in (32, 16, 8, 4, 2, 1):
        own = rest & np.uint64((1 << width) - 1)
        ones = np.bitwise_count(own).astype(np.int64)
        skip = ones <= nth
        nth -= np.where(skip, ones, 0)
        at += np.where(skip, width, 0)
        rest = np.where(skip, rest >> np.uint64(width), own)
    return at


class EliasFano:
    """A packed sequence; its arrays may lie in a memory map."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.n, self.low_bits = (int(x) for x in arrays["size"])
        self.bits, self.zeros = arrays["bits"], arrays["zeros"]
        low = arrays["low"]
        self.windows = np.ndarray((len(low) - 7,), "<u8", buffer=low, strides=(1,))
        self.mask = np.uint64((1 << self.low_bits) - 1)

    def low(self, i: np.ndarray) -> np.ndarray:
        start = i * self.low_bits
        return (self.windows[start >> 3] >> (start & 7).astype(np.uint64)) & self.mask

    def select_zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the zero number ``k`` (from 0) in the bit vector."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        return word * 64 + _nth_zero(self.bits[word], k - self.zeros[word])

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the number of smaller elements, and whether the element there equals it (successor search)."""
        if not self.n or not len(values):
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        beyond = high >= int(self.zeros[-1]) - 1
        high = np.where(beyond, 0, high)
        wanted = values & self.mask
        # elements before the first (and after the last) with this high part: bits before that zero, less the zeros
        first = np.where(high > 0, self.select_zero(np.maximum(high - 1, 0)) + 1 - high, 0)
        last = self.select_zero(high) - high
        a, b = first.copy(), last.copy()
        active = np.flatnonzero(a < b)
        while len(active):
            middle = (a[active] + b[active]) >> 1
            less = self.low(middle) < wanted[active]
            a[active[less]] = middle[less] + 1
            b[active[~less]] = middle[~less]
            active = active[a[active] < b[active]]
        there = a < last
        there[there] = self.low(a[there]) == wanted[there]
        return np.where(beyond, self.n, a), there & ~beyond

    def get(self, i: np.ndarray) -> np.ndarray:
        """Elements by place; the unary part is walked back by a search over the words' counts of ones."""
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        word = np.searchsorted(ones, i, side="right") - 1
        at = word * 64 + _nth_zero(~self.bits[word], i - ones[word])
        return (((at - i).astype(np.uint64) << np.uint64(self.low_bits)) | self.low(i)).astype(np.int64)


def _local(path: str) -> str | None:
    """The path in a mounted file system, or None for any other store."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return path if "://" not in path else None


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays as one file; it appears whole or not at all, so a task may be run twice."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 64) * 64
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % 64)
    parts = [len(text).to_bytes(8, "little"), text]
    for a in arrays.values():
        parts += [a.tobytes(), b"\0" * (-a.nbytes % 64)]
    local = _local(path)
    if local is None:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path)
        with store.open_output_stream(inner) as out:
            for p in parts:
                out.write(p)
        return
    os.makedirs(os.path.dirname(local), exist_ok=True)
    own = f"{local}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.writelines(parts)
    os.replace(own, local)


def load(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, memory-mapped; from a store that cannot be mapped, read."""
    local = _local(path)
    if local is None:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path)
        with store.open_input_stream(inner) as source:
            data = source.readall()
    else:
        with open(local, "rb") as source:
            data = mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ)
    size = int.from_bytes(data[:8], "little")
    head = json.loads(data[8 : 8 + size])
    return {
        name: np.frombuffer(data, np.dtype(kind), count, 8 + size + at) for name, (kind, count, at) in head.items()
    }
