"""Compressed bitmaps of 64-bit ids.

Ids are split into a chunk (the upper 48 bits) and a place (the lower 16). A chunk is stored as a sorted array of
places or, above 4,096 of them, as 8 KB of bits, whichever is smaller. Union and cardinality are exact.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

_ARRAY_MOST = 4096


def pack(ids: Iterable[int]) -> bytes:
    """The bitmap of distinct ids, negative ones included."""
    values = np.unique(np.fromiter(ids, dtype=np.int64))
    return _pack_sorted(values)


def _pack_sorted(values: np.ndarray) -> bytes:
    chunks, low = values >> 16, (values & 0xFFFF).astype(np.uint16)
    starts = np.flatnonzero(np.r_[True, chunks[1:] != chunks[:-1]]) if len(values) else np.array([], dtype=int)
    ends = np.r_[starts[1:], len(values)] if len(values) else starts
    out = []
    for a, b in zip(starts, ends):
        n = int(b - a)
        out.append(struct.pack("<qI", int(chunks[a]), n))
        if n <= _ARRAY_MOST:
            out.append(low[a:b].astype("<u2").tobytes())
        else:
            bits = np.zeros(65536, dtype=np.uint8)
            bits[low[a:b]] = 1
            out.append(np.packbits(bits, bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes) -> np.ndarray:
    """The sorted ids."""
    at, parts = 0, []
    while at < len(data):
        chunk, n = struct.unpack_from("<qI", data, at)
        at += 12
        if n <= _ARRAY_MOST:
            low = np.frombuffer(data, dtype="<u2", count=n, offset=at)
            at += 2 * n
        else:
            low = np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8, count=8192, offset=at), bitorder="little"))
            at += 8192
        parts.append((chunk << 16) + low.astype(np.int64))
    return np.concatenate(parts) if parts else np.array([], dtype=np.int64)


def union(bitmaps: Iterable[bytes]) -> bytes:
    parts = [unpack(b) for b in bitmaps]
    return _pack_sorted(np.unique(np.concatenate(parts))) if parts else b""


def cardinality(data: bytes) -> int:
    at, total = 0, 0
    while at < len(data):
        _, n = struct.unpack_from("<qI", data, at)
        at += 12 + (2 * n if n <= _ARRAY_MOST else 8192)
        total += n
    return total


def chunks(data: bytes) -> list[tuple[int, bytes]]:
    """Each chunk's number and the bitmap of this chunk alone, at most 8 KB."""
    at, out = 0, []
    while at < len(data):
        chunk, n = struct.unpack_from("<qI", data, at)
        end = at + 12 + (2 * n if n <= _ARRAY_MOST else 8192)
        out.append((chunk, data[at:end]))
        at = end
    return out


def contains_all(data: bytes, values: np.ndarray) -> np.ndarray:
    """For each value whether it is in the bitmap."""
    return np.isin(values, unpack(data), assume_unique=False)
