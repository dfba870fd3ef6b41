"""Numpy helpers over the UTF-8 bytes of many texts at once.

A batch of texts is one byte array with offsets. Work goes in blocks of whole texts of about ``BLOCK`` bytes, so that the
temporary arrays stay small; a single longer text is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1
LONG_SPAN = 256
LANE_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        factors = np.full(max(n, BLOCK), base, U64)
        factors[0] = 1
        have = _powers[base] = np.multiply.accumulate(factors)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection); works in place on its argument."""
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return body, at - at[0]


def struct_text(rows: pa.Array, name: str) -> pa.Array:
    """The text field of a column of rows; a missing one is empty."""
    return pc.fill_null(pc.cast(pc.struct_field(rows, [rows.type.get_field_index(name)]), pa.string()), "")


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK, most: int = 1024) -> Iterator[tuple[int, int]]:
    """Runs of at most ``most`` whole texts and ``limit`` bytes, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(i + most, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1))
        yield i, j
        i = j


def span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the content of each byte span; equal contents get equal hashes, in any order of spans.

    Spans are read in lanes of eight bytes, and each lane is mixed in before the next one, so a repeated pattern cannot
    cancel itself out as in a polynomial. A span over ``LONG_SPAN`` bytes is hashed by BLAKE2b.
    """
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    length = ends - starts
    out = mix(length.astype(U64) + U64(BASE))
    padded = np.zeros(len(body) + 8, np.uint8)
    padded[: len(body)] = body
    lanes = np.ndarray(len(body) + 1, "<u8", padded, strides=(1,))
    live = np.flatnonzero((length > 0) & (length <= LONG_SPAN))
    at = 0
    while len(live):
        lane = lanes[starts[live] + at]
        left = length[live] - at
        np.bitwise_and(lane, LANE_MASK[np.minimum(left, 8)], out=lane)
        out[live] = mix((out[live] ^ lane) + U64(BASE))
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(length > LONG_SPAN).tolist():
        digest = hashlib.blake2b(body[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes (A-Z lower-cased), their start bytes, and the offsets of each text's words."""
    if not len(body):
        return np.empty(0, U64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SEPARATOR[body]
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    first, final = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    final[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(final) + 1
    return span_hashes(LOWER[body], starts, ends), starts, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of n words of each text and their offsets; a text of fewer words has its whole sequence as one."""
    counts = np.diff(at)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_at = np.zeros(len(at), np.int64)
    np.cumsum(sizes, out=out_at[1:])
    out = np.empty(int(out_at[-1]), U64)
    factor = U64(0xBF58476D1CE4E5B9)
    if len(hashes) >= n:
        run = hashes[: len(hashes) - n + 1].copy()
        for k in range(1, n):
            run *= factor
            run += hashes[k : len(hashes) - n + 1 + k]
        mix(run)
        whole = np.flatnonzero(counts >= n)
        if len(whole):
            index = np.arange(int(sizes[whole].sum()))
            begin = np.cumsum(sizes[whole]) - sizes[whole]
            source = index + np.repeat(at[whole] - begin, sizes[whole])
            target = index + np.repeat(out_at[whole] - begin, sizes[whole])
            out[target] = run[source]
    for length in range(1, min(n, int(counts.max(initial=0)) + 1)):
        short = np.flatnonzero(counts == length)
        if len(short):
            run = hashes[at[short]].copy()
            for k in range(1, length):
                run *= factor
                run += hashes[at[short] + k]
            run += U64(length)
            out[out_at[short]] = mix(run)
    return out, out_at


def distinct_per_text(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each text and their offsets; sorts ``values`` in place."""
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    if len(values):
        keep[1:] = values[1:] != values[:-1]
        keep[at[:-1][np.diff(at) > 0]] = True
    before = np.zeros(len(values) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    return values[keep], before[at]
