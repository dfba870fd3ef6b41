"""Packed blocks of (key, payload) entries: many entries travel as one binary row per block of the key space.

A row costs the engine far more than sixteen bytes, so an operator that has to bring equal 64-bit keys together sorts the
entries of a batch, cuts them where the block of the key changes and sends each cut as one binary value. A block is read
back as a whole; its size is set by the number of blocks, and callers send a key that is frequent in a batch only once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textblocks import U64

SCHEMA = "block long, kind int, body binary"
NAMES = ["block", "kind", "body"]


def block_of(keys: np.ndarray, n_blocks: int) -> np.ndarray:
    """Block of each key; ascends with the key."""
    return (((keys >> U64(32)) * U64(n_blocks)) >> U64(32)).astype(np.int64)


def cuts(keys: np.ndarray, n_blocks: int) -> Iterator[tuple[int, int, int]]:
    """(block, begin, end) of each run of sorted keys in one block."""
    if len(keys):
        block = block_of(keys, n_blocks)
        at = np.flatnonzero(np.diff(block, prepend=-1))
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(keys)], strict=True):
            yield int(block[a]), a, b


def row_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    block, kind, body = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(kind, pa.int32()), pa.array(body, pa.binary())], NAMES)


def gathered(rows: DataFrame, n_blocks: int) -> DataFrame:
    """Rows of a block next to each other in one task."""
    return rows.repartition(n_blocks, "block").sortWithinPartitions("block", "kind")


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[bytes]]]]:
    """The bodies of one block by kind, block after block."""
    current: int | None = None
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for block, kind, body in zip(*(batch.column(c).to_pylist() for c in NAMES), strict=True):
            if block != current:
                if current is not None:
                    yield current, held
                current, held = block, {}
            held.setdefault(kind, []).append(body)
    if current is not None:
        yield current, held


def n_blocks_for(n_bytes: int, at_least: int, target: int = 8 << 20) -> int:
    """How many blocks keep each near ``target`` bytes."""
    return max(at_least, -(-n_bytes // target))
