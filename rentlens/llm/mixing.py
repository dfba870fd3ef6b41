"""Models that learn from all rows of a table: parts that learn side by side, and their means.

Rows are dealt into parts of bounded size by a hash of their content and stored in the order of that hash, so that layout and
cores change nothing. In a pass every part starts from the same model, learns from its rows one small batch after the other,
and gives back what it moved, in blocks of the model; a block is put together from all parts by one group. What a group
holds and the model that comes to the driver are of the model's size, not of the table's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import looked_up, stored
from .samples import once
from .textblocks import blocks, text_bytes

PART_ROWS = 8192
PART_BYTES = 32 << 20
BROADCAST_ROWS = 1_000_000  # keys with a label that are sent to every executor at most; more are joined by shuffle
MOVED = "block int, part int, n long, moved binary"


def with_labels(rows: DataFrame, known: DataFrame, n_known: int, broadcast_rows: int = BROADCAST_ROWS) -> Callable[[DataFrame], DataFrame]:
    """A function that joins rows, or other columns of them, with ``known``, which has one row per ``doc_id``."""
    if n_known <= broadcast_rows:
        return lambda part: part.join(F.broadcast(known), "doc_id")
    uses = rows.groupBy("doc_id").agg(F.count("*").alias("_uses"))
    used = stored(known.join(uses, "doc_id"), "labels")
    return lambda part: looked_up(part, used, ["doc_id"], "_uses").drop("_uses")


def parts_for(n: int, size: int) -> int:
    """Parts of about ``PART_ROWS`` rows and ``PART_BYTES`` bytes of text at most."""
    return max(1, -(-n // PART_ROWS), -(-size // PART_BYTES))


def dealt(rows: DataFrame, parts: int, label: str | None = None) -> DataFrame:
    """The rows by ``part`` and ``lot``; rows that share a lot are one row of each task that read them. With a label they are stored."""
    single = rows.mapInArrow(once(lambda batch: batch), rows.schema)
    part = F.pmod("lot", F.lit(parts)).cast("int")
    out = single.withColumn("part", part).repartitionById(parts, "part").sortWithinPartitions("part", "lot")
    return stored(out, label) if label else out


def lessons(batches: Iterator[pa.RecordBatch], work: Callable, target: str, most: int) -> Iterator[tuple[int, list, list]]:
    """Part, worked texts and targets of ``most`` rows of one part at a time, in stored order, whatever the Arrow batches.

    ``work`` turns bytes and offsets of texts into a list with an item per text. A lot that repeats is one row.
    """
    part, lot = None, None
    texts, targets = [], []
    for batch in batches:
        body, offsets = text_bytes(batch.column("text"))
        of, lots, marks = (batch.column(c).to_pylist() for c in ("part", "lot", target))
        for i, j in blocks(offsets, most=256):
            items = work(body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            for k, item in enumerate(items, i):
                if (of[k], lots[k]) == (part, lot):
                    continue
                if texts and (of[k] != part or len(texts) == most):
                    yield part, texts, targets
                    texts, targets = [], []
                part, lot = of[k], lots[k]
                texts.append(item)
                targets.append(marks[k])
    if texts:
        yield part, texts, targets


def batch_of(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    columns = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["block", "part", "n", "moved"])


def put_together(moved: DataFrame, join: Callable[[int, list[tuple[int, bytes]]], bytes]) -> dict[int, bytes]:
    """What ``join`` makes of the (rows, bytes) of a block, in the order of parts, for every block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(np.argsort(table.column("part").to_numpy(), kind="stable"))
        block = table.column("block")[0].as_py()
        done = join(block, list(zip(table.column("n").to_pylist(), table.column("moved").to_pylist(), strict=True)))
        return pa.table({"block": pa.array([block], pa.int32()), "whole": pa.array([done], pa.binary())})

    found = moved.groupBy("block").applyInArrow(run, "block int, whole binary").toArrow()
    return dict(zip(found.column("block").to_pylist(), found.column("whole").to_pylist(), strict=True))


def mean_of(rows: list[tuple[int, bytes]]) -> bytes:
    """Mean of arrays of 32-bit floats, weighted by rows."""
    total = sum(n * np.frombuffer(data, np.float32).astype(float) for n, data in rows)
    return (total / sum(n for n, _ in rows)).astype(np.float32).tobytes()
