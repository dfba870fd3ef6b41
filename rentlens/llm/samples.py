"""Samples of whole texts for classifiers, bounded in rows and in bytes, whatever repeats.

A lot is a hash of group, key and text. The lots to keep are chosen from small rows without text, one per distinct lot, and
sent back to the texts; of rows that share a lot each task keeps the first, so that a key or a text that a third of all rows
share is one row of the sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP_BYTES = 32 << 20  # text of the sample per group, at most
LONGEST = 1 << 20  # a longer text does not teach; it is judged in full all the same


def drawn(rows: DataFrame, group: str, most: int | Column, seed: int, group_bytes: int = GROUP_BYTES, longest: int = LONGEST, share: Column | None = None) -> DataFrame:
    """The rows of the sample with their ``lot``; rows equal in group, key and text are one draw and all still there.

    ``rows`` has ``doc_id``, ``text`` without nulls and the group; ``most`` bounds the rows of a group, ``group_bytes`` their
    bytes of text. ``share`` of all possible lots, the lowest, take part: with a few times ``most`` over the rows of the group,
    the rows that are ordered grow with the sample and not with the table. The lowest lots are drawn, so any layout and any repetition of rows gives the same sample.
    """
    marked = rows.withColumn("lot", F.xxhash64(F.lit(seed), group, "doc_id", "text"))
    if share is not None:
        marked = marked.where(F.col("lot").cast("double") <= share * float(1 << 64) - float(1 << 63))
    small = marked.where(F.octet_length("text") <= longest).groupBy(group, "lot").agg(F.max(F.octet_length("text")).cast("long").alias("_bytes"))
    order = Window.partitionBy(group).orderBy("lot")
    first = small.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most)
    kept = first.withColumn("_sum", F.sum("_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("_sum") <= group_bytes)
    return marked.join(F.broadcast(kept.select("lot")), "lot")  # at most ``most`` longs a group


def once(work: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """Apply ``work`` to the rows of a task whose lot did not come before; it keeps eight bytes for each lot of its split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = []
            for lot in batch.column("lot").to_pylist():
                fresh.append(lot not in seen)
                seen.add(lot)
            if any(fresh):
                yield work(batch.filter(pa.array(fresh)))

    return run


def gathered(rows: DataFrame) -> pa.Table:
    """One row per lot, in no order, at the driver."""
    return rows.dropDuplicates(["lot"]).toArrow()
