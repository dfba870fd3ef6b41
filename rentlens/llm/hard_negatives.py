"""Hard negatives of anchors, by slots of scores.

A positive allows negatives whose score lies in a window below its own, and the windows of one anchor overlap. The upper
limits of an anchor's windows cut its scores into disjoint slots, so a row is a candidate in one slot only. Every task is a
combiner: it keeps the best few rows of each (anchor, slot). At the end the slots of an anchor are merged from the lowest up:
the best rows of slot j and all below it are what a window that ends at limit j may take, so one descending run of merges
answers all windows.

Anchors are a stated query set. They go in blocks of at most ``BLOCK`` rows, and each block is sent to every executor and
meets all rows, in slices that keep the score matrix small. What a block leaves is appended to one table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.sources.scratch import new_folder

from .frames import shuffle_width, stored

BLOCK = 4096  # anchors that are sent to the executors at a time
CELLS = 1 << 20  # scores that a task holds at a time
LEAST = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max
EXACT = float(1 << 53)
ENTRY = "anchor int, slot int, score long, id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantized(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Keys, labels and, per vector length, the rows of that length with their floor(scale * x).

    Rows with a null or non-finite component belong to no length.
    """
    ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
    vectors = batch.column("vector")
    values = pc.cast(vectors.flatten(), pa.float64())
    x = values.to_numpy(zero_copy_only=False)  # nulls become NaN
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    usable = bad[at[1:]] == bad[at[:-1]]
    by_length = {}
    for n in np.unique(sizes[usable]).tolist():
        rows = np.flatnonzero(usable & (sizes == n))
        by_length[n] = (rows, np.floor(scale * x[at[rows][:, None] + np.arange(n)]))
    return ids, labels, by_length


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact; beyond 64 bits they are cut to the largest long."""
    top = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(a.shape[1], 1)
    if top < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    product = whole(a) @ whole(b).T
    return np.vectorize(lambda v: min(max(v, -MOST), MOST), otypes=[np.int64])(product)


class Combiner:
    """The best ``k`` entries (score, then smaller id) of each group."""

    def __init__(self, groups: int, k: int):
        self.k, self.limit = k, np.full(groups, LEAST)
        self.group, self.score, self.id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        far = score >= self.limit[group]
        if not far.any():
            return
        group = np.concatenate([self.group, group[far]])
        score = np.concatenate([self.score, score[far]])
        ident = np.concatenate([self.id, ident[far]])
        order = np.lexsort((ident, -score, group))
        group, score, ident = group[order], score[order], ident[order]
        opens = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        place = np.arange(len(group)) - np.repeat(opens, np.diff(np.append(opens, len(group))))
        keep = place < self.k
        self.group, self.score, self.id = group[keep], score[keep], ident[keep]
        last = place[keep] == self.k - 1
        self.limit[self.group[last]] = self.score[last]


class Anchors:
    """A block of anchors, and later their positives and slots."""

    def __init__(self, batch: pa.RecordBatch, scale: float):
        self.ids, self.labels, self.by_length = quantized(batch, scale)
        self.n = len(self.ids)

    def set_positives(self, entries: pa.Table, k: int, low: int, of: int) -> None:
        """Positives (anchor, score, id), best first; their upper limits and the lowest score that any window takes."""
        self.positives: list[list[tuple[int, int]]] = [[] for _ in range(self.n)]
        rows = sorted(zip(*(entries.column(c).to_pylist() for c in ("anchor", "score", "id")), strict=True), key=lambda r: (r[0], -r[1], r[2]))
        for anchor, score, ident in rows:
            self.positives[anchor].append((score, ident))
        self.upper = np.full((self.n, k), LEAST)
        self.lowest = np.full(self.n, MOST)
        for i, found in enumerate(self.positives):
            limits = sorted({s for s, _ in found}, reverse=True)
            self.upper[i, : len(limits)] = limits
            self.lowest[i] = min((-(-low * s // of) for s in limits), default=MOST)


def _emit(best: Combiner, slots: int) -> Iterator[pa.RecordBatch]:
    anchor, slot = best.group // slots, best.group % slots
    columns = [pa.array(anchor.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(best.score), pa.array(best.id)]
    for i in range(0, len(anchor), 50_000):
        yield pa.RecordBatch.from_arrays([c.slice(i, 50_000) for c in columns], ["anchor", "slot", "score", "id"])


def _meetings(block: Anchors, batches: Iterator[pa.RecordBatch], scale: float, cells: int):
    """(anchor places, their rows' ids, same label, scores) of all anchors with slices of the rows."""
    step = max(1, cells // max(block.n, 1))
    for batch in batches:
        ids, labels, by_length = quantized(batch, scale)
        for n, (rows, vectors) in by_length.items():
            if n not in block.by_length:
                continue
            anchors, matrix = block.by_length[n]
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                yield anchors, ids[part], block.labels[anchors][:, None] == labels[part][None, :], scores(matrix, vectors[i : i + step])


def _positives(shared, scale: float, k: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Anchors = shared.value
        best = Combiner(block.n, k)
        for anchors, ids, same, score in _meetings(block, batches, scale, cells):
            fits = same & (ids[None, :] != block.ids[anchors][:, None]) & (score >= best.limit[anchors][:, None])
            a, r = np.nonzero(fits)
            best.add(anchors[a], score[a, r], ids[r])
        yield from _emit(best, 1)

    return run


def _negatives(shared, scale: float, k: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Anchors = shared.value
        slots = block.upper.shape[1]
        best = Combiner(block.n * slots, k)
        for anchors, ids, same, score in _meetings(block, batches, scale, cells):
            upper = block.upper[anchors]
            fits = ~same & (score <= upper[:, :1]) & (score >= block.lowest[anchors][:, None]) & (ids[None, :] != block.ids[anchors][:, None])
            a, r = np.nonzero(fits)
            found = score[a, r]
            slot = (upper[a] >= found[:, None]).sum(axis=1) - 1
            best.add(anchors[a] * slots + slot, found, ids[r])
        yield from _emit(best, slots)

    return run


def _gathered(entries: Iterator[pa.RecordBatch], groups: int, slots: int, k: int) -> Combiner:
    best = Combiner(groups * slots, k)
    for batch in entries:
        anchor, slot, score, ident = (batch.column(i).to_numpy() for i in range(4))
        best.add(anchor.astype(np.int64) * slots + slot, score, ident)
    return best


def _best_of(groups: int, k: int):
    """The best entries of each anchor, from those of all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit(_gathered(batches, groups, 1, k), 1)

    return run


def _answers(shared, k: int, low: int, of: int):
    """Merge the slots of each anchor from the lowest up and read every window off the merge at its limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Anchors = shared.value
        slots = block.upper.shape[1]
        held = _gathered(batches, block.n, slots, k)
        merged = Combiner(block.n, k)
        out: list[tuple] = []
        for slot in range(slots - 1, -1, -1):
            here = held.group % slots == slot
            merged.add(held.group[here] // slots, held.score[here], held.id[here])
            present, begin = np.unique(merged.group, return_index=True)
            end = np.append(begin, len(merged.group))[1:]
            for anchor, b, e in zip(present.tolist(), begin.tolist(), end.tolist(), strict=True):
                limit = int(block.upper[anchor, slot])
                best = [(int(s), int(i)) for s, i in zip(merged.score[b:e], merged.id[b:e], strict=True)]
                for score, positive in block.positives[anchor]:
                    if score == limit:
                        hits = [(s, i) for s, i in best if low * score <= of * s]
                        out += [(int(block.ids[anchor]), positive, rank, i, score, s) for rank, (s, i) in enumerate(hits, 1)]
            if len(out) > 20_000:
                yield _rows(out)
                out = []
        yield _rows(out)

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [()] * 6
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in RESULT.split(", ")])


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    id_column: str = "vec_id",
    label_column: str | Column = "label",
    vector_column: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    of: int = 100,
    scale: float = 256.0,
    block: int = BLOCK,
    cells: int = CELLS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``anchor`` tells which rows are anchors. A component x counts as floor(scale * x); scores are inner products of such
    whole numbers, higher ones come first and ties go to the smaller key. An anchor's positives are its best ``positives``
    other rows of the same label; for each, the best ``negatives`` rows of another label with ``low * positive_score <=
    of * negative_score <= of * positive_score`` are returned.

    Rows with a null key, label or vector, or with a null or non-finite component, take no part. A row meets rows of its own
    vector length only (an empty vector scores 0). Rows that repeat a key are rows of their own, but never another row to one
    with that key. An anchor without positives, and a positive without fitting rows, return nothing. Scores beyond 64 bits
    are shown and ordered as the largest long.
    """
    spark = rows.sparkSession
    label = F.col(f"`{label_column}`") if isinstance(label_column, str) else label_column
    known = rows.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), label.cast("long").alias("label"), F.col(f"`{vector_column}`").alias("vector"), anchor.alias("is_anchor")
    ).where("id is not null and label is not null and vector is not null")
    chosen = known.where("is_anchor").drop("is_anchor")
    known = known.drop("is_anchor")
    n_blocks = max(1, -(-chosen.count() // block))
    # Rows are dealt in turn, so that no block holds more than its share whatever the keys are.
    chosen = stored(chosen.repartition(n_blocks).withColumn("block", F.spark_partition_id()), "anchors")
    folder, width = new_folder(spark, "hard-negatives"), shuffle_width(rows)
    spark.createDataFrame([], RESULT).write.parquet(folder)
    for number in range(n_blocks):
        table = chosen.where(F.col("block") == number).select("id", "label", "vector").toArrow().combine_chunks()
        if not table.num_rows:
            continue
        anchors = Anchors(table.to_batches()[0], scale)
        shared = spark.sparkContext.broadcast(anchors)
        found = known.mapInArrow(_positives(shared, scale, positives, cells), ENTRY).repartition(width, "anchor")
        best = found.mapInArrow(_best_of(anchors.n, positives), ENTRY).toArrow()
        anchors.set_positives(best, positives, low, of)
        slotted = spark.sparkContext.broadcast(anchors)
        entries = known.mapInArrow(_negatives(slotted, scale, negatives, cells), ENTRY).repartition(width, "anchor")
        entries.mapInArrow(_answers(slotted, negatives, low, of), RESULT).write.mode("append").parquet(folder)
        shared.destroy()
        slotted.destroy()
    return spark.read.schema(RESULT).parquet(folder)
