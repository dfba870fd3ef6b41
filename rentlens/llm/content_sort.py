"""Exact deduplication by a content sort.

Rows are dealt into ranges of (first characters of the normalised text, its digest, key) by sampled splitters and sorted;
equal texts become neighbours and are compared in full. A group of copies may span any number of ranges: only the runs that
touch an end of a range are joined up afterwards, and those are two per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import stored, whole_text

HEAD = 48  # characters of the text in the range key; the sampled splitters hold no whole texts
OUT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_sha256", T.StringType()),
        T.StructField("keep_id", T.LongType()),
        T.StructField("group_size", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("is_first", T.BooleanType()),
        T.StructField("at_edge", T.BooleanType()),
    ]
)


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


class _Run:
    """The run of equal texts that is open at the end of a batch; of its rows only the first keeps the carried columns."""

    def __init__(self, sha: str, text: pa.Scalar, at_start: bool):
        self.sha, self.text, self.at_start = sha, text, at_start
        self.ids: list[pa.Array] = []
        self.carried: pa.Array | None = None
        self.size = 0


def _sorted_runs(carry: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = [f.name for f in OUT] + (["row"] if carry else [])
        open_run: _Run | None = None
        first_batch = True

        def closed(runs: list[_Run], at_end: bool) -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays([a for r in runs for a in r.ids])
            sizes = np.array([r.size for r in runs])
            begin = np.cumsum(sizes) - sizes
            of = np.repeat(np.arange(len(runs)), sizes)
            edge = np.array([r.at_start or (at_end and k == len(runs) - 1) for k, r in enumerate(runs)])
            is_first = np.zeros(len(ids), bool)
            is_first[begin] = True
            columns = [ids, pa.array([r.sha for r in runs], pa.string()).take(pa.array(of)), ids.take(pa.array(begin[of])), pa.array(sizes[of])]
            columns += [pa.array(np.full(len(ids), part, np.int32)), pa.array(is_first), pa.array(edge[of])]
            if carry:
                kept = pa.concat_arrays([r.carried for r in runs])
                columns.append(kept.take(pa.array(of, mask=~is_first)))
            yield pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            if not batch.num_rows:
                continue
            text, sha, ids = batch.column("norm"), batch.column("sha"), batch.column("doc_id")
            same = np.zeros(batch.num_rows, bool)
            if batch.num_rows > 1:
                equal = pc.and_(pc.equal(sha[1:], sha[:-1]), pc.equal(text[1:], text[:-1]))
                same[1:] = equal.to_numpy(zero_copy_only=False)
            if open_run is not None and sha[0].as_py() == open_run.sha:
                same[0] = text[0].as_py() == open_run.text.as_py()
            starts = np.flatnonzero(~same)
            done: list[_Run] = []
            bounds = [*starts.tolist(), batch.num_rows]
            if bounds[0] > 0:
                open_run.ids.append(ids[: bounds[0]])
                open_run.size += bounds[0]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if open_run is not None:
                    done.append(open_run)
                open_run = _Run(sha[a].as_py(), text[a], first_batch and a == 0)
                open_run.ids.append(ids[a:b])
                open_run.size = b - a
                if carry:
                    open_run.carried = batch.column("row")[a : a + 1]
            first_batch = False
            if done:
                yield from closed(done, False)
        if open_run is not None:
            yield from closed([open_run], True)

    return run


def content_sort(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row; with ``carry``, ``row`` holds the kept rows.

    Texts are equal when identical after each run of ASCII white space became one space; a missing text counts as empty.
    Of equal texts the row with the smallest key stays; rows without a key come last; of rows that repeat key and text one
    stays. Columns of any other name only travel inside ``row``.
    """
    norm = normalised(whole_text(text_column))
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        norm.alias("norm"),
        F.sha2(norm, 256).alias("sha"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    ).withColumn("head", F.substring("norm", 1, HEAD))
    keys = ["head", "sha", F.col("doc_id").asc_nulls_last()]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions("head", "sha", "norm", F.col("doc_id").asc_nulls_last()).drop("head")
    schema = T.StructType([*OUT.fields, *([T.StructField("row", ranged.schema["row"].dataType)] if carry else [])])
    held = stored(ranged.mapInArrow(_sorted_runs(carry), schema), "content-sort")
    more = ["row"] if carry else []

    inner = held.where("not at_edge").withColumn("kept", F.col("is_first"))
    edges = held.where("at_edge")
    runs = edges.where("is_first").select("part", "text_sha256", F.col("keep_id").alias("least"), F.col("group_size").alias("size"))
    whole = runs.groupBy("text_sha256").agg(F.min("least").alias("keep"), F.sum("size").alias("total"), F.min("part").alias("first_part"))
    # One row per run at an end of a range, so that a group over many ranges meets its total spread over their numbers.
    by_run = runs.select("part", "text_sha256").join(whole, "text_sha256")
    outer = edges.join(by_run, ["part", "text_sha256"]).withColumn("kept", F.col("is_first") & (F.col("part") == F.col("first_part")))
    outer = outer.withColumn("keep_id", F.col("keep")).withColumn("group_size", F.col("total"))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", *more]
    return inner.select(*columns).unionByName(outer.select(*columns))


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with."""
    return content_sort(docs, id_column, text_column, carry=True).where("kept").select("row.*")
