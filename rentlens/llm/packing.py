"""Best-fit packing of documents into token sequences, by hierarchical residual packing.

Every task packs its pieces, longest first, each into the fullest bin that still takes it. Bins that are nearly full are
done; the others become items of their fill for the next round, in a quarter of the tasks, and so on. Where the number of open
bins keeps the tasks from getting fewer, only the emptiest bins go on. Rounds end when no two open bins fit together. A bin
inside a bin is a base offset: places are found by walking up the rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import id_and_text, shuffle_width, stored

CAPACITY = 2048
CLOSED = CAPACITY - 8  # a bin this full takes part in no further round
SHRINK = 4
ITEMS = 200_000  # items of one task of a later round
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
ID_END = 0

_encoders: dict[tuple, object] = {}


def encoder(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()):
    """A text's token ids by a byte-level BPE over a public vocabulary file; strings of ``special`` are one id wherever they
    stand, as added tokens are."""
    key = (ranks_path, pattern, special)
    if key not in _encoders:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[key] = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))
    bpe, strings = _encoders[key], [s for s, _ in special]

    def encode(text: str) -> list[int]:
        # Looking for special strings in every text is slow; few texts have one.
        return bpe.encode(text, allowed_special="all") if any(s in text for s in strings) else bpe.encode_ordinary(text)

    return encode


def pieces_of(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than the capacity."""
    first = n - capacity * (-(-n // capacity) - 1)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _tokenized(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, pattern, special)
        for batch in batches:
            ids, piece, start, length, crc = [], [], [], [], []
            seen: dict[str, list[tuple[int, int, int]]] = {}  # copies of a text in one batch are encoded once
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = seen.get(text)
                if found is None:
                    tokens = np.array([*encode(text), ID_END], "<u4")
                    found = seen[text] = [(s, n, zlib.crc32(tokens[s : s + n].tobytes())) for s, n in pieces_of(len(tokens))]
                ids += [doc] * len(found)
                piece += range(len(found))
                start += [f[0] for f in found]
                length += [f[1] for f in found]
                crc += [f[2] for f in found]
            columns = [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    return run


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin: longest item first, into the fullest bin that takes it."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while a bin with room r is open
    fills: list[int] = []
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += size
        left = room - size
        if left:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def _packed(level: int, capacity: int):
    """Pack the items (item columns, length) of a task: adds bin (unique over all tasks), offset and the bin's fill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        bins, offsets, fills = best_fit(table.column("length").to_numpy(), capacity)
        base = (level << 56) + (TaskContext.get().partitionId() << 28)
        table = table.append_column("bin", pa.array(bins + base)).append_column("at", pa.array(offsets)).append_column("fill", pa.array(fills[bins]))
        yield from table.to_batches(max_chunksize=20_000)

    return run


def packed(pieces: DataFrame, capacity: int = CAPACITY, items: int = ITEMS) -> DataFrame:
    """The rows with sequence_id and offset (both long); ``length`` is their size, 1 to the capacity.

    Other columns travel along. Every sequence is gapless from offset 0 and holds at most ``capacity``; no two sequences that
    are less full than ``CLOSED`` of ``CAPACITY`` fit into one. Repeated rows, and rows without a key, are pieces of their own.
    A missing length, or one outside 1 to the capacity, is a ValueError.
    """
    columns = pieces.columns
    wrong = f"length is null or length < 1 or length > {capacity}"
    n, n_wrong = pieces.agg(F.count("*"), F.count_if(F.expr(wrong))).first()
    if n_wrong:
        raise ValueError(f"{n_wrong} pieces have a length outside 1 to {capacity}")
    tasks = max(1, min(shuffle_width(pieces), -(-n // 5_000)), -(-n // items))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    # Dealt by content, so that a rerun of a task packs the same items.
    dealt = pieces.repartition(tasks, F.xxhash64(*columns)).sortWithinPartitions(*columns)
    placed = stored(dealt.mapInArrow(_packed(0, capacity), f"{schema}, bin long, at long, fill long"), "packing")
    placed = placed.withColumns({"sequence_id": F.col("bin"), "offset": F.col("at")}).drop("at")
    maps: list[DataFrame] = []
    closed = CLOSED * capacity // CAPACITY
    bins = placed.groupBy("bin").agg(F.first("fill").alias("length")).where(F.col("length") < closed)
    level, fullest_half = 1, F.col("length") * 2 > capacity
    while True:
        open_bins, least, half, next_least = bins.agg(
            F.count("*"), F.min("length"), F.count_if(~fullest_half), F.min(F.when(fullest_half, F.col("length")))
        ).first()
        # A pair that fits has a bin up to half full, and two of those always fit.
        if open_bins < 2 or half == 0 or (half == 1 and least + next_least > capacity):
            break
        fewer = max(-(-tasks // SHRINK), -(-open_bins // items))
        chosen, rest = bins, None
        if fewer == tasks and tasks > 1:
            # A task leaves at most one bin up to half full. If such a bin fits with any other, it fits with one of as many
            # next emptier ones, so these few bins in one task decide.
            chosen, fewer = stored(bins.orderBy("length", "bin").limit(2 * half), "bins"), 1
            rest = bins.join(chosen.select("bin"), "bin", "left_anti")
        else:
            tasks = fewer
        dealt = chosen.repartition(fewer, F.xxhash64("bin", F.lit(level))) if fewer > 1 else chosen.repartition(1)
        dealt = dealt.sortWithinPartitions("bin").withColumnRenamed("bin", "item")
        joined = stored(dealt.mapInArrow(_packed(level, capacity), "item long, length long, bin long, at long, fill long"), "packing")
        maps.append(joined.select("item", "bin", "at"))
        bins = joined.groupBy("bin").agg(F.first("fill").alias("length")).where(F.col("length") < closed)
        if rest is not None:
            bins = stored(bins.unionByName(rest), "bins")
        level += 1
    for up in maps:
        placed = placed.join(up.select(F.col("item").alias("sequence_id"), F.col("bin").alias("outer"), "at"), "sequence_id", "left")
        placed = placed.withColumn("sequence_id", F.coalesce("outer", "sequence_id")).withColumn("offset", F.col("offset") + F.coalesce("at", F.lit(0))).drop("outer", "at")
    return placed.select(*columns, "sequence_id", "offset")


def tokenized_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", special: tuple[tuple[str, int], ...] = ()
) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of every row.

    A document is the ids of its text and an end id 0; one longer than the capacity is cut, and only its first piece may be
    shorter. A missing text counts as empty. Rows without a key, or that repeat one, are documents of their own. ``special``
    are strings that count as one token. The encoder's file must be readable on every executor.
    """
    return id_and_text(docs, id_column, text_column).mapInArrow(_tokenized(ranks_path, pattern, special), PIECES)


def packed_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", special: tuple[tuple[str, int], ...] = ()
) -> DataFrame:
    """The pieces of every row with their places: sequence_id and offset."""
    return packed(stored(tokenized_pieces(docs, ranks_path, pattern, id_column, text_column, special), "pieces"))
