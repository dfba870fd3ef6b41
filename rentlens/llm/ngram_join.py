"""Exact Jaccard self-join of documents on word n-grams as a blocked sparse product, and its connected components.

The incidence matrix of documents by n-grams is never multiplied as a whole:

1. Documents of equal n-gram sets form one class; a class is one row of the matrix.
2. Columns are dealt into blocks. Within a block, the counts of columns that another row shares are accumulated; a row
   whose shared columns are fewer than its size requires (overlap >= threshold * size) can be part of no link and goes.
3. The remaining rows are cut into column groups by n-gram hash. Two rows within the size bounds differ in at most K
   n-grams, so of G > K groups at least G - K agree; groups too small to be needed for that are left out. Rows that agree
   on a group form the row blocks of the product.
4. Row blocks are multiplied exactly: overlaps are counted, pairs outside the size bounds or already connected are
   discarded. A row block larger than a task is split; every part meets one common row, and only rows that are not
   connected to it are compared with the other parts.

n-grams are 64-bit hashes. No pair list of a group is ever made; links are a spanning forest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import id_and_text, shuffle_width, stored
from .keyblocks import SCHEMA, cuts, each_block, gathered, n_blocks_for, row_batch
from .textblocks import U64, blocks, distinct_per_text, mix, shingles, text_bytes, words

CELL_NGRAMS = 400_000  # n-grams of one part of a row block
BROADCAST_ROWS = 1_000_000  # id lists up to this length (16 MB) are sent to every executor, longer ones are joined by shuffle
SLICE = 2048  # documents that are combined before they are sent; their index fits 15 bits

DOCUMENT = np.dtype([("doc", "<i8"), ("n", "<i8"), ("high", "<i8"), ("low", "<i8"), ("missing", "<i8")])
LOOKED_AT, POSTINGS, SHARED = 0, 1, 2


def _sets(batch: pa.RecordBatch, n: int, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of the texts i..j-1 of a batch, sorted within each text, and their offsets."""
    body, offsets = text_bytes(batch.column("text").slice(i, j - i))
    values, ends = [], [np.zeros(1, np.int64)]
    for a, b in blocks(offsets):
        hashes, _, word_at = words(body[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        found, at = distinct_per_text(*shingles(hashes, word_at, n))
        values.append(found)
        ends.append(at[1:] + ends[-1][-1])
    return np.concatenate([np.empty(0, U64), *values]), np.concatenate(ends)


def _classes(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """128-bit digests of the n-gram sets; the first half stands for the class in the matrix."""
    raw = values.tobytes()
    digests = b"".join(hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    return np.frombuffer(digests, "<u8").reshape(-1, 2)


def _distinct_rows(high: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of the first row of each class, without rows that have no n-gram."""
    _, first = np.unique(high, return_index=True)
    return np.sort(first[sizes[first] > 0])


def _entries(values: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of the chosen rows, sorted, and the row of each."""
    sizes = np.diff(at)[rows]
    begin = np.cumsum(sizes) - sizes
    source = np.arange(int(sizes.sum())) + np.repeat(at[rows] - begin, sizes)
    keys, owner = values[source], np.repeat(rows, sizes)
    order = np.argsort(keys, kind="stable")
    return keys[order], owner[order]


def _hits(rows: np.ndarray, counts: np.ndarray, width: int) -> list[tuple[int, int, bytes]]:
    """Counts per class, packed for the block of the class."""
    order = np.argsort(rows, kind="stable")
    rows, counts = rows[order], counts[order].astype(U64)
    return [(block, SHARED, np.stack([rows[a:b], counts[a:b]]).tobytes()) for block, a, b in cuts(rows, width)]


def _look(n: int, n_blocks: int, width: int):
    """Documents with size and class, and packed postings of the n-grams of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                j = min(batch.num_rows, i + SLICE)
                values, at = _sets(batch, n, i, j)
                digest, sizes = _classes(values, at), np.diff(at)
                about = np.empty(j - i, DOCUMENT)
                ids = batch.column("doc_id").slice(i, j - i)
                about["doc"], about["missing"] = ids.to_numpy(), batch.column("keyless").slice(i, j - i).to_numpy(zero_copy_only=False)
                about["n"], about["high"], about["low"] = sizes, digest[:, 0].view("<i8"), digest[:, 1].view("<i8")
                out = [(int(digest[0, 1] % np.uint64(n_blocks)), LOOKED_AT, about.tobytes())]
                rows = _distinct_rows(digest[:, 0], sizes)
                keys, owner = _entries(values, at, rows)
                opens = np.ones(len(keys), bool)
                opens[1:] = keys[1:] != keys[:-1]
                alone = opens & np.append(opens[1:], True)
                # An n-gram that several rows of this slice share is counted here and sent once, marked as shared.
                counts = np.bincount(owner[~alone], minlength=j - i)
                hit = np.flatnonzero(counts)
                out += _hits(digest[hit, 0], counts[hit], width)
                keys, owner, marked = keys[opens], owner[opens], ~alone[opens]
                for block, a, b in cuts(keys, n_blocks):
                    present, local = np.unique(owner[a:b], return_inverse=True)
                    packed = (local.astype(np.uint16) | (marked[a:b].astype(np.uint16) << np.uint16(15))).tobytes()
                    head = np.array([len(present), b - a], "<u4").tobytes()
                    out.append((block, POSTINGS, head + digest[present, 0].tobytes() + (keys[a:b] & U64(0xFFFFFFFF)).astype("<u4").tobytes() + packed))
                yield row_batch(out)

    return run


def _count_shared(width: int):
    """Per class, how many n-grams of a block another class has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, kinds in each_block(batches):
            out = [(block, kind, body) for kind in (LOOKED_AT, SHARED) for body in kinds.get(kind, [])]
            keys, owners, marks = [], [], []
            for body in kinds.get(POSTINGS, []):
                n_rows, n_keys = np.frombuffer(body, "<u4", 2).tolist()
                own = np.frombuffer(body, "<u8", n_rows, 8)
                keys.append(np.frombuffer(body, "<u4", n_keys, 8 + 8 * n_rows))
                packed = np.frombuffer(body, "<u2", n_keys, 8 + 8 * n_rows + 4 * n_keys)
                owners.append(own[packed & np.uint16(0x7FFF)])
                marks.append(packed >> np.uint16(15) > 0)
            if keys:
                key, owner, mark = np.concatenate(keys), np.concatenate(owners), np.concatenate(marks)
                order = np.argsort(key, kind="stable")
                key, owner, mark = key[order], owner[order], mark[order]
                begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                shared = (np.minimum.reduceat(owner, begin) != np.maximum.reduceat(owner, begin)) | np.logical_or.reduceat(mark, begin)
                count_in = np.repeat(shared, np.diff(np.append(begin, len(key)))) & ~mark
                rows, counts = np.unique(owner[count_in], return_counts=True)
                out += _hits(rows, counts, width)
            if out:
                yield row_batch(out)

    return run


def _sum_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per class."""
    for _, kinds in each_block(batches):
        rows, counts = np.concatenate([np.frombuffer(b, "<u8").reshape(2, -1) for b in kinds[SHARED]], axis=1)
        distinct, which = np.unique(rows, return_inverse=True)
        total = np.zeros(len(distinct), U64)
        np.add.at(total, which, counts)
        yield pa.RecordBatch.from_arrays([pa.array(distinct.view("<i8")), pa.array(total.view("<i8"))], ["high", "hits"])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for body in batch.column("body").to_pylist():
            d = np.frombuffer(body, DOCUMENT)
            columns = [pa.array(d["doc"], pa.int64(), mask=d["missing"] != 0), *(pa.array(np.ascontiguousarray(d[c])) for c in ("doc", "n", "high", "low"))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "own", "n_shingles", "high", "low"])


def _pairs_of_longs(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body").to_pylist():
                a, b = np.frombuffer(body, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names)

    return run


class Bounds:
    """Which sizes and overlaps can make ``den * |A and B| >= num * |A or B|``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.t = num / den

    def linked(self, overlap, a, b):
        return self.den * overlap >= self.num * (a + b - overlap)

    def most_apart(self, total):
        """Largest symmetric difference of two linked rows of ``total`` n-grams together."""
        return (total * (self.den - self.num)) // (self.den + self.num)

    def windows(self, n: int) -> list[tuple[int, int]]:
        """(window, groups): any two rows that can link are together in one window."""
        step = 1 / self.t**2
        k = max(0, math.floor(math.log(n) / math.log(step) + 1e-9))
        out = []
        for w in (k - 1, k):
            if w < 0:
                continue
            low = step**w
            high = math.floor(low / self.t**3 * (1 + 1e-9)) + 1
            if low <= n * (1 + 1e-9) and n <= high:
                out.append((w, 1 + (3 * self.most_apart(2 * high)) // 2))
        return out


def _signatures(values: np.ndarray, bounds: Bounds) -> np.ndarray:
    """Signatures of the column groups that are enough to meet every possible partner in one of them."""
    n = len(values)
    out = []
    for window, groups in bounds.windows(n):
        most = bounds.most_apart(n + bounds.den * n // bounds.num)
        group = ((values >> U64(20)) % U64(groups)).astype(np.int64)
        sizes = np.bincount(group, minlength=groups)
        # At least groups - most of them agree: the smaller ones, fewer than that, are not needed.
        at_most = np.cumsum(np.bincount(sizes))  # how many groups have up to so many n-grams
        q = int(np.searchsorted(at_most, groups - most, "left"))
        chosen = np.flatnonzero(sizes >= q)
        content = np.zeros(groups, U64)
        np.add.at(content, group, mix(values + U64(0x632BE59BD9B4E019)))
        out.append(mix(content[chosen] + mix(chosen.astype(U64) * U64(1_000_003) + U64(window + 1))))
    return np.concatenate(out)


ENTRIES, EDGES = 0, 1


def _sign(n: int, bounds: Bounds, n_blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                j = min(batch.num_rows, i + SLICE)
                values, at = _sets(batch, n, i, j)
                high = batch.column("high").slice(i, j - i).to_numpy().view(np.uint64)
                signed = [_signatures(values[at[r] : at[r + 1]], bounds) for r in range(j - i)]
                keys, owner = np.concatenate(signed), np.repeat(high, [len(s) for s in signed])
                edges, keys, owner = _stars(keys, owner)
                out = [(block, ENTRIES, np.stack([keys[a:b], owner[a:b]]).tobytes()) for block, a, b in cuts(keys, n_blocks)]
                if edges.shape[1]:
                    out.append((int(edges[0, 0] % U64(n_blocks)), EDGES, edges.tobytes()))
                yield row_batch(out)

    return run


def _stars(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges from the smallest row of each signature to its others, and one entry per signature."""
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    opens = np.ones(len(keys), bool)
    opens[1:] = keys[1:] != keys[:-1]
    hub = owner[np.flatnonzero(opens)][np.cumsum(opens) - 1]
    other = hub != owner
    edges = np.unique(np.stack([hub[other], owner[other]]), axis=1) if other.any() else np.empty((2, 0), U64)
    return edges, keys[opens], owner[opens]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, kinds in each_block(batches):
        out = [(block, EDGES, body) for body in kinds.get(EDGES, [])]
        if ENTRIES in kinds:
            keys, owner = np.concatenate([np.frombuffer(b, "<u8").reshape(2, -1) for b in kinds[ENTRIES]], axis=1)
            edges, _, _ = _stars(keys, owner)
            if edges.shape[1]:
                out.append((block, EDGES, edges.tobytes()))
        if out:
            yield row_batch(out)


def _product(reps: list[int], at: np.ndarray, values: np.ndarray, labels: list[int], left: np.ndarray, bounds: Bounds) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows of different labels of which one is marked ``left``.

    One row after the other is multiplied with the rows that it is not connected to yet and whose sizes allow a link.
    """
    m = len(reps)
    n = np.diff(at)
    _, columns = np.unique(values, return_inverse=True)
    group = np.unique(np.array(labels), return_inverse=True)[1]
    links: list[tuple[int, int]] = []
    inside = np.zeros(int(columns.max()) + 1, bool)
    order = np.argsort(-n, kind="stable")
    for place, h in enumerate(order.tolist()):
        rest = order[place + 1 :]
        rest = rest[(group[rest] != group[h]) & (left[rest] | left[h])]
        rest = rest[bounds.den * n[rest] >= bounds.num * n[h]]
        if not len(rest):
            continue
        sizes = n[rest]
        begin = np.cumsum(sizes) - sizes
        source = np.arange(int(sizes.sum())) + np.repeat(at[rest] - begin, sizes)
        own = columns[at[h] : at[h + 1]]
        inside[own] = True
        overlap = np.add.reduceat(inside[columns[source]], begin, dtype=np.int64)
        inside[own] = False
        for r in rest[bounds.linked(overlap, sizes, n[h])].tolist():
            if group[r] != group[h]:
                links.append((reps[h], reps[r]))
                group[group == group[r]] = group[h]
    return links


def _multiply(n: int, bounds: Bounds):
    """Links within each cell: rows of one cell are next to each other and are read together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []

        def flush():
            rows: dict[tuple, tuple] = {}
            for rep, label, left, values in held:
                key = (rep, values.tobytes())
                rows[key] = (label, left or key in rows and rows[key][1], values)
            reps, sets = [key[0] for key in rows], [row[2] for row in rows.values()]
            at = np.zeros(len(reps) + 1, np.int64)
            np.cumsum([len(s) for s in sets], out=at[1:])
            links = _product(reps, at, np.concatenate(sets), [row[0] for row in rows.values()], np.array([row[1] for row in rows.values()]), bounds)
            u, v = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                piece = batch.slice(i, 512)
                values, at = _sets(piece, n, 0, piece.num_rows)
                for k, (c, rep, label, left) in enumerate(zip(*(piece.column(c).to_pylist() for c in ("cell", "rep", "label", "is_left")), strict=True)):
                    if c != cell:
                        if len(held) > 1:
                            yield flush()
                        cell, held = c, []
                    held.append((rep, label, left, values[at[k] : at[k + 1]].copy()))
        if len(held) > 1:
            yield flush()

    return run


def _with_text(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Text of the chosen rows (rep = doc_id): a checked broadcast of the keys, beyond the bound a join by shuffle."""
    small = chosen.count() <= BROADCAST_ROWS
    return texts.withColumnRenamed("doc_id", "rep").join(F.broadcast(chosen) if small else chosen, "rep")


def ngram_components(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row.

    Words are runs of other than ASCII white space, with A-Z lower-cased; a text of fewer than ``n`` words has its whole
    sequence as one n-gram; one without words has none and links with nothing. Two rows link when ``den`` times their
    common n-grams are at least ``num`` times all of theirs. Rows without a key take part in links but name no component;
    rows that repeat a key count as connected.
    """
    bounds, texts = Bounds(num, den), id_and_text(docs, id_column, text_column)
    # A row without a key goes by a hash of its text; every class of equal sets goes by one of its rows.
    stand_in = F.xxhash64("text", F.lit("keyless"))
    texts = texts.withColumns({"keyless": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", stand_in)})
    width = shuffle_width(docs)
    # About one n-gram of six bytes for every six bytes of text.
    n_bytes, n_keyless = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if("keyless")).first()
    looked = stored(gathered(texts.mapInArrow(_look(n, b := n_blocks_for(n_bytes, width), width), SCHEMA), b).mapInArrow(_count_shared(width), SCHEMA), "rows")
    rows = looked.where(F.col("kind") == LOOKED_AT).select("body").mapInArrow(_documents, "doc_id long, own long, n_shingles long, high long, low long")
    rows = stored(rows, "documents")
    enough = gathered(looked.where(F.col("kind") == SHARED), width).mapInArrow(_sum_hits, "high long, hits long")
    classes = rows.groupBy("high", "low", "n_shingles").agg(F.min("doc_id").alias("least"), F.min("own").alias("own"))
    classes = classes.withColumn("rep", F.coalesce("least", "own")).drop("own")
    alive = stored(
        classes.where("n_shingles > 0").join(enough, "high").where(F.expr(f"hits * {den} >= n_shingles * {num}")).select("rep", "high", "n_shingles"), "alive"
    )
    texts = texts.select("doc_id", "text", "keyless")
    if n_keyless:
        # Copies of a text without a key are one row to look up.
        once = stored(texts.where("keyless").groupBy("doc_id").agg(F.first("text").alias("text")), "keyless")
        texts = texts.where("not keyless").drop("keyless").unionByName(once)
    else:
        texts = texts.drop("keyless")
    signed = _with_text(texts, alive).mapInArrow(_sign(n, bounds, width), SCHEMA)
    edges = gathered(signed, width).mapInArrow(_meet, SCHEMA).where(F.col("kind") == EDGES).select("body")
    near = components(edges.mapInArrow(_pairs_of_longs(["u", "v"]), "u long, v long")).withColumnRenamed("label", "family")
    links = _links(texts, alive.join(near, alive.high == near.node).select("rep", "family", "n_shingles"), n, bounds)
    label = components(links.unionByName(_same_key(rows, classes))).select(F.col("node").alias("rep"), F.col("label").alias("component_id"))
    named = classes.join(label, "rep", "left").withColumn("component_id", F.coalesce("component_id", "rep"))
    if n_keyless:
        smallest = named.groupBy("component_id").agg(F.min("least").alias("smallest"))
        named = named.join(smallest, "component_id").withColumn("component_id", F.col("smallest"))
    named = named.select("high", "low", "n_shingles", "component_id")
    return rows.join(named, ["high", "low", "n_shingles"]).select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _same_key(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of one doc_id, as u and v."""
    held = rows.where("doc_id is not null and n_shingles > 0").select("doc_id", F.struct("high", "low", "n_shingles").alias("class"))
    several = held.groupBy("doc_id").agg(F.min("class").alias("first"), F.max("class").alias("last")).where("first <> last")
    others = stored(several.select("doc_id", "first").join(held, "doc_id").where("class <> first").select("first", "class").distinct(), "same-key")
    name = classes.select(F.struct("high", "low", "n_shingles").alias("class"), "rep")
    first = name.select(F.col("class").alias("first"), F.col("rep").alias("u"))
    return others.join(first, "first").join(name, "class").select("u", F.col("rep").alias("v"))


def _links(texts: DataFrame, members: DataFrame, n: int, bounds: Bounds) -> DataFrame:
    """Links between the members of each family, as u and v."""
    members = stored(members, "members")
    families = members.groupBy("family").agg(F.min("rep").alias("hub"), F.sum("n_shingles").alias("total"), F.count("*").alias("m"))
    parts = F.ceil(F.col("total") / CELL_NGRAMS).cast("int")
    placed = members.join(families.where("m > 1"), "family").withColumn("parts", parts)
    placed = stored(placed.withColumn("part", F.expr("cast(pmod(xxhash64(rep), parts) as int)")), "placed")

    def multiplied(cells: DataFrame, label: str) -> DataFrame:
        rows = _with_text(texts, cells).select("cell", "rep", "label", "is_left", "text")
        held = rows.repartition(shuffle_width(texts), "cell").sortWithinPartitions("cell", "rep")
        return stored(held.mapInArrow(_multiply(n, bounds), "u long, v long"), label)

    home = F.when(F.col("rep") == F.col("hub"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("part"))
    first = placed.select("rep", F.col("rep").alias("label"), F.lit(True).alias("is_left"), "family", F.explode(home).alias("at"))
    first = multiplied(first.select(F.xxhash64("family", "at").alias("cell"), "rep", "label", "is_left"), "links")
    split = placed.where("parts > 1")
    if split.isEmpty():
        return first
    label = components(first).select(F.col("node").alias("rep"), "label")
    now = split.join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    hubs = now.where("rep = hub").select("family", F.col("label").alias("hub_label"))
    now = stored(now.join(hubs, "family").withColumn("apart", F.expr("label <> hub_label")), "apart")
    strays = now.where("apart").groupBy("family").agg(F.ceil(F.sum("n_shingles") / CELL_NGRAMS).cast("int").alias("stray_parts"))
    now = now.join(strays, "family").withColumn("stray_part", F.expr("cast(pmod(xxhash64(rep, 1), stray_parts) as int)"))
    as_stray = now.where("apart").select("rep", "label", F.lit(True).alias("is_left"), "family", F.col("stray_part").alias("i"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"))
    as_other = now.select("rep", "label", F.lit(False).alias("is_left"), "family", F.explode(F.sequence(F.lit(0), F.col("stray_parts") - 1)).alias("i"), F.col("part").alias("j"))
    cells = as_stray.unionByName(as_other).select(F.xxhash64("family", "i", "j").alias("cell"), "rep", "label", "is_left")
    return first.unionByName(multiplied(cells, "more-links"))
