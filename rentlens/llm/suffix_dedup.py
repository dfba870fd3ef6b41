"""Repeated byte windows over a whole corpus, by a depth-limited radix sort of suffixes.

Suffixes are ordered only through their first ``WINDOW`` bytes; equal groups are the repeated windows. The sort goes by
most significant digit, and a group of one leaves it at once:

* First digit. Each window is represented by its anchor, the position in it whose next ``DIGIT`` bytes have the smallest
  hash (the first of equals), so windows with equal bytes have equal anchors at equal places. Runs of windows with one
  anchor are one entry: anchors that no other run has are unique and leave; runs that are equal as a whole are repeated as a
  whole; only anchors that meet different runs go on, which happens where a repeated passage ends.
* Second digit. The windows of those runs fall into groups of eight neighbours that share a core of ``WINDOW - 7`` bytes.
  Cores that occur once are unique and leave.
* Third digit. The windows of the others are compared by the seven bytes beside their core, which settles each.

Entries of a batch that are equal are settled in it and sent once. A digit that meets different continuations in one batch
is known to need the next digit: its entries go there at once and only a mark is sent. So a passage in a third of all
documents is a few entries per batch at every digit. Digits are 64-bit hashes of bytes, except the last one, which is
compared as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import shuffle_width, stored, whole_text
from .keyblocks import SCHEMA, cuts, each_block, gathered, n_blocks_for, row_batch
from .textblocks import BASE, BLOCK, INVERSE, U64, mix, powers, text_bytes

WINDOW = 200
REACH = 100  # anchor positions of a window
DIGIT = WINDOW - REACH + 1
NEIGHBOURS = 8
CORE = WINDOW - NEIGHBOURS + 1
BROADCAST_BYTES = 32 << 20  # findings up to this size are sent to every executor, larger ones are joined by shuffle
SLICE = 2048  # documents whose entries are combined before they are sent

RUN = np.dtype([("anchor", "<u8"), ("whole", "<u8"), ("start", "<u4"), ("doc", "<u2"), ("count", "u1"), ("at", "u1")])
PIECE = np.dtype([("core", "<u8"), ("left", "<u8"), ("right", "<u8"), ("core_at", "<u4"), ("doc", "<u2"), ("windows", "u1"), ("known", "u1")])
KEY = np.dtype([("high", "<i8"), ("low", "<i8")])  # a document: the digest of its key and text
WIN = np.dtype([("core", "<u8"), ("sides", "<u8"), ("start", "<u4"), ("doc", "<u4"), ("known", "u1")])
SPAN = np.dtype([("high", "<i8"), ("low", "<i8"), ("start", "<u4"), ("end", "<u4")])
OPEN = np.dtype([("high", "<i8"), ("low", "<i8"), ("start", "<u4"), ("count", "u1"), ("at", "u1")])
ENTRIES, SPANS, OPENS, WINDOWS = 0, 1, 2, 3
KNOWN = np.uint8(0x80)  # in ``at`` of a run: settled as repeated where it came from
SEVERAL = np.uint8(0x80)  # in ``count`` of a run: a mark that its digit goes on, sent beside what went on already
MARK = np.uint8(2)  # the same in ``known`` of a piece


def prefix_hashes(body: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(body) + 1, U64)
    terms = body.astype(U64)
    terms += U64(1)
    terms *= powers(BASE, len(body))
    np.cumsum(terms, out=sums[1:])
    return sums


def hashed(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])


def anchored_runs(body: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor place, anchor hash and hash of the whole run, of every run of windows.

    ``segments`` are the offsets of stretches that no window crosses.
    """
    n = len(body)
    none = np.empty(0, np.int64)
    if n < WINDOW:
        return none, none, none, none.astype(U64), none.astype(U64)
    sums = prefix_hashes(body)
    digit = sums[DIGIT:] - sums[:-DIGIT]
    digit *= powers(INVERSE, len(digit))
    mix(digit)
    place = np.arange(len(digit), dtype=U64)
    least = digit & ~U64(0xFFFFFF)
    least |= place
    for shift in (1, 2, 4, 8, 16, 32):
        least = np.minimum(least[:-shift], least[shift:])
    least = np.minimum(least[: n - WINDOW + 1], least[REACH - 64 : n - WINDOW + 1 + REACH - 64])
    allowed = np.zeros(n + 1, np.int8)
    long = np.diff(segments) >= WINDOW
    np.add.at(allowed, segments[:-1][long], 1)
    np.add.at(allowed, segments[1:][long] - WINDOW + 1, -1)
    window = np.flatnonzero(np.cumsum(allowed[: n - WINDOW + 1]))
    if not len(window):
        return none, none, none, none.astype(U64), none.astype(U64)
    anchor = (least[window] & U64(0xFFFFFF)).astype(np.int64)
    opens = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    first, count = window[opens], np.diff(np.append(opens, len(window)))
    anchor = anchor[opens]
    whole = hashed(sums, first, first + count - 1 + WINDOW)
    whole = mix(whole + (anchor - first).astype(U64))
    # The hash of an anchor is the least of many, so it is spread anew before blocks are cut by it.
    return first, count, anchor, mix(digit[anchor]), whole


def stretches(offsets: np.ndarray, limit: int = BLOCK // 4) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, begin, end) of stretches of bytes, in groups of about ``limit`` bytes, that cover every window once."""
    doc, begin, end, size = [], [], [], 0
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for p in range(a, max(b - WINDOW + 1, a + 1), limit):
            q = min(b, p + limit + WINDOW - 1)
            if size + q - p > 2 * limit and doc:
                yield np.array(doc), np.array(begin), np.array(end)
                doc, begin, end, size = [], [], [], 0
            doc.append(k)
            begin.append(p)
            end.append(q)
            size += q - p
    if doc:
        yield np.array(doc), np.array(begin), np.array(end)


def merged(found: np.ndarray) -> np.ndarray:
    """Spans with those of one document that overlap or touch put together."""
    if len(found) < 2:
        return found
    found = found[np.lexsort((found["start"], found["low"], found["high"]))]
    number = np.zeros(len(found), np.int64)
    number[1:] = np.cumsum((found["high"][1:] != found["high"][:-1]) | (found["low"][1:] != found["low"][:-1]))
    # Ends reach on within a document: a running maximum that starts anew with each.
    reach = np.maximum.accumulate(found["end"].astype(np.int64) + (number << 33)) - (number << 33)
    opens = np.append(True, (number[1:] != number[:-1]) | (found["start"][1:] > reach[:-1]))
    out = found[opens].copy()
    out["end"] = reach[np.append(np.flatnonzero(opens)[1:] - 1, len(found) - 1)]
    return out


def by_document(kind: int, found: np.ndarray, n_blocks: int) -> list[tuple[int, int, bytes]]:
    """Findings, packed for the block of their document."""
    if not len(found):
        return []
    key = mix(found["high"].astype(U64) ^ found["low"].astype(U64))
    order = np.argsort(key, kind="stable")
    return [(block, kind, found[order[a:b]].tobytes()) for block, a, b in cuts(key[order], n_blocks)]


def spans_of(docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(docs), SPAN)
    out["high"], out["low"], out["start"], out["end"] = docs["high"], docs["low"], start, end
    return merged(out)


def neighbours(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted columns: whether a row opens a group of equal rows, and whether its group has other rows."""
    opens = np.ones(len(columns[0]) + 1, bool)
    opens[1:-1] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return opens[:-1], ~(opens[:-1] & opens[1:])


def opened(docs: np.ndarray, runs: np.ndarray) -> np.ndarray:
    out = np.empty(len(runs), OPEN)
    out["high"], out["low"], out["start"] = docs["high"], docs["low"], runs["start"]
    out["count"], out["at"] = runs["count"] & ~SEVERAL, runs["at"] & ~KNOWN
    return out


def packed_entries(keys: np.ndarray, entries: np.ndarray, docs: np.ndarray, n_blocks: int, kind: int = ENTRIES) -> list[tuple[int, int, bytes]]:
    """Entries sorted by key, cut into blocks; each block names the documents it speaks of."""
    out = []
    for block, a, b in cuts(keys, n_blocks):
        part = entries[a:b].copy()
        present, part["doc"] = np.unique(part["doc"], return_inverse=True)
        out.append((block, kind, np.array([len(present)], "<u4").tobytes() + docs[present].tobytes() + part.tobytes()))
    return out


def unpacked_entries(bodies: list[bytes], kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    entries, docs = [], []
    for body in bodies:
        m = int(np.frombuffer(body, "<u4", 1)[0])
        part = np.frombuffer(body, kind, offset=4 + m * KEY.itemsize)
        entries.append(part)
        docs.append(np.frombuffer(body, KEY, m, 4)[part["doc"]])
    return np.concatenate(entries), np.concatenate(docs)


def _keys(batch: pa.RecordBatch, i: int, j: int) -> np.ndarray:
    docs = np.empty(j - i, KEY)
    docs["high"], docs["low"] = batch.column("high")[i:j].to_numpy(), batch.column("low")[i:j].to_numpy()
    return docs


def _first_digit(n_blocks: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                j = min(batch.num_rows, i + SLICE)
                docs = _keys(batch, i, j)
                body, offsets = text_bytes(batch.column("text")[i:j])
                parts = []
                for doc, begin, end in stretches(offsets):
                    at = np.concatenate([[0], np.cumsum(end - begin)])
                    # Stretches of whole neighbouring texts are one slice; overlapping ones are copied.
                    whole = end[-1] - begin[0] == at[-1]
                    piece = body[begin[0] : end[-1]] if whole else np.concatenate([body[a:b] for a, b in zip(begin, end, strict=True)])
                    first, count, anchor, digit, whole_run = anchored_runs(piece, at)
                    of = np.searchsorted(at, first, "right") - 1
                    entry = np.empty(len(first), RUN)
                    entry["anchor"], entry["whole"], entry["count"], entry["at"] = digit, whole_run, count, anchor - first
                    entry["doc"], entry["start"] = doc[of], first - at[of] + begin[of] - offsets[doc[of]]
                    parts.append(entry)
                entry = np.concatenate(parts) if parts else np.empty(0, RUN)
                entry = entry[np.lexsort((entry["whole"], entry["anchor"]))]
                opens, twin = neighbours(entry["anchor"], entry["whole"])
                again = entry[twin]
                found = spans_of(docs[again["doc"]], again["start"], again["start"] + again["count"] - 1 + WINDOW)
                entry["at"] |= np.where(twin, KNOWN, np.uint8(0))
                entry = entry[opens]
                opens, several = neighbours(entry["anchor"])
                on = entry[several]
                entry["count"] |= np.where(several, SEVERAL, np.uint8(0))
                entry = entry[opens]
                rows = [*by_document(SPANS, found, width), *by_document(OPENS, opened(docs[on["doc"]], on), width)]
                yield row_batch([*rows, *packed_entries(entry["anchor"], entry, docs, n_blocks)])

    return run


def _settle_runs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, kinds in each_block(batches):
            out = [(block, kind, body) for kind in (SPANS, OPENS) for body in kinds.get(kind, [])]
            if ENTRIES in kinds:
                entry, docs = unpacked_entries(kinds[ENTRIES], RUN)
                order = np.lexsort((entry["whole"], entry["anchor"]))
                entry, docs = entry[order], docs[order]
                new_anchor, _ = neighbours(entry["anchor"])
                new_run, twin = neighbours(entry["anchor"], entry["whole"])
                at = np.flatnonzero(new_run)
                mark, known = entry["count"] & SEVERAL > 0, entry["at"] & KNOWN > 0
                sizes = np.diff(np.append(at, len(entry)))
                repeated = twin[at] | np.logical_or.reduceat(known, at)
                fresh = np.repeat(repeated, sizes) & ~known
                end = entry["start"] + (entry["count"] & ~SEVERAL).astype(np.uint32) - 1 + WINDOW
                out += by_document(SPANS, spans_of(docs[fresh], entry["start"][fresh], end[fresh]), width)
                # Anchors with several runs, of which one at least is not settled: one of each run goes on.
                anchor_at = np.flatnonzero(new_anchor[at])
                runs = np.diff(np.append(anchor_at, len(at)))
                marked = np.logical_or.reduceat(np.logical_or.reduceat(mark, at), anchor_at)
                go = np.repeat(marked | (runs > 1) & np.logical_or.reduceat(~repeated, anchor_at), runs)
                rest = at[go & ~mark[at]]
                out += by_document(OPENS, opened(docs[rest], entry[rest]), width)
            if out:
                yield row_batch(out)

    return run


def pieces(body: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The groups of eight neighbouring windows of the given runs of one text."""
    anchor = runs["start"].astype(np.int64) + runs["at"]
    low, high = runs["at"].astype(np.int64) - runs["count"] + 1, runs["at"].astype(np.int64)
    first, last = low // NEIGHBOURS, high // NEIGHBOURS
    count = last - first + 1
    of = np.repeat(np.arange(len(runs)), count)
    number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + first[of]
    core_at = anchor[of] - NEIGHBOURS * number
    out = np.zeros(len(of), PIECE)
    out["core_at"] = core_at
    sums = prefix_hashes(body) if len(body) <= 4 * BLOCK else None
    if sums is not None:
        core = hashed(sums, core_at, core_at + CORE)
    else:
        core = np.concatenate([hashed(prefix_hashes(body[c : c + CORE]), np.array([0]), np.array([CORE])) for c in core_at.tolist()])
    out["core"] = mix(core + number.astype(U64))
    for t in range(NEIGHBOURS - 1):
        before, after = core_at - 1 - t, core_at + CORE + t
        out["left"] |= np.where(before >= 0, body[np.maximum(before, 0)], 0).astype(U64) << U64(8 * t)
        out["right"] |= np.where(after < len(body), body[np.minimum(after, len(body) - 1)], 0).astype(U64) << U64(8 * t)
    for i in range(NEIGHBOURS):
        behind = NEIGHBOURS * number + i  # how far the window starts before the anchor
        out["windows"] |= np.where((behind >= low[of]) & (behind <= high[of]), np.uint8(1 << i), np.uint8(0))
    return out


def _second_digit(n_blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                j = min(batch.num_rows, i + SLICE)
                docs = _keys(batch, i, j)
                body, offsets = text_bytes(batch.column("text")[i:j])
                parts = []
                for k, runs in enumerate(batch.column("found")[i:j].to_pylist()):
                    part = pieces(body[offsets[k] : offsets[k + 1]], np.frombuffer(runs, OPEN))
                    part["doc"] = k
                    parts.append(part)
                entry = np.concatenate(parts)
                entry = entry[np.lexsort((entry["windows"], entry["right"], entry["left"], entry["core"]))]
                opens, twin = neighbours(entry["core"], entry["left"], entry["right"], entry["windows"])
                again = windows_of(entry[twin])
                found = spans_of(docs[again["doc"]], again["start"], again["start"] + WINDOW)
                entry["known"] = twin
                entry = entry[opens]
                opens, several = neighbours(entry["core"])
                rows = [*by_document(SPANS, found, n_blocks), *settled_windows(windows_of(entry[several]), docs, n_blocks)]
                entry["known"] |= np.where(several, MARK, np.uint8(0))
                entry = entry[opens]
                yield row_batch([*rows, *packed_entries(entry["core"], entry, docs, n_blocks)])

    return run


def windows_of(entry: np.ndarray) -> np.ndarray:
    """The windows of pieces, each with its core and the seven bytes beside it."""
    out = []
    for i in range(NEIGHBOURS):
        # Window i has the i bytes before its core and the 7 - i after it; the eighth byte tells the windows apart.
        here = entry[(entry["windows"] >> np.uint8(i)) & 1 > 0]
        part = np.empty(len(here), WIN)
        part["core"], part["doc"], part["known"], part["start"] = here["core"], here["doc"], here["known"] & 1, here["core_at"].astype(np.int64) - i
        sides = (here["left"] & U64((1 << 8 * i) - 1)) | ((here["right"] & U64((1 << 8 * (7 - i)) - 1)) << U64(8 * i))
        part["sides"] = sides | U64(i << 56)
        out.append(part)
    return np.concatenate(out)


def settled_windows(windows: np.ndarray, docs: np.ndarray, n_blocks: int, last: bool = False) -> list[tuple[int, int, bytes]]:
    """Spans of the windows that occur here more than once, and one entry of each window for its block."""
    windows = windows[np.lexsort((windows["sides"], windows["core"]))]
    opens, twin = neighbours(windows["core"], windows["sides"])
    if len(windows):
        at = np.flatnonzero(opens)
        known = np.repeat(np.logical_or.reduceat(windows["known"] > 0, at), np.diff(np.append(at, len(windows))))
        again = windows[(twin | known) & (windows["known"] == 0)]
        out = by_document(SPANS, spans_of(docs[again["doc"]], again["start"], again["start"] + WINDOW), n_blocks)
        if last:
            return out
        windows["known"] = twin | known
        windows = windows[opens]
        keys = mix(windows["core"] + mix(windows["sides"].copy()))
        order = np.argsort(keys, kind="stable")
        return [*out, *packed_entries(keys[order], windows[order], docs, n_blocks, WINDOWS)]
    return []


def _meet_cores(n_blocks: int):
    """Pieces whose core occurs once leave; of the others the windows go on to the blocks of their content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, kinds in each_block(batches):
            out = [(block, kind, body) for kind in (SPANS, WINDOWS) for body in kinds.get(kind, [])]
            if ENTRIES in kinds:
                entry, docs = unpacked_entries(kinds[ENTRIES], PIECE)
                order = np.argsort(entry["core"], kind="stable")
                entry, docs = entry[order], docs[order]
                at = np.flatnonzero(neighbours(entry["core"])[0])
                sizes = np.diff(np.append(at, len(entry)))
                mark = entry["known"] & MARK > 0
                go = np.repeat((sizes > 1) | np.logical_or.reduceat(mark, at), sizes) & ~mark
                entry, docs = entry[go], docs[go]
                wide = np.empty(len(entry), [*((n, PIECE[n]) for n in PIECE.names if n != "doc"), ("doc", "<u4")])
                for name in PIECE.names:
                    wide[name] = entry[name]
                wide["doc"] = np.arange(len(entry))
                out += settled_windows(windows_of(wide), docs, n_blocks)
            if out:
                yield row_batch(out)

    return run


def _settle_windows(n_blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, kinds in each_block(batches):
            out = [(block, SPANS, body) for body in kinds.get(SPANS, [])]
            if WINDOWS in kinds:
                windows, docs = unpacked_entries(kinds[WINDOWS], WIN)
                windows["doc"] = np.arange(len(windows))
                out += settled_windows(windows, docs, n_blocks, last=True)
            if out:
                yield row_batch(out)

    return run


def _per_document(kind: np.dtype):
    """One row per document: its findings, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kinds in each_block(batches):
            found = np.concatenate([np.frombuffer(b, kind) for bodies in kinds.values() for b in bodies])
            found = merged(found) if kind is SPAN else found[np.lexsort((found["low"], found["high"]))]
            new = np.append(True, (found["high"][1:] != found["high"][:-1]) | (found["low"][1:] != found["low"][:-1]))
            at = np.flatnonzero(new)
            bodies = [found[a:b].tobytes() for a, b in zip(at.tolist(), [*at[1:].tolist(), len(found)], strict=True)]
            columns = [pa.array(np.ascontiguousarray(found["high"][at])), pa.array(np.ascontiguousarray(found["low"][at])), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["high", "low", "found"])

    return run


def _to_documents(rows: DataFrame, kind: int, width: int) -> DataFrame:
    per_row = _per_document(SPAN if kind == SPANS else OPEN)
    picked = rows.where(F.col("kind") == kind)
    return stored(gathered(picked, width).mapInArrow(per_row, "high long, low long, found binary"), "findings")


def _joined(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Texts with their findings; the findings are sent to every executor if their measured size allows."""
    size = found.agg(F.sum(F.octet_length("found") + 40)).first()[0] or 0
    return texts.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, ["high", "low"], how)


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """high and low (its mark) and found (packed spans) of every document with bytes in a window that starts anywhere else too."""
    texts = _texts(docs, id_column, text_column)
    width = shuffle_width(docs)
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # An entry of 24 bytes for about every 50 bytes of text.
    b = n_blocks_for(n_bytes // 2, width)
    runs = stored(gathered(texts.mapInArrow(_first_digit(b, width), SCHEMA), b).mapInArrow(_settle_runs(width), SCHEMA), "runs")
    opens = _to_documents(runs, OPENS, width)
    again = gathered(_joined(texts, opens, "inner").select("high", "low", "text", "found").mapInArrow(_second_digit(width), SCHEMA), width)
    apart = gathered(again.mapInArrow(_meet_cores(width), SCHEMA), width)
    windows = stored(apart.mapInArrow(_settle_windows(width), SCHEMA), "windows")
    return _to_documents(runs.where(F.col("kind") == SPANS).unionByName(windows), SPANS, width)


def _texts(docs: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    """The two halves of a row's mark, its key, and its text or ``more`` instead.

    The mark is a digest of key and text: only rows that are equal in both, whose findings are the same, share one.
    """
    text, key = whole_text(text_column), F.col(f"`{id_column}`").cast("long")
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), text))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    return docs.select(half(1).alias("high"), half(17).alias("low"), key.alias("doc_id"), *(more or [text.alias("text")]))


def _without(body: bytes, found: bytes | None) -> tuple[list[tuple[int, int]], bytes]:
    spans = [(int(s["start"]), int(s["end"])) for s in np.frombuffer(found, SPAN)] if found else []
    kept, at = [], 0
    for a, b in spans:
        kept.append(body[at:a])
        at = b
    return spans, b"".join([*kept, body[at:]])


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        rows = []
        for key, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("found").to_pylist(), strict=True):
            body = text.as_py().encode()
            spans, kept = _without(body, found)
            rows.append((key, len(body), len(body) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())], names)


def repeated_windows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Removed is each byte of the text (UTF-8; a missing text is empty) under a string of ``WINDOW`` bytes that also starts
    anywhere else, in the same text or another. Texts of fewer bytes keep all. Rows that repeat key and text are copies of
    each other like any two; rows without a key, or with one that other texts have too, are judged by their own text.
    """
    found = repeated_spans(docs, id_column, text_column)
    out = _joined(_texts(docs, id_column, text_column), found, "left").select("doc_id", "text", "found")
    return out.mapInArrow(_report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _whole_characters(text: str, found: bytes | None) -> str:
    """The text without its spans, each shrunk to the characters that lie in it as a whole."""
    if not found:
        return text
    body = text.encode()
    kept, at = [], 0
    for s in np.frombuffer(found, SPAN):
        a, b = int(s["start"]), int(s["end"])
        while a < b and body[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(body) and body[b] & 0xC0 == 0x80:
            b -= 1
        kept.append(body[at:a])
        at = b
    return b"".join([*kept, body[at:]]).decode()


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rest of each row beside its new text; the old text does not travel back."""
    for whole in batches:
        for i in range(0, whole.num_rows, SLICE):
            batch = whole.slice(i, SLICE)
            pairs = zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True)
            texts = [None if t is None else _whole_characters(t, f) for t, f in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.string())], ["rest", "kept"])


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", edit: Callable[[Column], dict[str, Column]] | None = None) -> DataFrame:
    """All rows, with the repeated windows taken out of their texts; ``edit`` names columns that follow from the new text.

    A character of several bytes goes only if all of it is repeated. A missing text stays missing.
    """
    found = repeated_spans(docs, id_column, text_column)
    # The mark keeps the rest a row where a table has no other column.
    rest = F.struct(F.lit(0).alias("-"), *[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("rest")
    raw = F.col(f"`{text_column}`").cast("string").alias("text")
    joined = _joined(_texts(docs, id_column, text_column, rest, raw), found, "left").select("rest", "text", "found")
    done = joined.mapInArrow(_rewritten, T.StructType([joined.schema["rest"], T.StructField("kept", T.StringType())]))
    changed = {text_column: F.col("kept"), **(edit(F.col("kept")) if edit else {})}
    return done.select(*[changed.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
