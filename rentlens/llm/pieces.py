"""Encoding and decoding with a SentencePiece BPE model, with seeded merge-dropout.

A word is a run of spaces and what follows it; no piece reaches beyond one. Its symbols start as characters, and the
agenda merges the best-scored neighbours, the leftmost of equals, until none is left. A candidate merge is skipped if the
keyed hash of (seed, document, word position, split) falls under the rate, anew for every occurrence of a word. A
segmentation depends only on the word and on the choices at the splits that its agenda asked for, so a run is kept with
these and serves every other occurrence whose own choices at all of them are the same; others go on to the next run.
Characters outside the vocabulary become their bytes. The agenda runs for all words of a block that need one at once, one
merge per word and round.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import whole_text
from .textblocks import U64, blocks, mix, span_hashes, text_bytes

RATE = 0.1
BLOCK = 1 << 21
LONG = 96  # words of more symbols run through a heap instead of a matrix
SPACE = "▁"
NEVER = np.iinfo(np.int32).max

KNOWN = 800_000  # runs that a worker keeps, about 120 MB
PART = 1 << 16  # occurrences whose choices are compared at once
GOLDEN = U64(0x9E3779B97F4A7C15)

_models: dict[str, "Pieces"] = {}


def gathered(place: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indexes of runs that start at ``place``, one after the other."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(place - before, length)


class Known:
    """Runs of the agenda by state: their ids, and the splits they asked for with the choice as the lowest bit."""

    def __init__(self):
        self.keys, self.ids, self.asked = np.empty(0, U64), np.empty(0, np.int32), np.empty(0, U64)
        self.place, self.length, self.asked_place, self.asked_length = (np.empty(0, np.int64) for _ in range(4))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are known and where."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at

    def add(self, keys: np.ndarray, length: np.ndarray, ids: np.ndarray, asked_length: np.ndarray, asked: np.ndarray) -> None:
        place = len(self.ids) + np.cumsum(length) - length
        asked_place = len(self.asked) + np.cumsum(asked_length) - asked_length
        self.ids, self.asked = np.concatenate([self.ids, ids]), np.concatenate([self.asked, asked])
        merged = np.concatenate([self.keys, keys])
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        self.place, self.length = np.concatenate([self.place, place])[order], np.concatenate([self.length, length])[order]
        self.asked_place = np.concatenate([self.asked_place, asked_place])[order]
        self.asked_length = np.concatenate([self.asked_length, asked_length])[order]


class Pieces:
    """Tables of a model file: characters, merges and the bytes of every piece."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = {s: i for i, s in enumerate(names) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.n = n
        self.character = np.full(0x110000, -1, np.int32)
        for s, i in plain.items():
            if len(s) == 1 and s != SPACE:
                self.character[ord(s)] = i
        self.space = plain[SPACE]
        self.character[0x20] = self.space
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        pairs = [(plain[s[:k]] * n + plain[s[k:]], i) for s, i in plain.items() for k in range(1, len(s)) if s[:k] in plain and s[k:] in plain]
        pairs.sort()
        self._hash_pairs(np.array([p for p, _ in pairs], np.int64), np.array([i for _, i in pairs], np.int32))
        # The best score has the lowest rank.
        scores = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.argsort(np.argsort(-scores, kind="stable"), kind="stable").astype(np.int32)
        content = [s.replace(SPACE, " ").encode() for s in names]
        for b, i in enumerate(self.byte.tolist()):
            content[i] = bytes([b])
        for i in range(n):
            if model.is_control(i) or model.is_unknown(i):
                content[i] = b""
        self.length = np.array([len(c) for c in content], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.content = np.frombuffer(b"".join(content), np.uint8)

        self.known = Known()

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - 21)).astype(np.int64)

    def _hash_pairs(self, keys: np.ndarray, values: np.ndarray) -> None:
        """A table of pairs of pieces by linear probing."""
        self.pair, self.merged, self.probes = np.full((1 << 21) + 64, -1, np.int64), np.full((1 << 21) + 64, -1, np.int32), 0
        slot = self._slot(keys)
        while len(keys):
            free = self.pair[slot] < 0
            chosen = np.flatnonzero(free)[np.unique(slot[free], return_index=True)[1]]
            self.pair[slot[chosen]], self.merged[slot[chosen]] = keys[chosen], values[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, values, slot = keys[rest], values[rest], slot[rest] + 1
            self.probes += 1

    def joins(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two pieces make, or -1."""
        key = a.astype(np.int64) * self.n + b
        key[(a < 0) | (b < 0)] = -2
        slot = self._slot(key)
        out = np.where(self.pair[slot] == key, self.merged[slot], -1)
        for k in range(1, self.probes):
            # Only where another pair sits in the slot before.
            more = np.flatnonzero((out < 0) & (self.pair[slot + k - 1] >= 0))
            if not len(more):
                break
            at = slot[more] + k
            out[more] = np.where(self.pair[at] == key[more], self.merged[at], -1)
        return out


def pieces(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def splits(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """An even hash of a candidate's place in its word."""
    return mix(start.astype(U64) * U64(1 << 42) + middle.astype(U64) * U64(1 << 21) + end.astype(U64) + U64(1)) & ~U64(1)


def skipped(word: np.ndarray, split: np.ndarray, rate: float) -> np.ndarray:
    """The keyed choice for a candidate merge; ``word`` has the seed, the document and the position in it."""
    return mix(word + split) < U64(min(int(rate * 2.0**64), 2**64 - 1)) if rate > 0 else np.zeros(len(split), bool)


def _by_heap(p: Pieces, symbols: np.ndarray, word: np.uint64, rate: float) -> np.ndarray:
    n = len(symbols)
    ids, end, before, after = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
    key = np.array([word], U64)
    agenda: list[tuple[int, int, int, int, int]] = []

    def push(i: int) -> None:
        j = after[i]
        if j < 0:
            return
        joined = int(p.joins(np.array([ids[i]]), np.array([ids[j]]))[0])
        if joined >= 0 and not skipped(key, splits(np.array([i]), np.array([j]), np.array([end[j]])), rate)[0]:
            heapq.heappush(agenda, (int(p.rank[joined]), i, j, end[j], joined))

    alive = [True] * n
    for i in range(n - 1):
        push(i)
    while agenda:
        _, i, j, e, joined = heapq.heappop(agenda)
        if not alive[i] or not alive[j] or after[i] != j or end[j] != e or end[i] != j:
            continue
        ids[i], end[i], after[i], alive[j] = joined, e, after[j], False
        if after[j] >= 0:
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return np.array([ids[i] for i in range(n) if alive[i]], np.int32)


def _by_matrix(p: Pieces, symbols: np.ndarray, sizes: np.ndarray, word: np.ndarray, rate: float, asked: list[tuple[np.ndarray, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Merge all rows (words x symbols, filled up with -2) and return the symbols and sizes that are left.

    ``asked`` takes the rows and the splits of all candidates, with the choice as the lowest bit.
    """
    rows, width = symbols.shape
    done, left = symbols.copy(), sizes.copy()
    if width < 2:
        return done, left
    index = np.arange(rows)
    ids = symbols.copy()
    at = np.broadcast_to(np.arange(width + 1), (rows, width + 1)).copy()

    def candidates(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        joined = p.joins(ids[r, c], ids[r, c + 1])
        rank = np.where(joined >= 0, p.rank[joined], NEVER)
        live = np.flatnonzero(joined >= 0)
        row, column = r[live], c[live]
        split = splits(at[row, column], at[row, column + 1], at[row, np.minimum(column + 2, width)])
        skip = skipped(word[row], split, rate)
        if asked is not None:
            asked.append((index[row], split | skip.astype(U64)))
        rank[live[skip]] = NEVER
        return rank

    r, c = np.divmod(np.arange(rows * (width - 1)), width - 1)
    rank = candidates(r, c).reshape(rows, width - 1)
    columns = np.arange(width)
    while len(index):
        best = rank.argmin(axis=1)
        go = rank[np.arange(len(index)), best] != NEVER
        if not go.all():
            stop = ~go
            done[index[stop], :] = ids[stop]
            left[index[stop]] = sizes[stop]
            index, ids, at, rank, best, sizes, word = (x[go] for x in (index, ids, at, rank, best, sizes, word))
            if not len(index):
                break
        here = np.arange(len(index))
        ids[here, best] = p.joins(ids[here, best], ids[here, best + 1])
        shift = columns[None, :-1] > best[:, None]
        ids[:, :-1] = np.where(shift, ids[:, 1:], ids[:, :-1])
        ids[:, -1] = -2
        move = columns[None] > best[:, None]
        at[:, :-1] = np.where(move, at[:, 1:], at[:, :-1])
        rank[:, :-1] = np.where(shift[:, :-1], rank[:, 1:], rank[:, :-1])
        rank[:, -1] = NEVER
        sizes = sizes - 1
        for column in (best - 1, best):
            ok = np.flatnonzero((column >= 0) & (column + 1 < sizes))
            gone = np.flatnonzero((column >= 0) & (column + 1 >= sizes) & (column < width - 1))
            rank[gone, column[gone]] = NEVER
            if len(ok):
                rank[ok, column[ok]] = candidates(ok, column[ok])
    return done, left


def _runs(p: Pieces, raw: np.ndarray, a: np.ndarray, b: np.ndarray, lead: np.ndarray, word: np.ndarray, rate: np.ndarray) -> tuple[np.ndarray, ...]:
    """Run the agenda for the words a..b of the symbols; the lengths and ids of all, and the lengths and splits they asked for."""
    sizes, n = b - a + lead, len(a)
    place, length, asked_place, asked_length = (np.zeros(n, np.int64) for _ in range(4))
    results, total, told, told_total = [np.empty(0, np.int32)], 0, [np.empty(0, U64)], 0
    low = 0
    for width in (4, 8, 12, 16, 24, 48, LONG, None):
        within = np.flatnonzero((sizes > low) & ((sizes <= width) if width else True))
        low = width or low
        step = 65_536 if width else 1
        for part in (within[i : i + step] for i in range(0, len(within), step)):
            if width:
                columns = np.arange(width)[None] - lead[part][:, None]
                source = np.clip(a[part][:, None] + columns, 0, len(raw) - 1)
                symbols = np.where(np.arange(width)[None] < sizes[part][:, None], np.where(columns < 0, p.space, raw[source]), -2)
                asked: list[tuple[np.ndarray, np.ndarray]] = []
                symbols, left = _by_matrix(p, symbols, sizes[part], word[part], rate[part[0]], asked)
                flat = symbols[np.arange(width)[None] < left[:, None]]
                if asked:
                    rows, split = (np.concatenate(x) for x in zip(*asked, strict=True))
                    told.append(split[np.argsort(rows, kind="stable")])
                    asked_length[part] = np.bincount(rows, minlength=len(part))
                    asked_place[part] = told_total + np.cumsum(asked_length[part]) - asked_length[part]
                    told_total += len(rows)
            else:
                symbols = np.concatenate([[p.space] * int(lead[part[0]]), raw[a[part[0]] : b[part[0]]]]).astype(np.int64)
                flat = _by_heap(p, symbols, word[part[0]], rate[part[0]])
                left = np.array([len(flat)])
            # Characters of no piece become their bytes.
            unknown = np.flatnonzero(flat < 0)
            if len(unknown):
                owner = np.repeat(np.arange(len(left)), left)
                spelled = [chr(-3 - int(x)).encode() for x in flat[unknown]]
                extra = np.array([len(s) for s in spelled])
                repeat = np.ones(len(flat), np.int64)
                repeat[unknown] = extra
                flat, owner = np.repeat(flat, repeat), np.repeat(owner, repeat)
                flat[flat < 0] = p.byte[np.frombuffer(b"".join(spelled), np.uint8)]
                left = np.bincount(owner, minlength=len(left))
            results.append(flat.astype(np.int32))
            place[part], length[part] = total + np.cumsum(left) - left, left
            total += len(flat)
    return length, np.concatenate(results)[gathered(place, length)], asked_length, np.concatenate(told)[gathered(asked_place, asked_length)]


def _differing(known: Known, at: np.ndarray, key: np.ndarray, state: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether the choices of each occurrence differ from those of the run at ``at``, and the state that its own lead to."""
    differs, onward = np.zeros(len(at), bool), state.copy()
    for i in range(0, len(at), PART):
        here = at[i : i + PART]
        length = known.asked_length[here]
        asked = known.asked[gathered(known.asked_place[here], length)]
        owner = np.repeat(np.arange(len(here)), length)
        split = asked & ~U64(1)
        skip = skipped(key[i : i + PART][owner], split, rate)
        differs[i : i + PART][owner[skip != (asked != split)]] = True
        np.add.at(onward[i : i + PART], owner[skip], split[skip])
    return differs, mix(onward + U64(1))


def occurrences(body: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, ...]:
    """Start, end and key of every word of a block, and the offsets of each text's words."""
    space, line = body == 0x20, body == 0x0A
    opens = np.zeros(len(body) + 1, bool)
    opens[1:-1] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    opens[offsets] = True
    starts = np.flatnonzero(opens[:-1])
    word_at = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(word_at))
    # The content keeps apart rows that share a key or have none.
    text = mix(mix(keys + U64(seed) * U64(0x165667B19E3779F9)) + span_hashes(body, offsets[:-1], offsets[1:]))
    key = mix(text[doc] + (np.arange(len(starts)) - word_at[doc]).astype(U64) * GOLDEN)
    return starts, np.append(starts[1:], len(body)), key, word_at


def encoded(p: Pieces, body: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of the texts of a block and the offsets of each text's ids. A text is named by its key and content."""
    if not len(body):
        return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
    starts, ends, key, word_at = occurrences(body, offsets, keys, seed)
    lead = np.zeros(len(starts), bool)
    lead[word_at[:-1][np.diff(word_at) > 0]] = True
    state = mix(span_hashes(body, starts, ends) + lead.astype(U64))
    code = np.frombuffer(body.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    character_at = np.concatenate([[0], np.cumsum(body & 0xC0 != 0x80)])
    a, b = character_at[starts], character_at[ends]
    symbol_of = p.character[code]
    raw = np.where(symbol_of < 0, -3 - code.astype(np.int64), symbol_of)  # a character of no piece keeps its code
    # The first run of a word skips nothing; a long word hardly ever has an equal and runs with its own choices at once.
    rates = np.zeros(len(starts))
    if rate > 0:
        long = b - a + lead > LONG
        rates[long] = rate
        state[long] = mix(key[long] + U64(int(rate * 2.0**32)))
    counts, found = np.zeros(len(starts), np.int64), []
    rest = np.arange(len(starts))
    while len(rest):
        distinct, first, which = np.unique(state[rest], return_index=True, return_inverse=True)
        known, _ = p.known.find(distinct)
        if len(p.known.keys) + np.count_nonzero(~known) > KNOWN:
            p.known = Known()
            known[:] = False
        new = np.flatnonzero(~known)
        if len(new):
            w = rest[first[new]]
            p.known.add(distinct[new], *_runs(p, raw, a[w], b[w], lead[w], key[w], rates[w]))
        at = p.known.find(distinct)[1][which]
        done = np.ones(len(rest), bool)
        if rate > 0:
            differs, state[rest] = _differing(p.known, at, key[rest], state[rest], rate)
            done = ~differs
        counts[rest[done]] = p.known.length[at[done]]
        found.append((rest[done], p.known.ids[gathered(p.known.place[at[done]], p.known.length[at[done]])]))
        rest = rest[~done]
        rates[rest] = rate
    after = np.concatenate([[0], np.cumsum(counts)])
    ids = np.empty(int(after[-1]), np.int32)
    for at, flat in found:
        ids[gathered(after[at], counts[at])] = flat
    return ids, after[word_at]


def decoded(p: Pieces, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts and their offsets; the space that encoding puts before a text is taken off."""
    sizes = p.length[ids]
    after = np.concatenate([[0], np.cumsum(sizes)])
    body = p.content[np.arange(int(after[-1])) + np.repeat(p.start[ids] - after[:-1], sizes)]
    offsets = after[at]
    some = np.diff(at) > 0
    keep = np.ones(len(body), bool)
    keep[offsets[:-1][some]] = False
    return body[keep], offsets - np.concatenate([[0], np.cumsum(some)])


def _batches(path: str, seed: int, rate: float, batches: Iterator[pa.RecordBatch]):
    p = pieces(path)
    for batch in batches:
        body, offsets = text_bytes(batch.column("text"))
        keys = batch.column("doc_id").fill_null(-1).to_numpy().view(np.uint64)
        for i, j in blocks(offsets, BLOCK):
            piece, at = body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            yield p, batch.column("doc_id")[i:j], piece, at, *encoded(p, piece, at, keys[i:j], seed, rate)


def encode(docs: DataFrame, model_path: str, seed: int = 7, rate: float = RATE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row; a rate of 0 gives the model's own segmentation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, doc, _, _, ids, id_at in _batches(model_path, seed, rate, batches):
            yield pa.RecordBatch.from_arrays([doc, pa.ListArray.from_arrays(pa.array(id_at, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return _keyed(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); rows without ids are the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model_path)
        for batch in batches:
            lists = batch.column("ids")
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]).astype(np.int64)
            body, offsets = decoded(p, lists.flatten().to_numpy(), at)
            data = body.tobytes()
            texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str, seed: int = 7, rate: float = RATE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids_crc32, decoded_sha256 and lossless of every row.

    ids_crc32 is unsigned, over the ids as little-endian 32-bit numbers; lossless
    says that decoding gave the text's own bytes. A missing text is an empty one, of no pieces.
    """
    names = ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, doc, body, at, ids, id_at in _batches(model_path, seed, rate, batches):
            back, back_at = decoded(p, ids, id_at)
            raw, own, data = ids.astype("<u4").tobytes(), body.tobytes(), back.tobytes()
            spans = list(zip(id_at[:-1].tolist(), id_at[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), back_at[:-1].tolist(), back_at[1:].tolist(), strict=True))
            columns = [doc, pa.array(np.diff(id_at)), pa.array([zlib.crc32(raw[4 * s[0] : 4 * s[1]]) for s in spans], pa.int64())]
            columns += [pa.array([hashlib.sha256(data[s[4] : s[5]]).hexdigest() for s in spans], pa.string()), pa.array([own[s[2] : s[3]] == data[s[4] : s[5]] for s in spans], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return _keyed(docs, id_column, text_column).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean")


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
