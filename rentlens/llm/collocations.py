"""Phrases whose words occur together more often than their parts let expect.

Counting every n-gram of a corpus would move and hold every n-gram. Instead:

1. Every task sums the n-grams of a stretch of text and sends them, as sorted hashes with counts, to the partition of their
   hash. A partition merges what it gets into one Misra-Gries summary: counters of equal hashes are added; when there are more
   than its capacity, the counter behind the capacity is taken off all of them and those that reach zero go. Its capacity is
   ``FACTOR`` times the partition's mass (the number of n-grams sent to it) over the threshold, rounded up, so in total less
   than ``threshold / FACTOR`` is ever taken off a counter, and a counter plus what was taken off is an upper bound of its
   count: every n-gram that occurs often enough survives, and few others do.
2. The survivors mark a bitmap of a fixed number of bits. A second pass over the texts counts exactly the n-grams whose bit is
   set, by their words; the rest never leave their task. A full bitmap costs time, not correctness.
3. All that follows is joins and groupings of counted phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import looked_up, shuffle_width, stored, whole_text
from .keyblocks import SCHEMA, block_of, each_block, gathered, n_blocks_for, row_batch
from .textblocks import LOWER, U64, blocks, mix, span_hashes, text_bytes

STRETCH = 2 << 20  # bytes of text, and a quarter as many words, that are summed at a time
FACTOR = 2  # times the capacity that the guarantee needs
MAP_BITS = 28  # log2 of the size of the bitmap: 32 MB
TOP_STEP = 16  # groups of candidates that are ranked together in one step of the choice of the best
SUMMARY, WORDS, MAP = 0, 1, 2

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True


def squeezed(values: np.ndarray, kind: str) -> bytes:
    """Whole numbers in a narrow type; those that do not fit follow as longs."""
    most = np.iinfo(kind).max
    wide = np.flatnonzero(values >= most)
    narrow = np.minimum(values, most).astype(kind)
    return np.array([len(wide)], "<u8").tobytes() + values[wide].astype("<u8").tobytes() + narrow.tobytes()


def unsqueezed(body: memoryview, n: int, kind: str) -> tuple[np.ndarray, memoryview]:
    n_wide = int(np.frombuffer(body, "<u8", 1)[0])
    wide = np.frombuffer(body, "<u8", n_wide, 8)
    values = np.frombuffer(body, kind, n, 8 + 8 * n_wide).astype(np.uint64)
    values[values == np.iinfo(kind).max] = wide
    return values, body[8 + 8 * n_wide + n * np.dtype(kind).itemsize :]


def packed_summary(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys with counts: mass, length, raw size, then differences and counts, compressed."""
    raw = squeezed(np.diff(keys, prepend=U64(0)), "<u2") + squeezed(counts, "u1")
    head = np.array([int(counts.sum()), len(keys), len(raw)], "<u8").tobytes()
    return head + pa.Codec("zstd").compress(raw, asbytes=True)


def mass_of(body: bytes) -> int:
    return int(np.frombuffer(body, "<u8", 1)[0])


def unpacked_summary(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    _, n, size = np.frombuffer(body, "<u8", 3).tolist()
    raw = memoryview(pa.Codec("zstd").decompress(body[24:], size, asbytes=True))
    steps, raw = unsqueezed(raw, n, "<u2")
    counts, _ = unsqueezed(raw, n, "u1")
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their counts."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.diff(np.append(at, len(keys))) if counts is None else np.add.reduceat(counts, at)


class MisraGries:
    """A summary of at most ``capacity`` counters; ``taken`` is what was taken off every key at most."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        if len(self.keys) > self.capacity:
            behind = len(self.counts) - self.capacity - 1
            off = int(np.partition(self.counts, behind)[behind])
            self.counts = self.counts - off
            live = self.counts > 0
            self.keys, self.counts, self.taken = self.keys[live], self.counts[live], self.taken + off

    def at_least(self, threshold: int) -> np.ndarray:
        """Keys that may occur so often; all that do are among them."""
        return self.keys[self.counts + self.taken >= threshold]


class Stretch:
    """The words of some texts: bytes, places, hashes, text and piece of each."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray):
        self.body = LOWER[body]
        gap = GAP[body]
        edge = np.zeros(len(body) + 1, bool)
        edge[offsets] = True
        first, final = ~gap, ~gap
        first[1:] &= gap[:-1] | edge[1:-1]
        final[:-1] &= gap[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(final) + 1
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        # Grows at every new piece and every new text.
        self.piece = np.searchsorted(np.flatnonzero(BREAK[body]), self.starts) + self.text
        self.hashes = span_hashes(self.body, self.starts, self.ends)

    def grams(self, n: int, begin: int, end: int, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the n-grams that start at the words ``begin`` to ``end - 1`` and stay within their piece."""
        end = min(end, len(self.starts) - n + 1)
        if end <= begin:
            return np.empty(0, np.int64), np.empty(0, U64)
        run = self.hashes[begin:end].copy()
        for k in range(1, n):
            run *= U64(0xBF58476D1CE4E5B9)
            run += self.hashes[begin + k : end + k]
        fits = self.piece[begin:end] == self.piece[begin + n - 1 : end + n - 1]
        at = np.flatnonzero(fits) + begin
        return at, mix(run[fits] + salt[self.text[at]] + U64(n))

    def phrases(self, at: np.ndarray, n: np.ndarray) -> list[bytes]:
        """The words at the places, each n of them, with one space between."""
        body, starts, ends = self.body.tobytes(), self.starts[at], self.ends[at + n - 1]
        between = np.zeros(len(self.starts), np.int64)
        if len(between) > 1:
            between[1:] = (self.starts[1:] - self.ends[:-1] != 1) | (self.body[self.ends[:-1]] != 0x20)
        odd = np.cumsum(between)
        plain = odd[at + n - 1] == odd[at]
        out = [body[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        for i in np.flatnonzero(~plain).tolist():
            words = range(int(at[i]), int(at[i] + n[i]))
            out[i] = b" ".join(body[self.starts[w] : self.ends[w]] for w in words)
        return out


def _salts(langs: list[str]) -> np.ndarray:
    known: dict[str, int] = {}
    for lang in langs:
        if lang not in known:
            known[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    return np.array([known[lang] for lang in langs], U64)


def _stretches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[Stretch, list[str], np.ndarray]]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        body, offsets = text_bytes(batch.column("text"))
        salts = _salts(langs)
        for i, j in blocks(offsets, size, most=1 << 30):
            yield Stretch(body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), langs[i:j], salts[i:j]


def _parts(stretch: Stretch, salt: np.ndarray, longest: int, most: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """(places, hashes) for each n, over so many words at a time."""
    for begin in range(0, len(stretch.starts), most):
        yield [stretch.grams(n, begin, begin + most, salt) for n in range(1, longest + 1)]


def _summaries(bits: int, n_blocks: int, longest: int, size: int):
    """Sorted n-gram hashes of ``bits`` bits with counts, for the block of the hash, and the number of words by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stretch, langs, salt in _stretches(batches, size):
            rows = []
            n_words = np.bincount(stretch.text, minlength=len(langs))
            by_lang: dict[str, int] = {}
            for lang, n in zip(langs, n_words.tolist(), strict=True):
                by_lang[lang] = by_lang.get(lang, 0) + n
            for parts in _parts(stretch, salt, longest, max(1, size // 4)):
                keys, counts = summed(np.concatenate([h for _, h in parts]) >> U64(64 - bits))
                block = block_of(keys << U64(64 - bits), n_blocks)
                at = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(keys) else []
                ends = [*at[1:].tolist(), len(keys)] if len(keys) else []
                for a, b in zip(list(at), ends, strict=True):
                    rows.append((int(block[a]), SUMMARY, packed_summary(keys[a:b], counts[a:b])))
            home = rows[0][0] if rows else 0
            home = (home + len(stretch.starts)) % n_blocks  # any block will do
            rows += [(home, WORDS, np.array([n], "<i8").tobytes() + lang.encode()) for lang, n in by_lang.items()]
            yield row_batch(rows)

    return run


def _merged(bits: int, threshold: int, map_bits: int):
    """One summary per block; what may reach the threshold marks the block's bytes of the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, kinds in each_block(batches):
            rows = [(block, WORDS, body) for body in kinds.get(WORDS, [])]
            bodies = kinds.get(SUMMARY, [])
            if bodies:
                mass = sum(map(mass_of, bodies))
                summary = MisraGries(FACTOR * (mass // threshold + 1))
                waiting, size = [], 0
                for k, body in enumerate(bodies):
                    waiting.append(unpacked_summary(body))
                    size += len(waiting[-1][0])
                    if size > max(summary.capacity, 200_000) or k == len(bodies) - 1:
                        summary.merge(*(np.concatenate(c) for c in zip(*waiting, strict=True)))
                        waiting, size = [], 0
                places = np.unique(map_place(summary.at_least(threshold), bits, map_bits))
                if len(places):
                    low = int(places[0]) >> 3
                    marks = np.zeros(((int(places[-1]) >> 3) - low + 1) * 8, bool)
                    marks[places.astype(np.int64) - 8 * low] = True
                    raw = np.packbits(marks).tobytes()
                    rows.append((block, MAP, np.array([low, len(raw)], "<u8").tobytes() + pa.Codec("zstd").compress(raw, asbytes=True)))
            if rows:
                yield row_batch(rows)

    return run


def map_place(keys: np.ndarray, bits: int, map_bits: int) -> np.ndarray:
    """The bit of a hash of so many bits; ascends with the hash."""
    return keys >> U64(bits - map_bits) if bits >= map_bits else keys << U64(map_bits - bits)


def _bitmap(marks: DataFrame, map_bits: int) -> bytes:
    """The marks of all blocks in one map of ``2 ** map_bits`` bits, compressed."""
    whole = np.zeros(1 << (map_bits - 3), np.uint8)
    for row in marks.select("body").toLocalIterator():
        low, size = np.frombuffer(row.body, "<u8", 2).tolist()
        whole[low : low + size] |= np.frombuffer(pa.Codec("zstd").decompress(bytes(row.body)[16:], size, asbytes=True), np.uint8)
    return pa.Codec("zstd").compress(whole.tobytes(), asbytes=True)


def _counted(shared, bits: int, longest: int, size: int, map_bits: int):
    """lang, phrase, words and count of the n-grams whose bit is set, summed over a stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(pa.Codec("zstd").decompress(shared.value, 1 << (map_bits - 3), asbytes=True), np.uint8)
        for stretch, langs, salt in _stretches(batches, size):
            names = pa.array(langs, pa.string())
            for parts in _parts(stretch, salt, longest, max(1, size // 4)):
                places, hashes, lengths = [], [], []
                for n, (at, hashed) in enumerate(parts, 1):
                    place = map_place(hashed >> U64(64 - bits), bits, map_bits)
                    marked = (marks[place >> U64(3)] >> (U64(7) - (place & U64(7))).astype(np.uint8)) & 1 > 0
                    places.append(at[marked])
                    hashes.append(hashed[marked])
                    lengths.append(np.full(int(marked.sum()), n, np.int64))
                at, hashed, n = np.concatenate(places), np.concatenate(hashes), np.concatenate(lengths)
                _, first, count = np.unique(hashed, return_index=True, return_counts=True)
                at, n = at[first], n[first]
                for a in range(0, len(at), 50_000):
                    part = slice(a, a + 50_000)
                    phrase = pa.array(stretch.phrases(at[part], n[part]), pa.binary()).cast(pa.string())
                    lang = names.take(pa.array(stretch.text[at[part]]))
                    columns = [lang, phrase, pa.array(n[part].astype(np.int32)), pa.array(count[part].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "c"])

    return run


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = batch.column("body").to_pylist()
        counts = [int(np.frombuffer(b, "<i8", 1)[0]) for b in bodies]
        yield pa.RecordBatch.from_arrays([pa.array([b[8:].decode() for b in bodies], pa.string()), pa.array(counts, pa.int64())], ["lang", "n"])


def frequent_phrases(
    docs: DataFrame, threshold: int = 30, longest: int = 4, text_column: str = "text", lang_column: str = "lang", stretch: int = STRETCH, map_bits: int = MAP_BITS
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, a) of the phrases of 1 to ``longest`` words that occur ``threshold`` times or more in their
    language, and (lang, n) with the number of words of each."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und")).alias("lang"), whole_text(text_column).alias("text"))
    width = shuffle_width(docs)
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(60, max(20, n_bytes.bit_length() + 4))  # wide enough that few of the n-grams share a hash
    n_blocks = n_blocks_for(n_bytes, width)
    summaries = texts.mapInArrow(_summaries(bits, n_blocks, longest, stretch), SCHEMA)
    merged = stored(gathered(summaries, n_blocks).mapInArrow(_merged(bits, threshold, map_bits), SCHEMA), "summaries")
    n_words = merged.where(F.col("kind") == WORDS).select("body").mapInArrow(_word_counts, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(merged.where(F.col("kind") == MAP), map_bits))
    counted = texts.mapInArrow(_counted(shared, bits, longest, stretch, map_bits), "lang string, phrase string, words int, c long")
    phrases = counted.groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.sum("c").alias("a")).where(F.col("a") >= threshold)
    return stored(phrases, "phrases"), n_words


def _sub_phrase(first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def best_per_group(rows: DataFrame, group: str, order: list[Column], key: str, k: int) -> DataFrame:
    """The first ``k`` rows of each group, with ``rank``: groups are dealt into parts by the key, the first rows of a part
    go on, and parts are put together in steps, so no task ranks a whole group."""
    parts = max(1, -(-rows.count() // 50_000))
    while parts > 1:
        part = Window.partitionBy(group, F.pmod(F.xxhash64(key), F.lit(parts))).orderBy(*order)
        rows = stored(rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k).drop("rank"), "best")
        parts //= TOP_STEP
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)


def collocations(
    docs: DataFrame,
    threshold: int = 30,
    longest: int = 4,
    top: int = 2000,
    absorb: int = 80,
    of: int = 100,
    scale: int = 2_000_000,
    text_column: str = "text",
    lang_column: str = "lang",
    stretch: int = STRETCH,
    map_bits: int = MAP_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and these into words at spaces and tabs;
    phrases stay within a piece and count in their language (a missing one is ``und``, a missing text empty). A candidate
    occurs ``threshold`` times or more (a). Cut in two parts that occur l and r times, its score is floor(scale * a /
    (l + r)); the cut with the lowest score counts, of equal ones that with the shortest first part. Candidates inside a
    longer candidate that occurs at least ``absorb / of`` times as often go. Order: score and a descending, then the phrase
    in byte order. Rows count once each, repeated ones too, whatever their keys.
    """
    phrases, n_words = frequent_phrases(docs, threshold, longest, text_column, lang_column, stretch, map_bits)
    candidates = phrases.where("words > 1")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "words", "a", cut)
    sides = F.explode(
        F.array(
            F.struct(F.lit("l").alias("side"), _sub_phrase(F.lit(1), F.col("k")).alias("part")),
            F.struct(F.lit("r").alias("side"), _sub_phrase(F.col("k") + 1, F.col("words") - F.col("k")).alias("part")),
        )
    )
    sides = stored(cuts.select("lang", "phrase", "a", "k", sides.alias("s")).select("lang", "phrase", "a", "k", "s.side", "s.part"), "parts")
    uses = sides.groupBy("lang", "part").agg(F.count("*").alias("uses"))
    known = stored(uses.join(phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")), ["lang", "part"]), "part-counts")
    told = looked_up(sides, known, ["lang", "part"], "uses")
    of_side = lambda s: F.max(F.when(F.col("side") == s, F.col("f"))).alias(s)
    cuts = told.groupBy("lang", "phrase", "k").agg(F.first("a").alias("a"), of_side("l"), of_side("r"))
    # Decimals of 38 digits hold the product; ``div`` of decimals is exact.
    score = F.expr(f"cast(cast(a as decimal(20,0)) * {scale} as decimal(38,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("low"))
    inside = candidates.where("words > 2").select(
        "lang", "a", F.explode(F.expr("flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(split(phrase, ' '), i, n), ' '))))")).alias("phrase")
    )
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").where(
        F.expr(f"longer is null or cast(longer as decimal(20,0)) * {of} < cast(a as decimal(20,0)) * {absorb}")
    )
    left = stored(left.select("lang", "phrase", "a", "low.l", "low.r", "low.score"), "scored")
    best = best_per_group(left, "lang", [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], "phrase", top)
    return best.join(n_words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
