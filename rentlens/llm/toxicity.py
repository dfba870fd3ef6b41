"""Convolutional text classifier in numpy, with thresholds calibrated by language.

A word is the sum of three hashed embeddings: of the word and of its first six and four bytes, so that inflected forms
share. Filters of several widths run over the words of the whole text, each keeps its largest response, and a logistic layer
weighs those. Embeddings start from smoothed log-odds of their hash slots over all labelled rows, then all layers are trained
together, by passes in which parts of the rows learn side by side and the parts' nets are averaged.
The text's language is predicted, never read, and only moves the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import mixing
from .frames import stored, whole_text
from .language_id import LanguageModel, decided, fit_languages, fold
from .textblocks import LOWER, U64, blocks, span_hashes, struct_text, text_bytes

SLOTS = 1 << 17
PREFIXES = (None, 6, 4)
WIDTH = 6  # embedding size
SPANS = (1, 2, 3)  # filter widths, in words
FILTERS = 6  # per width
PASSES = 3
BLOCK = 1 << 12  # slots of a table that are put together in one group
DENSE = -1  # the block of all that is not a slot
RANGE_ROWS = 100_000  # distinct logits that one task orders
BATCH = 32
CUT = 0.7  # a score from here on is a positive prediction
LEAST = 20  # positives that a language needs for a threshold of its own

LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = LETTER[0x41:0x5B] = LETTER[0x80:] = True


def word_slots(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots (words x 3) of the letter runs of the texts, and the offsets of each text's words."""
    m = len(offsets) - 1
    if not len(body):
        return np.empty((0, len(PREFIXES)), np.int32), np.zeros(m + 1, np.int64)
    inside = LETTER[body]
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    first, final = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    final[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(final) + 1
    low = LOWER[body]
    out = np.empty((len(starts), len(PREFIXES)), np.int32)
    for k, size in enumerate(PREFIXES):
        hashes = span_hashes(low, starts, ends if size is None else np.minimum(ends, starts + size))
        out[:, k] = (hashes >> U64(64 - 17)).astype(np.int32)
    return out, np.searchsorted(starts, offsets)


@dataclass
class Net:
    tables: np.ndarray  # kind of hash, slot, embedding
    filters: list[np.ndarray]  # per width: (width x embedding) x filters
    filter_bias: list[np.ndarray]
    head: np.ndarray
    bias: np.ndarray

    def dense(self) -> list[np.ndarray]:
        """Layers after the embeddings."""
        return [*self.filters, *self.filter_bias, self.head, self.bias]

    def embedded(self, slots: np.ndarray) -> np.ndarray:
        return sum(self.tables[k][slots[:, k]] for k in range(len(PREFIXES)))

    def pooled(self, slots: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """Largest response of each filter per text (0 at least), and what training needs to find it again."""
        m, width = len(at) - 1, max(SPANS)
        sizes = np.diff(at)
        # Zero words between texts, so that a filter never sees two texts.
        words = np.zeros((len(slots) + width * (m + 1), WIDTH), np.float32)
        place = np.arange(len(slots)) + np.repeat(np.arange(1, m + 1) * width, sizes)
        words[place] = self.embedded(slots)
        begin = at[:-1] + np.arange(1, m + 1) * width
        out, where = [], []
        for k, span in enumerate(SPANS):
            unrolled = np.concatenate([words[j : len(words) - span + 1 + j] for j in range(span)], axis=1)
            response = unrolled @ self.filters[k] + self.filter_bias[k]
            # A text's stretch starts with the first filter place that touches it and ends before the next text's.
            stretch = begin - span + 1
            out.append(np.maximum(np.maximum.reduceat(response, stretch, axis=0), 0))
            where.append((unrolled, response, stretch))
        return np.concatenate(out, axis=1), where

    def logits(self, slots: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.pooled(slots, at)[0] @ self.head + self.bias[0]


def _argmax(response: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Position of the first largest response of each text and filter."""
    ends = [*begin[1:].tolist(), len(response)]
    return np.stack([response[a:b].argmax(axis=0) + a for a, b in zip(begin.tolist(), ends, strict=True)])


def gradients(net: Net, slots: np.ndarray, at: np.ndarray, pull: np.ndarray) -> tuple[list[np.ndarray], dict[int, np.ndarray]]:
    """Slopes of the sum of ``pull`` times logit: of filters, their biases, head and bias, and of the embeddings of single words."""
    pooled, where = net.pooled(slots, at)
    back = pull[:, None] * net.head[None] * (pooled > 0)
    begin = at[:-1] + np.arange(1, len(at)) * max(SPANS)
    at_place: dict[int, np.ndarray] = {}
    filter_slopes, bias_slopes = [], []
    for k, span in enumerate(SPANS):
        unrolled, response, stretch = where[k]
        part = back[:, k * FILTERS : (k + 1) * FILTERS]
        place = _argmax(response, stretch)
        slope = np.zeros_like(net.filters[k])
        for f in range(FILTERS):
            slope[:, f] = part[:, f] @ unrolled[place[:, f]]
        filter_slopes.append(slope)
        bias_slopes.append(part.sum(axis=0))
        # Slopes of the words under each filter's largest response.
        per_word = (part[:, :, None] * net.filters[k].T[None]).reshape(len(at) - 1, FILTERS, span, WIDTH)
        for j in range(span):
            for b, f in zip(*np.nonzero(part), strict=True):
                p = place[b, f] + j
                at_place[p] = at_place.get(p, 0) + per_word[b, f, j]
    words_slope = {}
    for p, slope in at_place.items():
        text = int(np.searchsorted(begin, p, "right")) - 1
        word = int(p) - (text + 1) * max(SPANS)
        if text >= 0 and at[text] <= word < at[text + 1]:
            words_slope[word] = slope
    return [*filter_slopes, *bias_slopes, pooled.T @ pull, np.array([pull.sum()], np.float32)], words_slope


def slot_texts(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    slots, at = word_slots(body, offsets)
    return [slots[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many clean and toxic texts of the task each slot occurs."""
    seen = np.zeros((len(PREFIXES), SLOTS, 2), np.int64)
    for _, texts, toxic in mixing.lessons(batches, slot_texts, "toxic", 256):
        label = np.array(toxic)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        slots = np.concatenate(texts)
        for k in range(len(PREFIXES)):
            once = np.unique(owner * SLOTS + slots[:, k])
            for v in (0, 1):
                found = once[label[once // SLOTS] == v] % SLOTS
                np.add.at(seen[k, :, v], found, 1)
    blocks_seen = seen.reshape(-1, BLOCK * 2)
    yield mixing.batch_of([(b, 0, 0, blocks_seen[b].tobytes()) for b in np.flatnonzero(blocks_seen.any(axis=1)).tolist()])


def _all_seen(block: int, rows: list[tuple[int, bytes]]) -> bytes:
    return sum(np.frombuffer(data, np.int64) for _, data in rows).tobytes()


def first_net(seen: np.ndarray, positives: int, n: int, seed: int = 5) -> Net:
    """The net before training: log-odds of the slots, given the clean and toxic texts (kind, slot, 2) that have them."""
    rng = np.random.default_rng(seed)
    tables = np.zeros((len(PREFIXES), SLOTS, WIDTH), np.float32)
    prior = positives / n
    for k in range(len(PREFIXES)):
        share = (seen[k, :, 1] + 2 * prior) / (seen[k].sum(axis=1) + 2)
        odds = np.log(share / (1 - share)) - np.log(prior / max(1 - prior, 1e-6))
        tables[k, :, 0] = np.clip(odds, -3, 4) / 3
        tables[k, :, 1:] = rng.normal(0, 0.02, (SLOTS, WIDTH - 1))
    filters, filter_bias = [], []
    for span in SPANS:
        f = rng.normal(0, 0.1, (span * WIDTH, FILTERS)).astype(np.float32)
        f[np.arange(span) * WIDTH] += 1.0 / span
        filters.append(f)
        filter_bias.append(np.zeros(FILTERS, np.float32))
    head = np.full(len(SPANS) * FILTERS, 0.3, np.float32)
    return Net(tables, filters, filter_bias, head, np.array([-2.0], np.float32))


class Learner:
    """A copy of a net that learns from small batches and remembers the slots it moved."""

    def __init__(self, net: Net, weight: tuple[float, float]):
        self.net = Net(net.tables.copy(), [f.copy() for f in net.filters], [b.copy() for b in net.filter_bias], net.head.copy(), net.bias.copy())
        self.start, self.weight = net, np.array(weight)  # weight of a clean and of a toxic text
        self.touched = np.zeros(net.tables.shape[:2], bool)
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.net.dense()]
        self.step = self.rows = 0

    def learn(self, texts: list[np.ndarray], toxic: np.ndarray) -> None:
        net = self.net
        self.step += 1
        self.rows += len(texts)
        slots = np.concatenate(texts)
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        logit = net.logits(slots, at)
        pull = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - toxic) * self.weight[toxic] / len(texts)).astype(np.float32)
        slopes, words_slope = gradients(net, slots, at, pull)
        for value, slope, (first, second) in zip(net.dense(), slopes, self.moments, strict=True):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            value -= 0.02 * (first / (1 - 0.9**self.step)) / (np.sqrt(second / (1 - 0.99**self.step)) + 1e-6)
        for word, slope in words_slope.items():
            for k in range(len(PREFIXES)):
                self.touched[k, slots[word, k]] = True
                net.tables[k, slots[word, k]] -= np.float32(0.05) * np.clip(slope, -1, 1).astype(np.float32)

    def moved(self, part: int) -> pa.RecordBatch:
        """Per block the slots that moved and by how much; all other layers as they are now."""
        out = [(DENSE, part, self.rows, np.concatenate([p.ravel() for p in self.net.dense()]).tobytes())]
        places = np.flatnonzero(self.touched.ravel())
        by = (self.net.tables - self.start.tables).reshape(-1, WIDTH)[places]
        cuts = np.searchsorted(places, np.arange(0, self.touched.size + 1, BLOCK)).tolist()
        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if i < j:
                out.append((b, part, self.rows, (places[i:j] % BLOCK).astype(np.int32).tobytes() + by[i:j].tobytes()))
        return mixing.batch_of(out)


def _mixed(block: int, rows: list[tuple[int, bytes]]) -> bytes:
    """The mean over all parts; of a slot, over the parts that moved it."""
    if block == DENSE:
        return mixing.mean_of(rows)
    total, parts = np.zeros((BLOCK, WIDTH)), np.zeros((BLOCK, 1))
    for _, data in rows:
        n = len(data) // (4 + 4 * WIDTH)
        place = np.frombuffer(data, np.int32, n)
        total[place] += np.frombuffer(data, np.float32, n * WIDTH, 4 * n).reshape(n, WIDTH)
        parts[place] += 1
    return (total / np.maximum(parts, 1)).astype(np.float32).tobytes()


def _pass(net_at, weight: tuple[float, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, steps in groupby(mixing.lessons(batches, slot_texts, "toxic", BATCH), lambda lesson: lesson[0]):
            learner = Learner(net_at.value, weight)
            for _, texts, toxic in steps:
                learner.learn(texts, np.array(toxic))
            yield learner.moved(part)

    return run


def trained(rows: DataFrame, positives: int, n: int) -> Net:
    """Learn a net from all ``n`` stored rows (part, lot, text, toxic), ``positives`` of them toxic; both classes weigh alike."""
    seen = np.zeros((len(PREFIXES) * SLOTS // BLOCK, BLOCK * 2), np.int64)
    for b, data in mixing.put_together(rows.mapInArrow(_seen, mixing.MOVED), _all_seen).items():
        seen[b] = np.frombuffer(data, np.int64)
    net = first_net(seen.reshape(len(PREFIXES), SLOTS, 2), positives, n)
    weight = (0.5 * n / (n - positives), 0.5 * n / positives)
    for _ in range(PASSES):
        shared = rows.sparkSession.sparkContext.broadcast(net)
        found = mixing.put_together(rows.mapInArrow(_pass(shared, weight), mixing.MOVED), _mixed)
        shared.unpersist()
        dense = np.frombuffer(found.pop(DENSE), np.float32)
        cuts = np.cumsum([p.size for p in net.dense()])[:-1]
        for value, part in zip(net.dense(), np.split(dense, cuts), strict=True):
            value[...] = part.reshape(value.shape)
        tables = net.tables.reshape(-1, BLOCK, WIDTH)
        for b, data in found.items():
            tables[b] += np.frombuffer(data, np.float32).reshape(BLOCK, WIDTH)
    return net


@dataclass(frozen=True)
class ToxicityModel:
    net: Net | None
    languages: LanguageModel
    thresholds: dict[str, float]  # logit per language; under "" the one of all
    base: float  # score of every text if nothing was learned

    def scores(self, body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.full(len(offsets) - 1, self.base)
        if self.net is None:
            return out
        lang, _, _ = decided(self.languages, body, offsets)
        cut = np.array([self.thresholds.get(x, self.thresholds[""]) for x in lang])
        for i, j in blocks(offsets, 1 << 19):
            slots, at = word_slots(body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            out[i:j] = self.net.logits(slots, at)
        return 1 / (1 + np.exp(-np.clip(out - cut + np.log(CUT / (1 - CUT)), -40, 40)))


def best_threshold(logits: np.ndarray, toxic: np.ndarray) -> float:
    """The logit with the best F1, in the middle of the gap below it."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(hits) + 1) + max(toxic.sum(), 1))
    ends = np.append(np.diff(logits[order]) != 0, True)
    best = int(np.argmax(np.where(ends, f1, -1)))
    low = logits[order[best + 1]] if best + 1 < len(order) else logits[order[best]] - 1
    return float((logits[order[best]] + low) / 2)


def best_thresholds(rows: DataFrame, n: int) -> DataFrame:
    """group, hits and threshold, as ``best_threshold`` finds it, of rows (group, logit, toxic) of any number, about ``n``.

    Distinct logits are dealt by ranges; sums of the ranges give the counts before each, so that no task holds a group.
    """
    counted = rows.groupBy("group", "logit").agg(F.count("*").alias("n"), F.sum("toxic").alias("hits"))
    ranges = counted.repartitionByRange(max(1, -(-n // RANGE_ROWS)), "group", F.desc("logit")).withColumn("range", F.spark_partition_id())
    ranges = stored(ranges, "logits")
    group = Window.partitionBy("group")
    by_range = group.orderBy(F.desc("first"))
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy("group", "range").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max("logit").alias("first"))
    sums = sums.select(
        "group", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.coalesce(F.sum("hits").over(before), F.lit(0)).alias("hits_before"),
        F.sum("hits").over(group).alias("all_hits"), F.lead("first").over(by_range).alias("next_first"),
    )
    inside = Window.partitionBy("group", "range").orderBy(F.desc("logit"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    hits, taken = F.col("hits_before") + F.sum("hits").over(so_far), F.col("n_before") + F.sum("n").over(so_far)
    cuts = ranges.join(F.broadcast(sums), ["group", "range"]).select(
        "group", "all_hits", "logit", (hits / (taken + F.greatest("all_hits", F.lit(1)))).alias("f1"),
        F.coalesce(F.lead("logit").over(inside), "next_first", F.col("logit") - 1).alias("low"),
    )
    best = cuts.groupBy("group").agg(F.max("all_hits").alias("hits"), F.max(F.struct("f1", "logit", "low")).alias("best"))
    return best.select("group", "hits", ((F.col("best.logit") + F.col("best.low")) / 2).alias("threshold"))


def _logits(net_at):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text_bytes(batch.column("text"))
            out = np.zeros(len(offsets) - 1)
            for i, j in blocks(offsets, 1 << 19):
                out[i:j] = net_at.value.logits(*word_slots(body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
            yield pa.RecordBatch.from_arrays([batch.column("lot"), batch.column("lang"), batch.column("toxic"), pa.array(out)], ["lot", "lang", "toxic", "logit"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", broadcast_rows: int = mixing.BROADCAST_ROWS) -> ToxicityModel:
    """Learn from all whole texts of the labelled rows that are not held out.

    A fifth of the keys, the same for every run, is kept from the net and sets the thresholds, unless a class is missing on
    either side. The language model learns from the same side of the split. Labels other than 0 and 1 teach nothing; of
    labels that repeat a key the largest counts. Rows equal in key and text teach once, and a missing text teaches as an
    empty one, but no language. Up to ``broadcast_rows`` labelled keys are sent to the texts, more are joined by shuffle.
    """
    key = F.col(f"`{id_column}`").cast("long")
    open_docs = docs.where(~fold(id_column, 3, 1)).select(key.alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"), F.col(f"`{lang_column}`").alias("lang"))
    known = labels.where(~fold("doc_id", 3, 1) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    languages = fit_languages(open_docs)
    total = sum(counts.values())
    base = counts.get(1, 0) / total if total else 0.0
    if len(counts) < 2:
        return ToxicityModel(None, languages, {"": 0.0}, min(base, CUT - 0.01) if total and counts.get(1, 0) < total else base)
    labelled = mixing.with_labels(open_docs, known, total, broadcast_rows)
    size = labelled(open_docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))).agg(F.count("*").alias("n"), F.sum("size").cast("long").alias("size")).first()
    text = F.coalesce("text", F.lit(""))
    apart = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(5)) == 0
    rows = labelled(open_docs).select(F.xxhash64(F.lit(11), "doc_id", text).alias("lot"), "toxic", "lang", apart.alias("apart"), text.alias("text"))
    rows = mixing.dealt(rows, mixing.parts_for(size["n"], size["size"] or 0), "labelled")
    sides = {(r["apart"], r["toxic"]): r["n"] for r in rows.groupBy("apart", "toxic").agg(F.count_distinct("lot").alias("n")).collect()}
    of = {v: sides.get((True, v), 0) + sides.get((False, v), 0) for v in (0, 1)}
    if not of[0] or not of[1]:
        return ToxicityModel(None, languages, {"": 0.0}, base)
    learned = judged = rows
    if len(sides) == 4:
        learned, judged = rows.where("not apart"), rows.where("apart")
        of = {v: sides[False, v] for v in (0, 1)}
    net = trained(learned.select("part", "lot", "text", "toxic"), of[1], of[0] + of[1])
    shared = docs.sparkSession.sparkContext.broadcast(net)
    logits = judged.select("lot", "lang", "toxic", "text").mapInArrow(_logits(shared), "lot long, lang string, toxic int, logit double").dropDuplicates(["lot"])
    groups = logits.select(F.explode(F.array(F.lit(""), F.nullif("lang", F.lit("")))).alias("group"), "logit", "toxic").where("group is not null")
    found = best_thresholds(groups, 2 * sum(n for (a, _), n in sides.items() if a or len(sides) < 4))
    known_groups = F.col("group").isin("", *languages.languages) & ((F.col("group") == "") | (F.col("hits") >= LEAST))
    thresholds = {r["group"]: r["threshold"] for r in found.where(known_groups).collect()}
    return ToxicityModel(net, languages, thresholds, base)


def _score(model_at, text_column: str | None = None):
    """Score the text of each row, or of the row that it carries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ToxicityModel = model_at.value
        for batch in batches:
            text = batch.column("text") if text_column is None else struct_text(batch.column("row"), text_column)
            scores = model.scores(*text_bytes(text))
            rest = [c for c in batch.schema.names if c != "text"]
            columns = [*(batch.column(c) for c in rest), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "score", "predicted"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row. A missing text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: hash tables and filters
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), fold(id_column, 3, 1).alias("held_out"), whole_text(text_column).alias("text"))
    return rows.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The rows that the model does not call toxic, with the columns they came with."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(_score(shared, text_column), schema).where("predicted = 0").select("row.*")
