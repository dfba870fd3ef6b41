"""Language identification by error-correcting output codes.

Every learned language has a codeword. One binary classifier per bit, over hashed byte n-grams of the text, predicts a
margin for that bit; decoding takes the language whose codeword has the least loss over all bits, each weighted by how well
its classifier did in training. Texts whose two best languages lie close are flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import mixing
from .frames import whole_text
from .textblocks import LOWER, U64, blocks, text_bytes

FEATURES = 4096
ORDERS = (2, 3)
LANGUAGES = 256  # languages that are learned at most, those with the most rows
STEPS = 120  # small batches that a part learns from at least, over all passes
BATCH = 32
PASSES = 20  # at most
CLOSE = 0.1  # loss margin, as a share of the second best loss, under which a text is ambiguous
UNKNOWN = "und"
TEXTS = 256  # texts whose dense features are held at once


def ngram_features(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text the square roots of the shares of its hashed byte n-grams; A-Z lower-cased, one space around the text."""
    m = len(offsets) - 1
    lengths = np.diff(offsets)
    padded = np.full(len(body) + m + 2, 0x20, U64)
    owner = np.repeat(np.arange(m), lengths)
    place = np.arange(len(body)) + owner + 1
    padded[place] = LOWER[body]
    counts = np.zeros(m * FEATURES)
    for order in ORDERS:
        code = np.full(len(body), order, U64)
        for k in range(order):
            code *= U64(257)
            code += padded[place - 1 + k]
        code *= U64(0x9E3779B97F4A7C15)
        slot = (code >> U64(52)).astype(np.int64) % FEATURES
        counts += np.bincount(owner * FEATURES + slot, minlength=m * FEATURES)
    counts = counts.reshape(m, FEATURES)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """Rows of +1 and -1: all distinct splits of up to five languages, for more the widest of seeded random codes."""
    if n < 2:
        return np.ones((n, 0), np.float32)
    if n <= 5:
        rest = [p for p in itertools.product((1, -1), repeat=n - 1) if -1 in p]
        return np.array([[1, *p] for p in rest], np.float32).T
    bits = int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(7)
    best, widest = None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], (n, bits)).astype(np.float32)
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code @ code.T) / 2
        least = apart[~np.eye(n, dtype=bool)].min()
        if least > widest:
            best, widest = code, least
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit's loss

    def losses(self, features: np.ndarray) -> np.ndarray:
        margins = features @ self.weights + self.bias
        loss = np.logaddexp(0, -margins[:, None, :] * self.codes[None])
        return (loss * self.trust).sum(axis=2) / max(self.trust.sum(), 1e-9)

    def decide(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score and whether the text is ambiguous."""
        losses = self.losses(features).astype(float)
        best = losses.argmin(axis=1)
        likely = np.exp(-4 * (losses - losses.min(axis=1, keepdims=True)))
        score = 1 / likely.sum(axis=1)
        if losses.shape[1] < 2:
            return best, score, np.zeros(len(best), bool)
        two = np.partition(losses, 1, axis=1)[:, :2]
        return best, score, two[:, 1] - two[:, 0] < CLOSE * two[:, 1]


def trained(features: np.ndarray, languages: list[str]) -> LanguageModel:
    """Fit one logistic classifier per bit; every language counts alike, however many rows it has."""
    names = sorted(set(languages))
    row = np.array([names.index(x) for x in languages], np.int64)
    codes = codewords(len(names))
    bits = codes.shape[1]
    weights, bias = np.zeros((FEATURES, bits), np.float32), np.zeros(bits, np.float32)
    if not bits:
        return LanguageModel(names, codes, weights, bias, np.ones(0, np.float32))
    share = (1 / np.bincount(row)[row] / len(names)).astype(np.float32)[:, None]
    target = codes[row]
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    for step in range(1, STEPS + 1):
        pull = -target / (1 + np.exp(np.clip(target * (features @ weights + bias), -30, 30))) * share
        for k, (value, slope) in enumerate(((weights, features.T @ pull + 1e-5 * weights), (bias, pull.sum(axis=0)))):
            first, second = state[2 * k], state[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            value -= 0.5 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    right = ((target * (features @ weights + bias) > 0) * share).sum(axis=0)
    return LanguageModel(names, codes, weights, bias, np.maximum(right - 0.5, 0.01).astype(np.float32))


def _feature_list(body: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    return list(ngram_features(body, offsets))


class Learner:
    """Logistic classifiers of all bits that learn from small batches, and how they did on each batch before it taught."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, codes: np.ndarray, step: int):
        self.weights, self.bias, self.codes, self.step = weights.copy(), bias.copy(), codes, step
        self.state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
        self.taken = self.rows = 0
        self.right, self.weight = np.zeros(codes.shape[1]), 0.0

    def learn(self, features: np.ndarray, row: np.ndarray, share: np.ndarray) -> None:
        target, share = self.codes[row], share[:, None].astype(np.float32)
        margin = target * (features @ self.weights + self.bias)
        self.right += ((margin > 0) * share).sum(axis=0)
        self.weight += float(share.sum())
        self.rows += len(row)
        self.taken += 1
        pull = -target / (1 + np.exp(np.clip(margin, -30, 30))) * share / len(row)
        rate = 0.5 / np.sqrt(1 + (self.step + self.taken) / 20)
        for k, (value, slope) in enumerate(((self.weights, features.T @ pull + 1e-5 * self.weights), (self.bias, pull.sum(axis=0)))):
            first, second = self.state[2 * k], self.state[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            value -= rate * (first / (1 - 0.9**self.taken)) / (np.sqrt(second / (1 - 0.99**self.taken)) + 1e-6)

    def moved(self, part: int) -> pa.RecordBatch:
        """A block per bit: weights, bias, weight of the rows that were right and of all, the last two per row."""
        out = []
        for b in range(self.codes.shape[1]):
            rest = np.array([self.bias[b], self.right[b] / self.rows, self.weight / self.rows])
            out.append((b, part, self.rows, np.concatenate([self.weights[:, b], rest]).astype(np.float32).tobytes()))
        return mixing.batch_of(out)


def _pass(model_at, names: list[str], share: np.ndarray, step: int):
    place = {name: k for k, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, steps in groupby(mixing.lessons(batches, _feature_list, "lang", BATCH), lambda lesson: lesson[0]):
            learner = Learner(*model_at.value, step)
            for _, features, langs in steps:
                row = np.array([place[x] for x in langs])
                learner.learn(np.stack(features), row, share[row])
            yield learner.moved(part)

    return run


def fit_languages(rows: DataFrame) -> LanguageModel:
    """Learn from all rows (doc_id, text, lang), whole texts, in parts whose classifiers are averaged.

    Every language counts alike, however many rows it has. Rows without language, key or text do not teach. Rows equal in
    language, key and text teach once. Of more than ``LANGUAGES`` languages the rarest are not learned. Where a part has few
    rows, they are gone through several times. A language that is named ``und`` is learned like others, but a prediction of
    it has score 0.
    """
    known = rows.where("lang is not null and doc_id is not null and text is not null")
    counted = known.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).cast("long").alias("size"))
    counts = {r["lang"]: (r["n"], r["size"]) for r in counted.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    names = sorted(counts)
    codes = codewords(len(names))
    bits = codes.shape[1]
    weights, bias = np.zeros((FEATURES, bits), np.float32), np.zeros(bits, np.float32)
    if not bits:
        return LanguageModel(names, codes, weights, bias, np.ones(0, np.float32))
    n = sum(k for k, _ in counts.values())
    share = np.array([n / len(names) / counts[x][0] for x in names])
    parts = mixing.parts_for(n, sum(size for _, size in counts.values()))
    steps = -(-n // (parts * BATCH))
    passes = max(1, min(PASSES, -(-STEPS // steps)))
    learned = known.where(F.col("lang").isin(*names)).select(F.xxhash64(F.lit(3), "lang", "doc_id", "text").alias("lot"), "lang", "text")
    learned = mixing.dealt(learned, parts, "languages" if passes > 1 else None)
    for k in range(passes):
        shared = rows.sparkSession.sparkContext.broadcast((weights, bias, codes))
        found = mixing.put_together(learned.mapInArrow(_pass(shared, names, share, k * steps), mixing.MOVED), lambda _, moved: mixing.mean_of(moved))
        shared.unpersist()
        whole = np.stack([np.frombuffer(found[b], np.float32) for b in range(bits)], axis=1)
        weights, bias, right = whole[:FEATURES], whole[FEATURES], whole[FEATURES + 1] / whole[FEATURES + 2]
    return LanguageModel(names, codes, weights, bias, np.maximum(right - 0.5, 0.01).astype(np.float32))


def has_letter(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = body | 0x20
    ascii_letters = np.concatenate([[0], np.cumsum((low >= 0x61) & (low <= 0x7A))])
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for k in np.flatnonzero(~found).tolist():
        found[k] = any(c.isalpha() for c in body[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace"))
    return found


def decided(model: LanguageModel, body: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text of a batch."""
    names: list[str] = []
    score, unsure = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1, bool)
    for i, j in blocks(offsets, 1 << 19, TEXTS):
        part, at = body[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if not model.languages:
            names += [UNKNOWN] * (j - i)
            continue
        best, score[i:j], unsure[i:j] = model.decide(ngram_features(part, at))
        names += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has_letter(part, at).tolist(), strict=True)]
    known = np.array([n != UNKNOWN for n in names], bool)
    return names, np.where(known, score, 0.0), unsure & known


def _predict(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, unsure = decided(model, *text_bytes(batch.column("text")))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score), pa.array(unsure)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return run


def fold(id_column: str, folds: int, held: int):
    """Whether a row is held out: crc32 of its key as text, modulo ``folds``. Rows without a key are not."""
    key = F.col(f"`{id_column}`").cast("long").cast("string")
    return F.coalesce(F.pmod(F.crc32(key), F.lit(folds)) == held, F.lit(False))


def predict_languages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every row, by a model of the rows that are not held out.

    A text without any letter, an empty one and a missing one are ``und`` with score 0, as is all if nothing was learned.
    """
    rows = docs.where(~fold(id_column, 4, 2)).select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), F.col(f"`{lang_column}`").alias("lang")
    )
    model = fit_languages(rows)
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), fold(id_column, 4, 2).alias("held_out"), whole_text(text_column).alias("text"))
    return texts.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
