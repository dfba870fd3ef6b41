"""Models learn from all rows: no row is left out, and layout, joins and parts change nothing."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from rentlens.llm import mixing, toxicity
from rentlens.llm.language_id import decided, fit_languages
from rentlens.llm.textblocks import joined
from rentlens.llm.toxicity import best_threshold, best_thresholds, first_net, fit_toxicity, score_toxicity, word_slots

WORDS = "river stone window garden letter morning paper summer kitchen station mountain bridge winter evening".split()


def said(rng: random.Random, *more: str) -> str:
    return " ".join([rng.choice(WORDS) for _ in range(5)] + list(more))


def test_every_labelled_row_teaches(spark):
    """An insult that only rows beyond the lowest 4,000 hashes of toxic keys have is learned as well as any other."""
    rng = random.Random(2)
    keys = spark.range(11_000).select("id", F.xxhash64("id", F.lit(11)).alias("lot")).orderBy("lot").collect()
    open_keys = [r.id for r in keys if zlib.crc32(str(r.id).encode()) % 3 != 1]
    toxic, clean = open_keys[0::3] + open_keys[1::3], open_keys[2::3]
    toxic.sort(key={r.id: r.lot for r in keys}.get)
    texts = [(k, said(rng, "grobnix" if n < 4000 else "snarzel"), "en") for n, k in enumerate(toxic)] + [(k, said(rng), "en") for k in clean]
    assert len(toxic) > 4500
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1) for k in toxic] + [(k, 0) for k in clean], "doc_id long, toxic int")
    asked = [said(rng, "snarzel") for _ in range(50)] + [said(rng, "grobnix") for _ in range(50)] + [said(rng) for _ in range(50)]
    scores = fit_toxicity(docs, labels).scores(*joined([t.encode() for t in asked]))
    assert (scores[:100] >= 0.7).all() and (scores[100:] < 0.7).all()


def test_fit_is_the_same_under_any_layout(spark, monkeypatch):
    """Parts of a few rows, a key of a third of the rows, rows that repeat; labels sent and joined by shuffle."""
    monkeypatch.setattr(mixing, "PART_ROWS", 100)
    rng = random.Random(3)
    rows = [(k, said(rng, *["fulvark"] * (k % 4 == 0)), rng.choice("ab")) for k in range(400)]
    rows += [(7, said(rng), "a") for _ in range(150)] + [rows[8]] * 60 + [(9, None, "b"), (None, "fulvark", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(380)], "doc_id long, toxic int")
    models = [fit_toxicity(docs.repartition(p), labels, broadcast_rows=most) for p, most in ((1, 10**6), (6, 10**6), (3, 0))]
    for other in models[1:]:
        assert np.allclose(models[0].net.tables, other.net.tables, atol=1e-5) and np.allclose(models[0].net.head, other.net.head, atol=1e-5)
        assert models[0].thresholds.keys() == other.thresholds.keys()
        assert all(abs(models[0].thresholds[k] - other.thresholds[k]) < 1e-3 for k in other.thresholds)
    assert {r.predicted for r in score_toxicity(spark.createDataFrame([(1, "window fulvark")], "doc_id long, text string"), models[0]).collect()} == {1}


def test_slot_counts_by_force(spark):
    """In how many texts each slot occurs, over tasks and parts; a lot that repeats is one text."""
    rng = random.Random(4)
    rows = [(k % 3, k // 3, k % 2, said(rng)) for k in range(90)]
    frame = spark.createDataFrame(rows + rows[:9], "part int, lot long, toxic int, text string").repartition(4, "part").sortWithinPartitions("part", "lot")
    seen = np.zeros((3 * toxicity.SLOTS // toxicity.BLOCK, toxicity.BLOCK * 2), np.int64)
    for block, data in mixing.put_together(frame.mapInArrow(toxicity._seen, mixing.MOVED), toxicity._all_seen).items():
        seen[block] = np.frombuffer(data, np.int64)
    seen = seen.reshape(3, toxicity.SLOTS, 2)
    want = np.zeros_like(seen)
    for _, _, label, text in rows:
        slots = word_slots(*joined([text.encode()]))[0]
        for k in range(3):
            for slot in set(slots[:, k].tolist()):
                want[k, slot, label] += 1
    assert (seen == want).all()
    net = first_net(seen, 45, 90)
    slot = word_slots(*joined([b"river"]))[0][0, 0]
    clean, bad = want[0, slot]
    share = (bad + 1) / (clean + bad + 2)
    assert abs(net.tables[0, slot, 0] - np.clip(np.log(share / (1 - share)), -3, 4) / 3) < 1e-6


def test_parts_are_averaged():
    """A slot is the mean of the parts that moved it, all other layers are means weighted by rows."""
    pack = lambda place, by: np.array(place, np.int32).tobytes() + np.array(by, np.float32).tobytes()
    width = toxicity.WIDTH
    got = np.frombuffer(toxicity._mixed(0, [(5, pack([1, 4], [[1] * width, [2] * width])), (7, pack([4], [[4] * width]))]), np.float32).reshape(-1, width)
    assert got[1].tolist() == [1] * width and got[4].tolist() == [3] * width and got.sum() == 4 * width
    flat = np.frombuffer(toxicity._mixed(toxicity.DENSE, [(1, np.float32([1, 2]).tobytes()), (3, np.float32([5, 2]).tobytes())]), np.float32)
    assert flat.tolist() == [4, 2]


def test_thresholds_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "RANGE_ROWS", 60)
    rng = np.random.default_rng(5)
    rows = [(g, float(x), int(x + rng.normal(0, s) > 0.4)) for g, n, s in (("", 500, 1.0), ("a", 300, 0.3), ("b", 40, 0.0), ("c", 30, 9.0)) for x in np.round(rng.normal(0, 1, n), 2)]
    rows += [("only", -1.5, 1), ("none", 0.5, 0), ("none", 0.25, 0)]
    got = {r.group: r for r in best_thresholds(spark.createDataFrame(rows, "group string, logit double, toxic int").repartition(5), len(rows)).collect()}
    for group in {g for g, _, _ in rows}:
        logits, toxic = (np.array([r[k] for r in rows if r[0] == group]) for k in (1, 2))
        assert got[group].hits == toxic.sum() and got[group].threshold == best_threshold(logits, toxic)


def test_every_row_teaches_its_language(spark):
    """Of a language, rows beyond the lowest 800 hashes are of other letters, which are rare in the other language."""
    rng = random.Random(6)
    text = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(20))
    made = [(k, text("abcd"), "x") for k in range(800)] + [(k, text("efgh"), "x") for k in range(800, 3800)]
    lots = dict(spark.createDataFrame(made, "doc_id long, text string, lang string").select("doc_id", F.xxhash64(F.lit(3), "lang", "doc_id", "text")).collect())
    middle = sorted(lots[k] for k in range(800))[400]
    low = [r for r in made[:800] if lots[r[0]] <= middle]
    high = [r for r in made[800:] if lots[r[0]] > middle]
    more = [(10_000 + k, text("abcd"), "x") for k in range(3000)]
    lots |= dict(spark.createDataFrame(more, "doc_id long, text string, lang string").select("doc_id", F.xxhash64(F.lit(3), "lang", "doc_id", "text")).collect())
    low += [r for r in more if lots[r[0]] <= middle][: 800 - len(low)]
    assert len(low) == 800 and len(high) > 800
    other = [(20_000 + k, text("ijkl") + " " + text("efgh")[:10], "y") for k in range(800)]
    rows = spark.createDataFrame(low + high + other, "doc_id long, text string, lang string")
    asked = [text("efgh") for _ in range(40)] + [text("abcd") for _ in range(40)] + [text("ijkl") for _ in range(40)]
    models = [fit_languages(rows.repartition(p)) for p in (1, 5)]
    for model in models:
        assert decided(model, *joined([t.encode() for t in asked]))[0] == ["x"] * 80 + ["y"] * 40
    assert np.allclose(models[0].weights, models[1].weights, atol=1e-4)
