import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_dedup import classes_by_force, removed_by_force
from tokenizers import Tokenizer

import corpus_pipeline
from rentlens.llm import language_id
from rentlens.llm.entries import QUERIES, SQL
from rentlens.llm.language_id import codewords, ngram_features, predict_languages, trained
from rentlens.llm.textblocks import joined
from rentlens.llm.samples import drawn, gathered, once
from rentlens.llm.toxicity import FILTERS, SPANS, Net, best_threshold, fit_toxicity, gradients, score_toxicity, word_slots

FOLDER = "/root/testdata/sf0.01"


def test_codewords_differ():
    for n in (2, 3, 5, 6, 12, 40):
        codes = codewords(n)
        apart = [(codes[a] != codes[b]).sum() for a in range(n) for b in range(a)]
        assert codes.shape[0] == n and min(apart) >= max(1, codes.shape[1] // 5)


def test_error_correction():
    """A text is still decoded when one bit's classifier is turned around."""
    rng = random.Random(5)
    made = [("".join(rng.choice(a) for _ in range(200)), name) for name, a in (("x", "abcd "), ("y", "efgh "), ("z", "ijkl "), ("w", "mnop ")) for _ in range(30)]
    features = ngram_features(*joined([t.encode() for t, _ in made]))
    model = trained(features, [name for _, name in made])
    right = lambda m: np.mean([m.languages[b] == n for b, (_, n) in zip(m.decide(features)[0], made, strict=True)])
    assert right(model) == 1
    weights = model.weights.copy()
    weights[:, 0] *= -1
    assert right(language_id.LanguageModel(model.languages, model.codes, weights, model.bias, model.trust)) == 1


ODD_TEXTS = ["", "a", "Ab", "Grüße, WELT  x", "日本語 test", "zz " * 40, "one\ntwo THREE"]


def test_ngram_features_by_force():
    """Byte n-grams of the lower-cased text with one space on both sides; each is a slot of a multiplicative hash."""
    got = ngram_features(*joined([t.encode() for t in ODD_TEXTS]))
    for k, text in enumerate(ODD_TEXTS):
        data = b" " + bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode()) + b" "
        counts = Counter()
        for at in range(1, len(data) - 1):
            for order in (2, 3):
                code = order
                for b in data[at - 1 : at - 1 + order]:
                    code = code * 257 + b
                counts[(code * 0x9E3779B97F4A7C15 % 2**64) >> 52] += 1
        total = sum(counts.values())
        want = np.zeros(language_id.FEATURES)
        for slot, n in counts.items():
            want[slot] = (n / total) ** 0.5
        assert np.allclose(got[k], want, atol=1e-6)


def test_margins_and_decoding_by_force():
    rng = np.random.default_rng(3)
    for n in (2, 4, 7):
        codes = codewords(n)
        bits = codes.shape[1]
        model = language_id.LanguageModel([f"l{k}" for k in range(n)], codes, rng.normal(size=(language_id.FEATURES, bits)).astype(np.float32), rng.normal(size=bits).astype(np.float32), rng.uniform(0.01, 0.5, bits).astype(np.float32))
        features = ngram_features(*joined([t.encode() for t in ODD_TEXTS]))
        best, score, unsure = model.decide(features)
        for t in range(len(ODD_TEXTS)):
            margin = [sum(float(features[t, i]) * float(model.weights[i, b]) for i in np.flatnonzero(features[t])) + float(model.bias[b]) for b in range(bits)]
            loss = [sum(float(model.trust[b]) * np.log1p(np.exp(-margin[b] * codes[k, b])) for b in range(bits)) / float(model.trust.sum()) for k in range(n)]
            assert np.allclose(model.losses(features[t : t + 1])[0], loss, rtol=1e-4)
            low = sorted(loss)
            assert best[t] == loss.index(low[0]) and abs(score[t] - 1 / sum(np.exp(-4 * (x - low[0])) for x in loss)) < 1e-3
            assert abs(low[1] - low[0] - language_id.CLOSE * low[1]) < 1e-4 or unsure[t] == (low[1] - low[0] < language_id.CLOSE * low[1])


def test_bits_learn_their_splits():
    rng = random.Random(8)
    made = [("".join(rng.choice(a) for _ in range(120)), name) for name, a in (("x", "abcd "), ("y", "efgh "), ("z", "ijkl ")) for _ in range(20)]
    features = ngram_features(*joined([t.encode() for t, _ in made]))
    model = trained(features, [n for _, n in made])
    want = model.codes[[model.languages.index(n) for _, n in made]]
    assert ((features @ model.weights + model.bias) * want > 0).all() and np.allclose(model.trust, 0.5)


def random_net(seed: int) -> Net:
    rng = np.random.default_rng(seed)
    return Net(
        rng.normal(0, 0.5, (3, 1 << 17, 6)).astype(np.float32), [rng.normal(0, 0.3, (6 * s, FILTERS)).astype(np.float32) for s in SPANS], [rng.normal(0, 0.2, FILTERS).astype(np.float32) for _ in SPANS],
        rng.normal(size=len(SPANS) * FILTERS).astype(np.float32), np.array([0.3], np.float32),
    )


def pooled_by_force(net: Net, slots: np.ndarray) -> list[float]:
    """Each filter over each run of words that touches the text, words outside it being zero; the largest response, 0 at least."""
    words = [sum(net.tables[k][s[k]].astype(float) for k in range(3)) for s in slots]
    zero = [np.zeros(6)] * max(SPANS)
    out = []
    for k, span in enumerate(SPANS):
        padded = zero[: span - 1] + words + zero
        for f in range(FILTERS):
            filter_ = net.filters[k][:, f].astype(float)
            runs = [np.concatenate(padded[i : i + span]) @ filter_ + float(net.filter_bias[k][f]) for i in range(len(words) + span)]
            out.append(max(0.0, *runs))
    return out


def test_pooled_responses_by_force():
    net = random_net(1)
    texts = [b"one two three four", b"", b"x", b"alpha beta gamma delta epsilon zeta eta", b"12 34"]
    slots, at = word_slots(*joined(texts))
    got = net.pooled(slots, at)[0]
    for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        assert np.allclose(got[k], pooled_by_force(net, slots[a:b]), atol=1e-4)


def test_gradients_by_differences():
    net = random_net(2)
    slots, at = word_slots(*joined([b"one two three four", b"", b"five", b"six seven eight nine ten eleven"]))
    pull = np.array([0.7, -0.2, 0.4, -1.1], np.float32)
    total = lambda: float(sum(p * (np.dot(pooled_by_force(net, slots[a:b]), net.head.astype(float)) + float(net.bias[0])) for p, a, b in zip(pull.tolist(), at[:-1], at[1:], strict=True)))
    dense, words = gradients(net, slots, at, pull)
    rng = random.Random(4)

    def by_differences(values: np.ndarray, place: tuple[int, ...]) -> float:
        kept, sides = values[place], []
        for step in (1e-3, -1e-3):
            values[place] = kept + np.float32(step)
            sides.append((total(), float(values[place])))
        values[place] = kept
        return (sides[0][0] - sides[1][0]) / (sides[0][1] - sides[1][1])

    for values, slope in zip([*net.filters, *net.filter_bias, net.head, net.bias], dense, strict=True):
        for _ in range(4):
            place = tuple(rng.randrange(n) for n in values.shape)
            assert abs(by_differences(values, place) - slope[place]) < 5e-3
    for word in range(len(slots)):
        for d in range(6):
            want = words[word][d] if word in words else 0.0
            assert abs(by_differences(net.tables, (0, int(slots[word, 0]), d)) - want) < 5e-3


def test_samples_are_bounded(spark):
    """A key of a third of the rows, copies of a text, long texts and ties: bounded in rows and bytes, alike under any layout."""
    rows = [(k, f"text {k}", "a") for k in range(200)] + [(7, f"other {k}", "a") for k in range(100)] + [(3, "text 3", "a")] * 100 + [(k, "x" * 50 * k, "b") for k in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    keep = once(lambda batch: batch.select(["lot", "doc_id", "lang", "text"]))
    got = []
    for parts in (1, 7):
        sample = drawn(frame.repartition(parts), "lang", 50, seed=1, group_bytes=2000, longest=600)
        got.append(gathered(sample.mapInArrow(keep, "lot long, doc_id long, lang string, text string")).sort_by("lot").to_pylist())
    assert got[0] == got[1]
    of = {name: [r for r in got[0] if r["lang"] == name] for name in "ab"}
    assert len(of["a"]) == 50 and 0 < len(of["b"]) <= 13
    assert all(sum(len(r["text"]) for r in rows) <= 2000 for rows in of.values()) and max(len(r["text"]) for r in got[0]) <= 600
    assert len({(r["doc_id"], r["text"]) for r in got[0]}) == len(got[0])


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = predict_languages(docs).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95


def test_language_edges(spark, docs, empty, no_key):
    assert predict_languages(empty).count() == 0
    assert {r.lang_pred for r in predict_languages(no_key).collect()} == {"und"}
    got = {r.doc_id: r for r in predict_languages(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        assert (got[r.doc_id].lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    one = spark.createDataFrame([(i, "hello", "en") for i in range(8)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in predict_languages(one).collect()} == {("en", 1.0)}


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = score_toxicity(docs, fit_toxicity(docs, labels)).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    toxic, clean = ([s for s, y in held if y == v] for v in (1, 0))
    assert np.mean([[a > b for b in clean] for a in toxic]) > 0.9


def test_toxicity_edges(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()} == {0}
    assert score_toxicity(empty, fit_toxicity(empty, labels)).count() == 0
    few = spark.createDataFrame([(r.doc_id, 0, k % 2) for k, r in enumerate(docs.select("doc_id").distinct().collect())] + [(None, 0, 1), (5, 0, None)], labels.schema)
    assert score_toxicity(docs, fit_toxicity(docs, few)).count() == docs.count()


def test_filters_never_cross_texts():
    rng = np.random.default_rng(0)
    net = Net(rng.normal(size=(3, 1 << 17, 6)).astype(np.float32), [rng.normal(size=(6 * s, 6)).astype(np.float32) for s in (1, 2, 3)], [np.zeros(6, np.float32)] * 3, np.ones(18, np.float32), np.zeros(1, np.float32))
    texts = [b"one two three", b"", b"x", b"four five six seven"]
    slots, at = word_slots(*joined(texts))
    together = net.logits(slots, at)
    alone = [net.logits(*word_slots(*joined([t])))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-4)
    assert best_threshold(np.array([1.0, 2, 3, 4]), np.array([0, 0, 1, 1])) == 2.5


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def without_windows(before):
    """The rows less every character whose bytes all lie in a repeated window."""
    bodies = [(t or "").encode() for _, t in before]
    out = []
    for (key, text), mask in zip(before, removed_by_force(bodies), strict=True):
        at, kept = 0, []
        for c in text or "":
            size = len(c.encode())
            if not mask[at : at + size].all():
                kept.append(c)
            at += size
        out.append((key, None if text is None else "".join(kept)))
    return out


def one_of_each_group(before):
    """Rows without shingles stay; of the rows that links join, the one with the smallest key, a missing key being the last."""
    group = {i: c for i, n, c in classes_by_force([(i, t) for i, (_, t) in enumerate(before)], 5, 80, 100) if n}
    best = {}
    for i, c in group.items():
        rank = (before[i][0] is None, before[i][0] or 0)
        best[c] = min(best.get(c, (rank, i)), (rank, i))
    return [row for i, row in enumerate(before) if i not in group or best[group[i]][1] == i]


def pieces_by_force(before):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for key, text in before:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        yield from ((key, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)))


def test_pipeline_by_force(spark, docs, tmp_path):
    """Each stage, row by row, against its own input; then run() against the chained stages."""
    rng = random.Random(12)
    folder = str(tmp_path)
    words = "river stone window garden letter morning paper summer kitchen station mountain bridge winter evening".split()
    insults = "grobnix fulvark snarzel dreckil".split()
    said = lambda n, bad: " ".join(rng.choice(insults) if k % 3 == 0 and bad else rng.choice(words) for k in range(n))
    clean = [(5000 + k, said(rng.randint(20, 60), False)) for k in range(150)]
    toxic = [(6000 + k, said(rng.randint(20, 60), True)) for k in range(60)]
    names = ["doc_id", "text"]
    labelled = spark.createDataFrame([(k, 1, 0) for k, _ in clean] + [(k, 1, 1) for k, _ in toxic], "doc_id long, quality int, toxic int")
    labelled.write.parquet(f"{folder}/labels.parquet")
    keyless = clean[3][1] + " more"
    added = spark.createDataFrame([*clean, *toxic, (None, keyless), (7001, clean[3][1].replace(" ", "\t")), (7002, clean[4][1] + " again"), (7003, toxic[5][1] + " again")], "doc_id long, text string")
    docs.unionByName(added, allowMissingColumns=True).write.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "suffix_dedup", "packing"]
    now = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in now.collect()]
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        if name == "packing":
            digest = ["doc_id", "piece", "start", "length", "ids_crc32"]
            assert Counter(tuple(r) for r in out.select(*digest).collect()) == Counter(pieces_by_force(before))
            assert Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).select(*digest).collect()) == Counter(tuple(r) for r in out.select(*digest).collect())
            break
        assert out.columns == docs.columns
        after = Counter(tuple(r) for r in out.select(*names).collect())
        if name == "toxicity":
            model = fit_toxicity(now, labelled)
            scores = model.scores(*joined([(t or "").encode() for _, t in before]))
            assert after == Counter(row for row, score in zip(before, scores, strict=True) if score < 0.7)
            left = {key for key, _ in after}
            assert not left & {k for k, _ in toxic} and 7003 not in left and {k for k, _ in clean} <= left
        elif name == "exact_dedup":
            best = {}
            for key, text in before:
                row = (math.inf if key is None else key, text or "")
                best[normal(text)] = min(best.get(normal(text), row), row)
            assert Counter((math.inf if k is None else k, t or "") for k, t in after.elements()) == Counter(best.values())
        elif name == "ngram_jaccard_join":
            assert after == Counter(one_of_each_group(before)) and sum(after.values()) < len(before)
            assert not {None, 7002} & {k for k, _ in after}
        else:
            assert after == Counter(without_windows(before)) and after != Counter(before)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())
        now = out


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    from compare import connect, differences

    folder = "/root/testdata/sf0.001"
    assert differences(QUERIES[name](spark, folder), connect(folder), SQL[name]) is None


def test_queries_cover_every_operator():
    assert Counter(n.split("_")[0] for n in QUERIES) == Counter([*(f"op{k}" for k in range(1, 14)), "pipeline"])
    assert duckdb is not None
