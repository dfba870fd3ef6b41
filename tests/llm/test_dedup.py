import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rentlens.llm import ngram_join, suffix_dedup
from rentlens.llm.content_sort import content_sort, without_copies
from rentlens.llm.keyblocks import block_of
from rentlens.llm.ngram_join import Bounds, ngram_components
from rentlens.llm.fingerprints import edited_fingerprints
from rentlens.llm.suffix_dedup import repeated_windows, without_repeats
from rentlens.llm.textblocks import blocks, joined, shingles, span_hashes, words


def grams(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def classes_by_force(rows, n, num, den):
    sets = [grams(t, n) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            same_key = rows[a][0] == rows[b][0] and rows[a][0] is not None
            i = len(sets[a] & sets[b])
            if same_key or (sets[a] and sets[b] and den * i >= num * len(sets[a] | sets[b])):
                x, y = label[a], label[b]
                label = [y if v == x else v for v in label]
    least = {}
    for (key, _), v in zip(rows, label, strict=True):
        if key is not None:
            least[v] = min(least.get(v, key), key)
    return sorted((key, len(s), least.get(v) if s else key) for (key, _), s, v in zip(rows, sets, label, strict=True))


@pytest.mark.parametrize(("n", "num", "den"), [(4, 85, 100), (5, 80, 100), (2, 60, 100)])
def test_ngram_components(docs, n, num, den):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in ngram_components(docs, n, num, den).collect())
    assert got == classes_by_force(rows, n, num, den)
    assert len({r[2] for r in got}) < len(got) - 20


def test_ngram_components_in_small_parts(docs, monkeypatch):
    """Families larger than a part: parts meet through the common row, strays meet all parts."""
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    monkeypatch.setattr(ngram_join, "CELL_NGRAMS", 400)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    got = sorted(tuple(r) for r in ngram_components(docs, 4, 85, 100).collect())
    assert got == classes_by_force(rows, 4, 85, 100)


def test_ngram_components_without_and_with_repeated_keys(spark):
    """A row without a key joins two that do not link; a key that is not the smallest of its classes joins these."""
    w = [f"w{k}" for k in range(60)]
    bridge = [(1, " ".join(w[:40])), (None, " ".join(w[:44])), (2, " ".join(w[:48])), (None, " ".join(w[:44]))]
    x, y, z = ("x " + " ".join(f"{c}{k}" for k in range(30)) for c in "xyz")
    keys = [(15, x), (15, y), (15, z), (13, y), (12, x), (14, z), (17, "x"), (17, None)]
    none = [(None, " ".join(f"n{k}" for k in range(20 + e))) for e in (0, 1)]
    rows = bridge + keys + none
    got = ngram_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 4, 85, 100).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    keyed = [(k if k is not None else -1 - i, t) for i, (k, t) in enumerate(rows)]
    want = []
    for key, size, name in classes_by_force(keyed, 4, 85, 100):
        # Stand-ins are below all keys: the smallest key of the component is looked up apart.
        together = [k for k, _, other in classes_by_force(keyed, 4, 85, 100) if other == name and k >= 0]
        want.append((key if key >= 0 else None, size, min(together, default=None)))
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert {r.component_id for r in got if r.n_shingles == 45} == {1} and {r.component_id for r in got if r.doc_id == 14} == {12}


def test_ngram_components_edges(empty, no_key):
    assert ngram_components(empty).collect() == []
    assert {r.component_id for r in ngram_components(no_key).collect()} == {None}


@pytest.mark.parametrize(("num", "den"), [(85, 100), (80, 100), (60, 100), (95, 100)])
def test_every_linked_pair_shares_a_signature(num, den):
    rng = np.random.default_rng(num)
    bounds = Bounds(num, den)
    met = 0
    for _ in range(400):
        n = int(rng.integers(1, 200))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        gone, more = int(rng.integers(0, 1 + n // 4)), int(rng.integers(0, 1 + n // 4))
        b = np.concatenate([a[gone:], rng.integers(0, 1 << 63, more).astype(np.uint64)])
        if len(b) and bounds.linked(n - gone, n, len(b)):
            met += 1
            x, y = ngram_join._signatures(np.sort(a), bounds), ngram_join._signatures(np.sort(b), bounds)
            assert np.intersect1d(x, y).size
    assert met > 10


def test_shingles_against_python(texts):
    known = [t for t in texts if t is not None]
    body, offsets = joined([t.encode() for t in known])
    for n in (1, 4, 5):
        hashes, _, at = words(body, offsets)
        found, found_at = shingles(hashes, at, n)
        for k, t in enumerate(known):
            assert len(set(found[found_at[k] : found_at[k + 1]].tolist())) == len(grams(t, n))
    all_grams = defaultdict(set)
    for k, t in enumerate(known):
        for h in found[found_at[k] : found_at[k + 1]].tolist():
            all_grams[h].add(k)
    for a, b in ((20, 21), (60, 61)):
        assert sum({a, b} <= s for s in all_grams.values()) == len(grams(known[a], 5) & grams(known[b], 5))


def test_span_hashes():
    data = np.frombuffer(b"abc" * 5000, np.uint8)
    starts, ends = np.array([0, 14_997, 4500, 3, 9, 0, 7, 2]), np.array([3, 15_000, 4503, 6, 4509, 4500, 7, 2])
    found = span_hashes(data, starts, ends)
    assert found[0] == found[1] == found[2] == found[3] and found[4] == found[5] and found[6] == found[7]
    assert len(set(found.tolist())) == 3
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    spans = [(a, a + n) for a in range(3000) for n in (0, 1, 7, 8, 9, 16, 17, 255, 256, 257)]
    by_content = defaultdict(set)
    for (a, b), h in zip(spans, span_hashes(data, *np.array(spans).T).tolist(), strict=True):
        by_content[data[a:b].tobytes()].add(h)
    assert all(len(h) == 1 for h in by_content.values()) and len(set.union(*by_content.values())) == len(by_content)
    assert list(blocks(np.array([0, 5, 5, 3000, 3001]), 1000)) == [(0, 2), (2, 3), (3, 4)]
    assert (np.diff(block_of(np.sort(np.random.default_rng(1).integers(0, 1 << 63, 99).astype(np.uint64)), 7)) >= 0).all()


def thue_morse(n, swap=False):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


def test_words_that_cancel_in_a_polynomial(spark):
    rows = []
    for n in (64, 1024, 2048):
        tail = f" tail{n} of the text"
        rows += [(len(rows), thue_morse(n) + tail), (len(rows) + 1, thue_morse(n, True) + tail)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in ngram_join.ngram_components(frame, n=4, num=85, den=100).collect()} == {(i, i) for i in range(6)}
    long = [(k, " ".join(f"{i}{thue_morse(1024, bool(k))}" for i in range(30))) for k in range(2)]
    assert all(r.near_next < 0.5 for r in edited_fingerprints(spark.createDataFrame(long, "doc_id long, text string")).collect())


def test_content_sort(docs):
    rows = [(r.doc_id, re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")) for r in docs.select("doc_id", "text").collect()]
    least, size = {}, Counter(t for _, t in rows)
    for key, t in rows:
        least[t] = min(least.get(t, key), key)
    got = [tuple(r) for r in content_sort(docs).select("doc_id", "keep_id", "group_size", "text_sha256").collect()]
    assert sorted(got) == sorted((k, least[t], size[t], hashlib.sha256(t.encode()).hexdigest()) for k, t in rows)
    assert content_sort(docs).where("kept").count() == len(size)


def test_content_sort_of_one_group_over_many_ranges(spark):
    rows = [(i, "the same text " * 3) for i in range(3000)] + [(5000 + i, f"text {i % 7}") for i in range(300)]
    out = content_sort(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("kept").count() == 8
    assert {r[0] for r in out.where("group_size = 3000").select("keep_id").distinct().collect()} == {0}
    assert out.where("group_size = 3000").count() == 3000


def test_without_copies_keeps_columns(docs, empty, no_key):
    kept = without_copies(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.join(docs, [kept[c].eqNullSafe(docs[c]) for c in docs.columns], "left_anti").count() == 0
    assert without_copies(empty).count() == 0
    assert without_copies(no_key).count() == 3


def removed_by_force(bodies):
    seen = Counter(b[p : p + 200] for b in bodies for p in range(len(b) - 199))
    out = []
    for b in bodies:
        mask = np.zeros(len(b), bool)
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                mask[p : p + 200] = True
        out.append(mask)
    return out


def windows_by_force(rows):
    out = []
    bodies = [(t or "").encode() for _, t in rows]
    for (key, _), b, mask in zip(rows, bodies, removed_by_force(bodies), strict=True):
        spans = int((np.diff(mask.astype(int), prepend=0) == 1).sum())
        out.append((key, len(b), int(mask.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~mask].tobytes()).hexdigest()))
    return sorted(out)


def test_repeated_windows(docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = windows_by_force(rows)
    assert sorted(tuple(r) for r in repeated_windows(docs).collect()) == want
    assert sum(r[3] for r in want) > 40
    # Few documents a slice, so that equal runs meet in blocks beside marks of runs that went on.
    for size in (1, 2, 5):
        monkeypatch.setattr(suffix_dedup, "SLICE", size)
        assert sorted(tuple(r) for r in repeated_windows(docs).collect()) == want
    # More blocks of entries than of documents, and findings joined by shuffle.
    monkeypatch.setattr(suffix_dedup, "n_blocks_for", lambda *_: 7)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_BYTES", 0)
    assert sorted(tuple(r) for r in repeated_windows(docs).collect()) == want


def test_entries_are_spread_over_blocks():
    """Anchors are least hashes; what blocks are cut by is not."""
    data = np.random.default_rng(2).integers(97, 123, 300_000).astype(np.uint8)
    _, _, _, anchor, _ = suffix_dedup.anchored_runs(data, np.array([0, len(data)]))
    counts = np.bincount(block_of(anchor, 16), minlength=16)
    assert counts.min() > 0.8 * counts.mean() and counts.max() < 1.2 * counts.mean()


def test_stretches_cover_every_window_once():
    offsets = np.array([0, 150, 150, 5150, 5400, 9000])
    seen = Counter()
    for doc, begin, end in suffix_dedup.stretches(offsets, 1000):
        for d, a, b in zip(doc, begin, end, strict=True):
            assert offsets[d] <= a and b <= offsets[d + 1]
            seen.update(range(a, b - 199))
    want = [p for a, b in zip(offsets[:-1], offsets[1:], strict=True) for p in range(a, b - 199)]
    assert sorted(seen) == want and set(seen.values()) == {1}


def test_repeated_windows_edges(spark, empty, no_key):
    assert repeated_windows(empty).collect() == []
    assert [r.n_removed for r in repeated_windows(no_key).collect() if r.n_bytes == 600] == [600]
    copies = spark.createDataFrame([(i, "w " * 150 + "end") for i in range(500)] + [(999, "w " * 100)], "doc_id long, text string")
    assert {(r.n_bytes, r.n_removed) for r in repeated_windows(copies).collect()} == {(303, 303), (200, 200)}


def equal_crcs():
    """Two texts that repeat nothing of each other, with one CRC-32."""
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    p, q = ("".join(rng.choice(letters) for _ in range(300)) for _ in range(2))
    tails = {zlib.crc32((p + t).encode()): t for t in ("".join(rng.choice(letters) for _ in range(10)) for _ in range(200_000))}
    while True:
        t = "".join(rng.choice(letters) for _ in range(10))
        if zlib.crc32((q + t).encode()) in tails:
            return p, p + tails[zlib.crc32((q + t).encode())], q + t


@pytest.mark.parametrize("key", [None, 7, -(1 << 63)])
def test_rows_of_one_key_and_checksum_are_two(spark, key):
    passage, one, other = equal_crcs()
    assert zlib.crc32(one.encode()) == zlib.crc32(other.encode())
    frame = spark.createDataFrame([(key, one), (key, other), (9, "x" + passage)], "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in repeated_windows(frame).collect())
    assert got == sorted([(str(key), 310, 300), (str(key), 310, 0), ("9", 301, 300)])


def test_without_repeats_keeps_whole_characters(spark):
    passage = "éa" * 100
    rows = [(1, "ß" + passage + "one", "x", 1), (2, "ö" + passage + "two", "x", 1), (3, "alone", "x", 1), (4, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, found string, n_chars long")
    out = {r.doc_id: r for r in without_repeats(frame).collect()}
    assert out[1].text == "ßone" and out[2].text == "ötwo" and out[3].text == "alone" and out[4].text is None
    assert without_repeats(frame).columns == frame.columns
