import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rentlens.llm import pieces as P
from rentlens.llm import warc
from rentlens.llm.entries import packed_tokens
from rentlens.llm.fingerprints import edited_fingerprints, fingerprints, likeness
from rentlens.llm.packing import best_fit, packed, pieces_of
from rentlens.llm.pieces import decode, encode, round_trip
from rentlens.llm.sharding import stratified_shards
from rentlens.llm.textblocks import joined
from rentlens.llm.warc import DamagedArchive, read_archives, write_archives

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def shingle_set(text, n=5):
    w = text.lower().split()
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_edited_texts_and_likeness(docs):
    rows = sorted({(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()})
    frame = docs.dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in edited_fingerprints(frame).collect()}
    assert len(got) == len(rows)
    off = []
    for k, (key, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((r.near_edited, edited), (r.near_next, following)):
            a, b = shingle_set(text), shingle_set(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert 0 <= near <= 1
            off.append(abs(near - true))
        same = [x for x, t in rows if t == text]
        assert len({bytes(got[x].fingerprint) for x in same}) == 1
    assert np.mean(off) < 0.03 and max(off) < 0.2


def test_fingerprints_of_sparse_texts():
    """Fewer shingles than bins: densified fingerprints still estimate the similarity, on average over many pairs."""
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        n, common = 40, int(rng.integers(0, 41))
        w = [f"w{x}" for x in rng.integers(0, 10**9, 2 * n)]
        a, b = " ".join(w[: n + 4]), " ".join(w[:common] + w[n + 4 : 2 * n + 4 - common])
        prints = fingerprints(*joined([a.encode(), b.encode()]))
        x, y = shingle_set(a), shingle_set(b)
        errors.append(likeness(prints[:1], prints[1:])[0] - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.35


def test_fingerprint_edges(spark, empty, no_key):
    assert edited_fingerprints(empty).collect() == []
    assert edited_fingerprints(no_key).count() == 4
    alone = edited_fingerprints(spark.createDataFrame([(7, "abcdefgh")], "doc_id long, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0
    blank = edited_fingerprints(spark.createDataFrame([(1, None), (2, "a b c d e f")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.near_next for r in blank] == [0.0, 0.0] and blank[0].near_edited == 1.0


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.6])
def test_pieces_round_trip(texts, rate):
    known = [t for t in texts if t is not None]
    model, p = sentencepiece.SentencePieceProcessor(model_file=MODEL), P.pieces(MODEL)
    body, offsets = joined([t.encode() for t in known])
    ids, at = P.encoded(p, body, offsets, np.arange(len(known), dtype=np.uint64), 7, rate)
    back, back_at = P.decoded(p, ids, at)
    assert back.tobytes() == body.tobytes() and (back_at == offsets).all()
    plain = [model.encode(t) for t in known]
    own = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    if rate == 0:
        assert all(a == b for a, b, t in zip(own, plain, known, strict=True) if "▁" not in t)
    else:
        assert sum(map(len, own)) > sum(map(len, plain))
        assert all(model.decode(x) == t for x, t in zip(own, known, strict=True) if "▁" not in t)
        other, _ = P.encoded(p, body, offsets, np.arange(len(known), dtype=np.uint64), 8, rate)
        again, _ = P.encoded(p, body, offsets, np.arange(len(known), dtype=np.uint64), 7, rate)
        assert again.tolist() == ids.tolist() != other.tolist()


def dropout_of(texts, keys, rate=0.1):
    """The words of the texts as tuples of ids: by ``encoded``, and each occurrence run alone with its own key."""
    p = P.pieces(MODEL)
    body, offsets = joined([t.encode() for t in texts])
    keys = np.array(keys, np.int64).view(np.uint64)
    ids, at = P.encoded(p, body, offsets, keys, 7, rate)
    starts, ends, key, word_at = P.occurrences(body, offsets, keys, 7)
    alone = []
    for k, (a, b) in enumerate(zip(starts, ends, strict=True)):
        symbols = [p.space] * (k in word_at) + [p.character[ord(c)] for c in body[a:b].tobytes().decode()]
        alone.append(tuple(P._by_heap(p, np.array(symbols, np.int64), key[k], rate).tolist()))
    return ids.tolist(), at, alone


def test_dropout_of_every_occurrence():
    texts = [" ".join(["a", "international", "understanding", "the", "q" * 40, "x" * 120][: 6 if k < 3 else 4] * 40) for k in range(12)]
    ids, _, alone = dropout_of(texts, range(12))
    assert ids == [i for w in alone for i in w]
    again, _, _ = dropout_of(texts, range(12))
    assert again == ids


def test_dropout_approaches_the_rate():
    """A word of one candidate skips it at the rate; a longer one has far more segmentations than a few."""
    p, n = P.pieces(MODEL), 20_000
    body, offsets = joined([(" a" * n).encode()])
    ids, _ = P.encoded(p, body, offsets, np.zeros(1, np.uint64), 7, 0.1)
    a = p.character[ord("a")]
    # The space in front of the text makes the first word another one.
    assert abs(ids.tolist().count(a) / n - 0.1) < 0.01
    _, _, alone = dropout_of(["international " * 3000], [5])
    assert len(set(alone[1:-1])) > 60


def test_dropout_of_rows_without_a_key():
    """Rows that share a key, or have none, choose each for itself; equal rows choose alike."""
    texts = [f"international {k}" for k in range(200)]
    ids, at, _ = dropout_of([*texts, texts[0]], [-1] * 201)
    first = {tuple(ids[i:j][:4]) for i, j in zip(at[:-1], at[1:], strict=True)}
    assert len(first) > 8 and ids[at[0] : at[1]] == ids[at[200] :]


def test_heap_and_matrix_agree():
    p, rng = P.pieces(MODEL), np.random.default_rng(1)
    for _ in range(200):
        w = "".join(rng.choice(list("theanding"), rng.integers(2, 40)))
        symbols = np.array([p.space, *(p.character[ord(c)] for c in w)], np.int64)
        key = np.array([rng.integers(1 << 62)], np.uint64)
        rows, left = P._by_matrix(p, symbols[None], np.array([len(symbols)]), key, 0.3)
        assert rows[0, : left[0]].tolist() == P._by_heap(p, symbols, key[0], 0.3).tolist()


def test_piece_frames(docs, empty, no_key):
    rows = {r.doc_id: r for r in round_trip(docs, MODEL).collect()}
    coded = {r.doc_id: r.ids for r in encode(docs, MODEL).collect()}
    back = {r.doc_id: r.text for r in decode(encode(docs, MODEL), MODEL).collect()}
    for r in docs.select("doc_id", "text").collect():
        assert rows[r.doc_id].lossless and back[r.doc_id] == (r.text or "")
        assert rows[r.doc_id].n_pieces == len(coded[r.doc_id])
        assert rows[r.doc_id].ids_crc32 == zlib.crc32(np.array(coded[r.doc_id], "<u4").tobytes())
    assert round_trip(empty, MODEL).count() == 0 and round_trip(no_key, MODEL).where("lossless").count() == 4


def test_packed_documents(docs, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want.append((r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = packed_tokens(docs).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    check_sequences(got)
    assert len({r.sequence_id for r in got}) <= -(-sum(w[3] for w in want) // 2048) + 1
    assert packed_tokens(empty).count() == 0


def test_special_strings_are_one_token(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["<|endoftext|>", "a<|endoftext|>b  <|endoftext|><|endoftext|> c", "<|endoftext", "x <|endoftext|", "Grüße <|endoftext|>\n\n  日本"]
    got = packed_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    want = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4") for i, t in enumerate(texts)}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in got} == {i: (len(w), zlib.crc32(w.tobytes())) for i, w in want.items()}
    assert 50256 in want[0]


def test_packing_edges(spark):
    for wrong in (0, 2049, -1, None):
        with pytest.raises(ValueError, match="outside 1 to 2048"):
            packed(spark.createDataFrame([(1, 5), (2, wrong)], "doc_id long, length long"))
    rows = [(None, 700)] * 5 + [(7, 700)] * 4
    got = packed(spark.createDataFrame(rows, "doc_id long, length long")).collect()
    assert sorted(((r.doc_id, r.length) for r in got), key=str) == sorted(rows, key=str)
    check_sequences(got)
    assert len({r.sequence_id for r in got}) == 5


@pytest.mark.parametrize("low", [1, 900])
def test_packing_ends_when_no_two_bins_fit(spark, low):
    """The tasks cannot get fewer than one for twenty items, yet no two sequences are left that fit together."""
    rng = random.Random(low)
    rows = [(i, rng.choice([rng.randint(low, 1020), rng.randint(1030, 2030)])) for i in range(400)]
    got = packed(spark.createDataFrame(rows, "doc_id long, length long"), items=20).collect()
    check_sequences(got)
    fills = Counter()
    for r in got:
        fills[r.sequence_id] += r.length
    least = sorted(fills.values())[:2]
    assert sum(least) > 2048 and sorted((r.doc_id, r.length) for r in got) == rows


def check_sequences(rows, capacity=2048):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


def test_packing_in_many_tasks(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([rng.randint(1, 60), rng.randint(1, 900), rng.randint(1000, 2048)])) for i in range(30_000)]
    got = packed(spark.createDataFrame(rows, "doc_id long, length long")).collect()
    assert sorted((r.doc_id, r.length) for r in got) == rows
    check_sequences(got)
    assert len({r.sequence_id for r in got}) <= 1.01 * sum(n for _, n in rows) / 2048 + 1


def test_best_fit():
    bins, offsets, fills = best_fit(np.array([1000, 1100, 48, 2048, 900, 948]))
    assert sorted(fills.tolist()) == [1948, 2048, 2048] and bins[1] == bins[5] and offsets[3] == 0
    assert pieces_of(2048) == [(0, 2048)] and pieces_of(2050) == [(0, 2), (2, 2048)] and pieces_of(1) == [(0, 1)]


def test_shards(docs, spark, empty, no_key):
    rng = random.Random(1)
    rows = [(i, "é" * (i % 9), rng.choice(["big", "big", "big", "a", "b", None])) for i in range(5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = stratified_shards(frame).collect()
    by_id = {r.doc_id: r for r in got}
    sizes, slots = Counter(r.shard for r in got), defaultdict(set)
    for r in got:
        slots[r.shard].add(r.slot)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(slots[s] == set(range(sizes[s])) for s in sizes)
    mixture = Counter(s for *_, s in rows)
    held = Counter((by_id[i].shard, s) for i, _, s in rows)
    assert all(abs(held[k, s] - mixture[s] / 8) <= 1 for k in range(8) for s in mixture)
    assert all(by_id[i].size == 2 * (i % 9) + 1 and by_id[i].text_crc32 == zlib.crc32(("é" * (i % 9)).encode()) for i, _, _ in rows)
    again = stratified_shards(frame.repartition(13)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)
    assert [r.shard for r in sorted(got)][:50] != sorted(r.shard for r in got)[:50]
    assert stratified_shards(docs).count() == docs.count() and stratified_shards(empty).count() == 0 and stratified_shards(no_key).count() == 4


def test_shards_over_many_slots(spark, monkeypatch):
    from rentlens.llm import sharding

    monkeypatch.setattr(sharding, "SLOT_ROWS", 40)
    frame = spark.range(1003).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("source"))
    sizes = Counter(r.shard for r in stratified_shards(frame).collect())
    assert sorted(sizes.values()) == [125] * 5 + [126] * 3


def test_sharding_plan_is_native(spark, docs):
    plan = stratified_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


PAGES = [(3, "http://a", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "http://b\r\nX: y", None), (9, "u", ""), (5, "u", "z" * 3_000_000), (6, "u", "WARC/1.1\r\n\r\n"), (None, "u", "<p>é</p>"), (7, "u", "only")]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    archives = write_archives(pages)
    got = {r.page_id: r for r in read_archives(archives).collect()}
    assert len(got) == len(PAGES)
    for key, _, html in PAGES:
        body, r = (html or "").encode(), got[key]
        same = [k for k, _, h in PAGES if (h or "") == (html or "") and k is not None]
        assert r.payload_bytes == len(body) and r.payload_digest == warc.sha1_base32(body) and r.block_ok
        if key == min(same):
            assert r.record_type == "response" and r.refers_to is None and bytes(r.payload) == body and r.payload_ok
        else:
            assert r.record_type == "revisit" and r.refers_to == min(same) and r.payload is None
    assert read_archives(write_archives(pages.limit(0))).count() == 0
    # The chunks of an archive are a file that any gzip reader takes.
    import gzip

    chunks = sorted(tuple(r) for r in archives.collect())
    for archive in {c[0] for c in chunks}:
        assert gzip.decompress(b"".join(bytes(c[1]) for c in chunks if c[0] == archive)).count(b"WARC-Type: ") >= 1


def test_archives_in_chunks_and_copies_by_shuffle(spark, monkeypatch):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES] + [(1, "again", "<p>é</p>", "y")], "page_id long, url string, html string, digest string").repartition(3)
    archives = write_archives(pages, broadcast_rows=0)
    rows = []
    for archive, content in archives.collect():
        content = bytes(content)
        rows += [(archive, k, content[i : i + 700]) for k, i in enumerate(range(0, len(content), 700))]
    random.Random(1).shuffle(rows)
    cut = read_archives(spark.createDataFrame(rows, "archive long, chunk long, content binary")).collect()
    whole = read_archives(write_archives(pages)).collect()
    assert sorted(map(str, cut)) == sorted(map(str, whole)) and len(cut) == len(PAGES) + 1
    # Rows that repeat the smallest key of a payload are all responses.
    assert [r.record_type for r in cut if r.page_id == 1] == ["response"] * 2
    assert {r.refers_to for r in cut if r.page_id in (3, None)} == {1}


def test_members_over_any_chunks():
    data = [warc.record(i, "u", b"p" * i * 50, None) for i in range(20)]
    stream = b"".join(warc.member(d) for d in data)
    for size in (1, 7, 64, 100_000):
        assert list(warc.members(iter(stream[i : i + size] for i in range(0, len(stream), size)))) == data
    with pytest.raises(DamagedArchive):
        list(warc.members(iter([stream[:-5]])))
    with pytest.raises(DamagedArchive):
        warc.parsed(data[3][:-6])


def test_wrong_digest_shows():
    data = warc.record(1, "u", b"payload", None)
    row = warc._row(data.replace(b"payload", b"payl0ad"))
    assert not row["block_ok"] and not row["payload_ok"]
