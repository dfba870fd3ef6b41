"""URL verdicts, hard negatives and collocations against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.llm import collocations as C
from rentlens.llm import hard_negatives as H
from rentlens.llm.frames import looked_up, stored
from rentlens.llm.url_filter import LIMIT, Rule, Z, host_reputation, judged_urls

RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


# --- URL filter -----------------------------------------------------------------------------------------------------


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule_of(host, path, rules=RULES):
    fits = []
    for rule in rules:
        name, slash, tail = rule.where.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + tail):
            fits.append(rule)
    return max(fits, key=lambda r: len(r.where)) if fits else None


def reputations(counts):
    """Posterior (a, b) per host by plain loops."""

    def strength(groups):
        top = sum((k - n * m) ** 2 - n * m * (1 - m) for n, k, m in groups)
        below = sum(n * m * (1 - m) * (n - 1) for n, k, m in groups)
        return min(max(below / top - 1, 1.0), 1e6) if below and top / below > 0 else 1e6

    def up(level, cut):
        out = defaultdict(lambda: [0, 0])
        for name, (n, k) in level.items():
            out[cut(name)][0] += n
            out[cut(name)][1] += k
        return out

    domains = up(counts, lambda h: ".".join(h.split(".")[-2:]))
    tops = up(domains, lambda d: d.split(".")[-1])
    n, k = (sum(v[i] for v in tops.values()) for i in (0, 1))
    prior = {s: (k + 0.5) / (n + 1) for s in tops}
    s = strength([(*v, prior[t]) for t, v in tops.items()])
    top_mean = {t: (s * prior[t] + v[1]) / (s + v[0]) for t, v in tops.items()}
    s = strength([(*v, top_mean[d.split(".")[-1]]) for d, v in domains.items()])
    mean = {d: (s * top_mean[d.split(".")[-1]] + v[1]) / (s + v[0]) for d, v in domains.items()}
    prior = {h: mean[".".join(h.split(".")[-2:])] for h in counts}
    s = strength([(*v, prior[h]) for h, v in counts.items()])
    return {h: (s * prior[h] + k, s * (1 - prior[h]) + n - k) for h, (n, k) in counts.items()}


def lower_bound(a, b):
    return max(a / (a + b) - Z * math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))), 0.0)


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Example.NET/en/1", "https://example.net/en/", "http://example.net/en", "http://example.net",
    "https://badexample.net/x#y", "http://x.example.com/de/9?q=/en/", "http://x.example.com?/de/", "http://é.ORG/fr/É", "http://a.org/FR/", "ftp://u@b.c.org:80/fr/1",
    "a://b://c/d", "http://10.1.2.3/x", "http://s.co.uk/en/", "http://net/", "http://a..net/x",
]


def test_judged_urls(spark):
    rng = random.Random(3)
    urls = URLS + [f"http://h{rng.randint(0, 30)}.{rng.choice('ab')}.{rng.choice(['com', 'org'])}/p/{i}" for i in range(600)]
    urls += ["http://hot.b.org/x"] * 300
    counts = {}
    for host in {parts_of(u)[0] for u in urls}:
        if re.fullmatch(r"h\d+\.[ab]\.(com|org)|hot\.b\.org", host):
            n = rng.randint(0, 40)
            counts[host] = (n, sum(rng.random() < (0.7 if host[1] in "02468o" else 0.03) for _ in range(n)))
    counts["never.seen.com"] = (9, 9)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("url", "host", "rule", "rules", "prior", "suffix", "n", "_key")] + [T.StructField("page_id", T.LongType())])
    pages = spark.createDataFrame([(u, "x", None, None, "y", None, "1", None, None if i == 3 else i // 2) for i, u in enumerate(urls)], schema).repartition(6)
    told = [(h, n // 2, k // 2) for h, (n, k) in counts.items()] + [(h, n - n // 2, k - k // 2) for h, (n, k) in counts.items()] + [(None, 5, 5)]
    labelled = spark.createDataFrame(told, "host string, n_labelled long, n_bad long")
    got = judged_urls(pages, labelled, RULES).collect()
    # Only names whose registered domain is their last two labels, so that the loops above hold.
    plain = {h: counts.get(h, (0, 0)) for h in {*counts, *(parts_of(u)[0] for u in urls)}}
    assert len(got) == len(urls)
    want = Counter()
    for i, u in enumerate(urls):
        host, path = parts_of(u)
        rule = rule_of(host, path)
        want[(None if i == 3 else i // 2, host, path, rule and rule.where)] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == want
    for r in got:
        if r.rule:
            assert r.verdict == rule_of(r.host, r.path).verdict
        else:
            assert r.verdict == ("block" if r.bad_bound >= LIMIT else "allow")
        assert (r.n_labelled, r.n_bad) == plain[r.host]
    verdicts = {r.host: r.verdict for r in got if re.fullmatch(r"h\d+\..*", r.host) and r.n_labelled >= 25}
    assert {h: v == "block" for h, v in verdicts.items()} == {h: h[1] in "02468" for h in verdicts}


def test_reputation_against_loops(spark):
    rng = random.Random(5)
    counts = {f"h{i}.{rng.choice('abc')}.{rng.choice(['com', 'org', 'net'])}": (n := rng.randint(0, 60), rng.randint(0, n)) for i in range(80)}
    got = host_reputation(spark.createDataFrame([(h, n, k) for h, (n, k) in counts.items()], "host string, n_labelled long, n_bad long")).collect()
    want = reputations(counts)
    assert {r.host for r in got} == set(counts)
    for r in got:
        a, b = want[r.host]
        assert r.bad_share == pytest.approx(a / (a + b)) and r.bad_bound == pytest.approx(lower_bound(a, b))
    alone = host_reputation(spark.createDataFrame([("a.b.com", 0, 0)], "host string, n_labelled long, n_bad long")).first()
    assert alone.bad_share == pytest.approx(0.5)


def test_judged_urls_edges(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    none = spark.createDataFrame([], "host string, n_labelled long, n_bad long")
    assert judged_urls(pages, none, RULES).collect() == []
    one = judged_urls(spark.createDataFrame([(1, "http://A.b/c")], "page_id long, url string"), none).collect()
    assert [(r.host, r.rule, r.n_labelled) for r in one] == [("a.b", None, 0)]
    same = (Rule("allow", "b.c/x"), Rule("block", "c/xyzz"[:5]))
    page = spark.createDataFrame([(1, "http://a.b.c/xyz")], "page_id long, url string")
    assert judged_urls(page, none, same).first().rule == "b.c/x"


def test_looked_up_splits_frequent_keys(spark):
    rows = spark.createDataFrame([(1 if i % 2 else i,) for i in range(9000)], "k long")
    table = stored(rows.groupBy("k").agg(F.count("*").alias("uses"), (F.first("k") * 2).alias("v")), "test")
    out = looked_up(rows, table, ["k"], "uses")
    assert out.count() == 9000 and out.where("v <> 2 * k").isEmpty() and out.columns == ["k", "v"]


def test_url_filter_is_native(spark):
    import contextlib
    import io

    none = spark.createDataFrame([("a.b", 3, 1)], "host string, n_labelled long, n_bad long")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        judged_urls(spark.range(9).select(F.col("id").alias("page_id"), F.format_string("http://a%d.b/", "id").alias("url")), none, RULES).explain("extended")
    assert not re.search(r"Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", text.getvalue())


# --- hard negatives -------------------------------------------------------------------------------------------------


def brute_negatives(rows, is_anchor, k=5, low=80, of=100, scale=256.0):
    used = []
    for key, label, vector in rows:
        if key is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            used.append((key, label, [math.floor(scale * x) for x in vector]))
    out = []
    for key, label, vector in used:
        if not is_anchor(key):
            continue
        met = [(sum(a * b for a, b in zip(vector, v, strict=True)), i, lab) for i, lab, v in used if i != key and len(v) == len(vector)]
        best = sorted(((s, i) for s, i, lab in met if lab == label), key=lambda p: (-p[0], p[1]))[:k]
        for score, positive in best:
            fits = sorted(((s, i) for s, i, lab in met if lab != label and low * score <= of * s <= of * score), key=lambda p: (-p[0], p[1]))[:k]
            out += [(key, positive, rank, i, score, s) for rank, (s, i) in enumerate(fits, 1)]
    return sorted(out)


def vectors(seed=1, n=400, dims=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 4))
        rows.append((i, label, (centres[label] * 0.3 + rng.normal(size=dims) * 0.4).round(2).tolist()))
    rows[3] = (3, None, rows[3][2])
    rows[5] = (5, 1, None)
    rows[6] = (6, 1, [None, *rows[6][2][1:]])
    rows[7] = (7, 1, [float("nan"), *rows[7][2][1:]])
    rows[8] = (8, 1, [float("inf"), *rows[8][2][1:]])
    rows[20] = (20, 2, [])
    rows[21] = (21, 2, [])
    rows[22] = (22, 1, [])
    rows[30] = (30, 0, [0.5, 0.5])
    rows[31] = (31, 0, [0.5, 0.25])
    rows[32] = (32, 1, [0.5, 0.25])
    rows[41] = (None, 1, rows[41][2])
    rows += [(500 + i, i % 4, rows[50][2]) for i in range(60)]  # equal vectors: ties
    rows += [rows[60], (60, 3, rows[61][2])]  # repeated key, once with other contents
    return rows


VECTORS = "vec_id long, label int, embedding array<float>, score string, id string, slot string, vector string"


def frame(spark, rows, schema=VECTORS):
    return spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], schema).repartition(5)


@pytest.mark.parametrize("block", [7, 4096])
def test_hard_negatives(spark, block):
    rows = [(k, lab, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, lab, v in vectors()]
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, block=block, cells=3000)
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 300
    assert sorted(map(tuple, got.collect())) == want
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}


def test_hard_negatives_edges(spark):
    assert H.hard_negatives(frame(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    only = [(0, 1, [0.5]), (1, 1, [0.25])]
    assert H.hard_negatives(frame(spark, only), F.col("vec_id") == 0).collect() == []
    doubles = [(0, 1, [1e9, 1.0]), (1, 1, [1e9, 2.0]), (2, 0, [9e8, 1.0]), (3, 0, [1e9, 2.0])]
    schema = VECTORS.replace("float", "double")
    got = H.hard_negatives(frame(spark, doubles, schema), F.col("vec_id") == 0).collect()
    top = (1 << 63) - 1
    assert [(r.negative_id, r.negative_score) for r in got] == [(2, top), (3, top)]
    wide = [(0, 1, [2e5, 1.0]), (1, 1, [2e5, 2.0]), (2, 0, [2e5, 1.9]), (3, 0, [2e5, 2.1])]
    got = H.hard_negatives(frame(spark, wide, schema), F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, got)) == brute_negatives(wide, lambda i: i == 0)


# --- collocations ---------------------------------------------------------------------------------------------------


def brute_collocations(rows, threshold, top=2000, absorb=80, of=100, longest=4):
    counts, n_words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n_words[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if a >= threshold}
        inside = Counter()
        for p, a in frequent.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], a)
        rows_of = []
        for p, a in frequent.items():
            if len(p) > 1 and of * inside[p] < absorb * a:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows_of.append((score, a, " ".join(p), left, right))
        rows_of.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, left, right, n_words[lang], s) for i, (s, a, p, left, right) in enumerate(rows_of[:top], 1)]
    return sorted(out)


def phrase_rows(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice('abÄé')}{i}" for i in range(25)] + ["AB", "ab", "日本", "\u00a0x", "a" * 300]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "!?", " - ", "\u2028"]
    rows = [(None, "en"), ("", None), (" .,;\n", "de"), ("one", "en"), ("One", "en")]
    for _ in range(150):
        n = rng.randint(1, 60)
        text = "".join(rng.choice(vocabulary) + rng.choices(ends, [40, 3, 2, 4, 2, 2, 1, 1, 1])[0] for _ in range(n))
        rows.append((text, rng.choice(["en", "en", "de", None, "und", ""])))
    rows += [("new york is far from new york city hall", "en")] * 12
    return rows


@pytest.mark.parametrize(("threshold", "more"), [(4, {}), (3, {"stretch": 600, "top": 20, "map_bits": 6})])
def test_collocations(spark, threshold, more):
    rows = phrase_rows()
    docs = spark.createDataFrame([(t, lang, "x", None, 7) for t, lang in rows], "text string, lang string, phrase string, rank string, a int").repartition(4)
    got = C.collocations(docs, threshold=threshold, **more)
    want = brute_collocations(rows, threshold, more.get("top", 2000))
    assert len(want) > 40
    assert sorted(map(tuple, got.collect())) == want


def test_collocations_edges(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert C.collocations(empty).collect() == []
    nothing = spark.createDataFrame([(None, None), ("a b", "en")], "text string, lang string")
    assert C.collocations(nothing).collect() == []


def test_best_per_group_in_steps(spark):
    rows = spark.range(120_000).select(F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("g"), (F.col("id") % 1000).alias("s"), F.col("id").cast("string").alias("p"))
    got = C.best_per_group(rows, "g", [F.col("s").desc(), F.col("p")], "p", 30).collect()
    want = sorted(((r.g, -r.s, r.p) for r in rows.collect()))
    for g in "ab":
        assert [(r.g, -r.s, r.p) for r in sorted(got, key=lambda r: r["rank"]) if r.g == g] == [w for w in want if w[0] == g][:30]


def test_misra_gries_keeps_what_is_frequent():
    rng = np.random.default_rng(8)
    keys = np.concatenate([rng.integers(0, 50_000, 60_000), np.repeat(np.arange(100), 40)]).astype(np.uint64)
    rng.shuffle(keys)
    summary = C.MisraGries(len(keys) // 30 + 1)
    for part in np.array_split(keys, 17):
        summary.merge(*C.summed(part))
        assert len(summary.keys) <= summary.capacity
    exact = Counter(keys.tolist())
    assert summary.taken < 30
    found = set(summary.at_least(30).tolist())
    assert {k for k, n in exact.items() if n >= 30} <= found
    for key, count in zip(summary.keys.tolist(), summary.counts.tolist(), strict=True):
        assert count <= exact[key] <= count + summary.taken


def test_summaries_are_packed_whole():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 50, 5000).astype(np.uint64))
    counts = rng.choice([1, 2, 254, 255, 256, 1 << 40], len(keys))
    body = C.packed_summary(keys, counts)
    back = C.unpacked_summary(body)
    assert (back[0] == keys).all() and (back[1] == counts).all() and C.mass_of(body) == counts.sum()
