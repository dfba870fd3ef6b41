"""The operators applied to the whole test tables, with SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .content_sort import content_sort
from .collocations import collocations
from .fingerprints import edited_fingerprints
from .hard_negatives import hard_negatives
from .language_id import predict_languages
from .ngram_join import ngram_components
from .packing import packed_documents
from .pieces import round_trip
from .sharding import stratified_shards
from .suffix_dedup import repeated_windows
from .toxicity import fit_toxicity, score_toxicity
from .url_filter import Rule, host_of, judged_urls, path_of
from .warc import read_archives, write_archives


ROOT = str(Path(__file__).resolve().parents[2])


# What Python workers free goes back to the system: by default the C library keeps blocks of up to 32 MB for itself, and
# the workers of an executor then hold hundreds of MB that none of them uses.
WORKERS = {"MALLOC_MMAP_THRESHOLD_": "4194304", "MALLOC_TRIM_THRESHOLD_": "33554432", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}
BATCH_ROWS = 2048  # rows of an Arrow batch: texts of a few KB come in batches of a few MB


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder. Python workers also look for this package where the driver found it."""
    for key, value in {"PYTHONPATH": ROOT, **WORKERS}.items():
        spark.sparkContext.environment.setdefault(key, value)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    out = edited_fingerprints(table(spark, folder, "documents"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", F.hex("fingerprint").alias("fingerprint"), F.hex("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next"
    )


def ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_components(table(spark, folder, "documents"), n=4, num=85, den=100)


def sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return content_sort(table(spark, folder, "documents"))


# Fixed value: the added token of byte_bpe_50k.json.
SPECIAL = (("<|endoftext|>", 50256),)


def packed_tokens(docs: DataFrame) -> DataFrame:
    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special=SPECIAL)


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_tokens(table(spark, folder, "documents"))


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_shards(table(spark, folder, "documents"))


def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_windows(table(spark, folder, "documents"))


def warc(spark: SparkSession, folder: str) -> DataFrame:
    read = read_archives(write_archives(table(spark, folder, "pages")), with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "block_ok", "payload_ok")


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return predict_languages(table(spark, folder, "documents"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, folder, "labels")))


RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The path of a page names the document it shows; a page of a document labelled toxic or of low quality is a bad outcome."""
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    number = F.regexp_extract(path_of(F.col("url")), "^/[a-z]+/([0-9]{1,18})", 1)
    shown = pages.select(host_of(F.col("url")).alias("host"), number.try_cast("long").alias("doc_id"))
    shown = shown.where("doc_id is not null").groupBy("host", "doc_id").agg(F.count("*").alias("n"))
    bad = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.expr("int(coalesce(toxic, 0) = 1 or coalesce(quality, 1) = 0)")).alias("bad"))
    labelled = shown.join(bad, "doc_id").groupBy("host").agg(F.sum("n").alias("n_labelled"), F.sum(F.col("n") * F.col("bad")).alias("n_bad"))
    return judged_urls(pages, labelled, RULES)


def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    shifted = F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
    return hard_negatives(table(spark, folder, "embeddings"), F.expr("vec_id % 100 = 0"), label_column=shifted)


def phrases(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": fingerprints,
    "op2_ngram_join": ngram_join,
    "op3_sentencepiece": sentencepiece,
    "op4_exact_dedup": exact_dedup,
    "op5_packing": packing,
    "op6_sharding": sharding,
    "op7_suffix_dedup": suffix_dedup,
    "op8_warc": warc,
    "op9_language_id": language_id,
    "op10_toxicity": toxicity,
    "op11_url_filter": url_filter,
    "op12_hard_negatives": mined_negatives,
    "op13_collocations": phrases,
    "pipeline": pipeline,
}

_SPACES = r"[\x20\x09-\x0D]+"

SQL: dict[str, str] = {
    "op2_ngram_join": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM split),
sized AS (SELECT doc_id, len(s) AS n, s FROM shingled),
flat AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
pairs AS (
  SELECT a.doc_id AS u, b.doc_id AS v, a.n AS an, b.n AS bn, count(*) AS common FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM pairs WHERE 100 * common >= 85 * (an + bn - common)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS node, doc_id AS label FROM documents UNION SELECT e.v, r.label FROM reach r JOIN edges e ON r.node = e.u)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, r.component_id
FROM sized s JOIN (SELECT node, min(label) AS component_id FROM reach GROUP BY node) r ON r.node = s.doc_id
""",
    "op4_exact_dedup": rf"""
WITH normal AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM normal WINDOW same AS (PARTITION BY text_sha256)
""",
    "op8_warc": """
WITH body AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
told AS (SELECT page_id, html, min(page_id) OVER (PARTITION BY html) AS first_id, CAST(unhex(sha1(html)) AS BIT)::VARCHAR AS bits FROM body)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(16 * CAST(bits[5*i+1] AS INT) + 8 * CAST(bits[5*i+2] AS INT)
    + 4 * CAST(bits[5*i+3] AS INT) + 2 * CAST(bits[5*i+4] AS INT) + CAST(bits[5*i+5] AS INT) AS BIGINT), 1) FOR i IN range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to,
  true AS block_ok, CASE WHEN page_id = first_id THEN true END AS payload_ok
FROM told
""",
    "op11_url_filter": """
WITH page AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
label AS (SELECT doc_id, max(CAST(coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 AS BIGINT)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
shown AS (SELECT host, try_cast(regexp_extract(path, '^/[a-z]+/([0-9]{1,18})', 1) AS BIGINT) AS doc_id FROM page),
host AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM shown LEFT JOIN label USING (doc_id) GROUP BY host),
bare AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS parts FROM host),
depth AS (
  SELECT *, CASE WHEN regexp_matches(array_to_string(parts, '.'), '^[0-9.]+$') THEN len(parts)
    WHEN array_to_string(parts[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.jp', 'co.in', 'com.br', 'co.za', 'com.cn', 'com.mx') THEN 2
    ELSE 1 END AS k FROM bare),
placed AS (
  SELECT host, n, bad, array_to_string(parts[greatest(len(parts) - k + 1, 1):], '.') AS suffix, array_to_string(parts[greatest(len(parts) - k, 1):], '.') AS domain FROM depth),
top0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 0.5) / (sum(n) + 1) FROM placed) AS m FROM placed GROUP BY suffix),
top1 AS (
  SELECT *, (SELECT CASE WHEN share > 0 THEN least(greatest(1 / share - 1, 1.0), 1e6) ELSE 1e6 END FROM (
    SELECT sum((bad - n * m) * (bad - n * m) - n * m * (1 - m)) / nullif(sum(n * m * (1 - m) * (n - 1)), 0) AS share FROM top0)) AS s FROM top0),
dom0 AS (
  SELECT d.domain, d.n, d.bad, (t.s * t.m + t.bad) / (t.s + t.n) AS m FROM (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM placed GROUP BY ALL) d JOIN top1 t USING (suffix)),
dom1 AS (
  SELECT *, (SELECT CASE WHEN share > 0 THEN least(greatest(1 / share - 1, 1.0), 1e6) ELSE 1e6 END FROM (
    SELECT sum((bad - n * m) * (bad - n * m) - n * m * (1 - m)) / nullif(sum(n * m * (1 - m) * (n - 1)), 0) AS share FROM dom0)) AS s FROM dom0),
host0 AS (SELECT p.host, p.n, p.bad, (d.s * d.m + d.bad) / (d.s + d.n) AS m FROM placed p JOIN dom1 d USING (domain)),
host1 AS (
  SELECT *, (SELECT CASE WHEN share > 0 THEN least(greatest(1 / share - 1, 1.0), 1e6) ELSE 1e6 END FROM (
    SELECT sum((bad - n * m) * (bad - n * m) - n * m * (1 - m)) / nullif(sum(n * m * (1 - m) * (n - 1)), 0) AS share FROM host0)) AS s FROM host0),
host2 AS (SELECT host, n, bad, s * m + bad AS a, s * (1 - m) + n - bad AS b FROM host1),
told AS (SELECT host, n, bad, greatest(a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0.0) AS bound FROM host2),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM page)
SELECT page_id, r.host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN bound >= 0.25 THEN 'block' ELSE 'allow' END AS verdict,
  CAST(n AS BIGINT) AS n_labelled, CAST(bad AS BIGINT) AS n_bad, round(bound, 6) AS bad_bound
FROM ruled r JOIN told USING (host)
""",
    "op12_hard_negatives": """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positive AS (SELECT * FROM met WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS rank
  FROM positive p JOIN met n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
""",
    "op13_collocations": r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM split, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
total AS (SELECT lang, count(*) AS n FROM gram WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, phrase, k, count(*) AS a FROM gram GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM f WHERE k > 1),
told AS (
  SELECT x.lang, x.phrase, x.k, x.a, x.c, l.a AS l, r.a AS r, CAST(CAST(2000000 AS HUGEINT) * x.a // (l.a + r.a) AS BIGINT) AS score
  FROM cut x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:x.c], ' ') JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[x.c + 1:], ' ')),
lowest AS (SELECT * FROM told QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_phrase AS (
  SELECT lang, a, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase
  FROM (SELECT lang, k, a, string_split(phrase, ' ') AS w FROM f), (VALUES (2), (3)) AS sizes(m) WHERE m < k),
longer AS (SELECT lang, phrase, max(a) AS a FROM inner_phrase GROUP BY ALL),
kept AS (
  SELECT c.* FROM lowest c LEFT JOIN longer o ON o.lang = c.lang AND o.phrase = c.phrase WHERE o.a IS NULL OR 100 * o.a < 80 * c.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
}
