"""From raw documents to packed token sequences, in five stages that each take and leave a table.

toxicity            documents that the classifier rejects go
exact_dedup         of texts that are equal after white space is evened, the one with the smallest doc_id stays
ngram_jaccard_join  of documents linked by five-word shingles (Jaccard similarity 0.8 or more), one of each group stays
suffix_dedup        bytes under repeated windows of 200 bytes go out of the texts, every document stays
packing             the token pieces of the documents, with their places in sequences of 2048 tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm.content_sort import without_copies
from rentlens.llm.entries import packed_tokens, table
from rentlens.llm.frames import stored
from rentlens.llm.ngram_join import BROADCAST_ROWS, ngram_components
from rentlens.llm.suffix_dedup import without_repeats
from rentlens.llm.toxicity import fit_toxicity, without_toxic


MARK = "_row_mark"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row with the smallest doc_id stays; a row without a key stays only where the whole group has none.

    Rows go by a hash of key and text, so rows that repeat a key are told apart; rows equal in both, of which the stage before
    leaves one, go or stay together.
    """
    marked = docs.withColumn(MARK, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    found = ngram_components(marked, n=5, num=80, den=100, id_column=MARK).withColumnsRenamed({"doc_id": MARK, "component_id": "group"})
    found = stored(found.where(F.col("n_shingles") > 0).select(MARK, "group").distinct(), "groups")
    several = stored(found.join(found.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group"), "group"), "groups")
    keys = marked.select(MARK, F.col("doc_id").alias("id")).distinct()
    members = stored(several.join(keys, MARK), "members")
    first = members.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", MARK)).alias("first"))
    gone = stored(members.join(first, "group").where(F.col(f"first.{MARK}") != F.col(MARK)).select(MARK), "gone")
    return marked.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, MARK, "left_anti").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs, edit=lambda text: {"n_chars": F.length(text).cast("long")})


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_tokens(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

# SQL states neither a trained classifier nor a tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that stay."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
