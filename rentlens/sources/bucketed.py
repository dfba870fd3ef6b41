"""Tables stored in buckets of a key, each sorted by it, so that grouping and joining by the key need no shuffle.

Work that meets the same key again and again (days and reviews of a listing) pays the shuffle once, when the table is written.
Two tables with the same number of buckets of their keys are joined bucket by bucket.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import new_folder

BUCKET_BYTES = 256 << 20
BUCKET_ROWS = 500_000


def buckets_for(n_bytes: int, bucket_bytes: int = BUCKET_BYTES, at_least: int = 1) -> int:
    """How many buckets keep each near a size; tables that are joined should share the larger number."""
    return max(at_least, -(-n_bytes // bucket_bytes))


def buckets_for_rows(*tables: DataFrame, bucket_rows: int = BUCKET_ROWS, at_least: int = 1) -> int:
    """The same by rows, for tables whose bytes are not known: enough for the longest of those that are joined, so that what a
    task sorts does not grow with the table."""
    return max(at_least, *[-(-t.count() // bucket_rows) for t in tables])


def write_bucketed(df: DataFrame, key: str, buckets: int, sort_by: Sequence[str] = (), path: str | None = None, name: str | None = None) -> str:
    """Store a table in buckets of a key; returns its name in the catalogue.

    Rows are dealt by the bucket's own hash first, so a bucket is one file, written by one task. A NULL key has a bucket like
    any other. Without a path the files lie in the scratch folder.
    """
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, F.col(f"`{key}`")).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key, *sort_by)
    writer.option("path", path or new_folder(spark, "bucketed")).saveAsTable(name)
    return name


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
