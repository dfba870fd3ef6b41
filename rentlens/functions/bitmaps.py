"""Distinct counts that merge: exact bitmaps of whole-number keys.

Counts of different keys cannot be added up over months, bitmaps can. A bitmap covers 32,768 neighbouring keys; one row per
group and occupied stretch of keys is kept, and a coarser group's bitmaps are the union of the finer ones'.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """``by``, ``stretch`` and ``bitmap`` of the keys that occur in each group; rows without a key add nothing."""
    number = F.col(f"`{key}`").cast("bigint")
    rows = df.where(number.isNotNull()).select(*by, F.bitmap_bucket_number(number).alias("stretch"), F.bitmap_bit_position(number).alias("_bit"))
    return rows.groupBy(*by, "stretch").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*by, "stretch").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_keys(bitmaps: DataFrame, by: Sequence[str], name: str = "n_keys") -> DataFrame:
    """The number of different keys of each group, from the bitmaps of any finer groups."""
    return merged_bitmaps(bitmaps, by).groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
