"""Proportional stratified interleaving of rows into shards, with DataFrame operations only.

The rows of each stratum are shuffled by a seeded hash and get the fractional rank (rank - 1/2) / size; the rows of all
strata sorted by fractional rank are cut into equal runs, so every run holds each stratum in proportion, give or take a row.
Ranks are taken in two steps: counts of hash slots (or rank slots), whose running sums give each slot its first rank, and
row numbers inside a slot. A slot holds about ``SLOT_ROWS`` rows, however large its stratum is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import stored, whole_text

SLOT_ROWS = 50_000


def _ranked(df: DataFrame, stratum: list[str], slot: str, order: list[Column | str], name: str) -> DataFrame:
    """``name``: the 0-based rank of each row in its stratum by (slot, order); ``_size``: the rows of its stratum."""
    counts = df.groupBy(*stratum, slot).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*stratum).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*stratum)
    first = counts.withColumns({"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "_size": F.sum("_rows").over(whole)}).drop("_rows")
    inside = F.row_number().over(Window.partitionBy(*stratum, slot).orderBy(*order)) - F.lit(1)
    return df.join(first, [*stratum, slot]).withColumn(name, F.col("_before") + inside.cast("long")).drop("_before")


def seeded_hash(seed: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def interleaved(rows: DataFrame, stratum: str, key: str, n_shards: int, seed: int, order: list[str]) -> DataFrame:
    """The rows with shard (int) and slot (long, gapless from 0 in each shard); shard sizes differ by one at most.

    ``order`` breaks ties of the seeded hash. A missing stratum is a stratum of its own.
    """
    n = rows.agg(F.count("*")).first()[0]
    slots = max(1, -(-n // SLOT_ROWS))
    lot = seeded_hash(seed, F.col(key))
    # A stratum's name is coalesced with a mark, as a missing one must meet itself in the joins.
    dealt = rows.withColumns({"_stratum": F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("-")), "_lot": lot})
    dealt = dealt.withColumn("_lot_slot", F.pmod(F.col("_lot"), F.lit(slots)))
    ranked = stored(_ranked(dealt, ["_stratum"], "_lot_slot", ["_lot", key, *order], "_rank"), "ranked")
    fraction = (F.col("_rank") + F.lit(0.5)) / F.col("_size")
    spread = ranked.withColumn("_fraction", fraction).drop("_size")
    spread = spread.withColumns({"_all": F.lit(0), "_slot": F.floor(F.col("_fraction") * F.lit(slots))})
    placed = _ranked(spread, ["_all"], "_slot", ["_fraction", "_stratum", "_rank"], "_position")
    # Shard s starts at the least position p with floor(p * shards / n) = s.
    done = placed.withColumn("shard", F.expr(f"cast(_position * {n_shards} div {max(n, 1)} as int)"))
    done = done.withColumn("slot", F.col("_position") - F.expr(f"(cast(shard as long) * {n} + {n_shards - 1}) div {n_shards}"))
    return done.drop("_stratum", "_lot", "_lot_slot", "_rank", "_size", "_fraction", "_all", "_slot", "_position")


def stratified_shards(
    docs: DataFrame, n_shards: int = 8, seed: int = 17, id_column: str = "doc_id", text_column: str = "text", stratum_column: str = "source"
) -> DataFrame:
    """doc_id, size, text_crc32, law (``rows``), shard, slot and grown_shard (NULL) of every row.

    size is the text's bytes in UTF-8 plus one; a missing text has none. Rows that repeat a key are told apart by their
    text; of identical rows either may take either place.
    """
    text = whole_text(text_column)
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col(f"`{stratum_column}`").alias("stratum"),
    )
    out = interleaved(rows, "stratum", "doc_id", n_shards, seed, ["text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
