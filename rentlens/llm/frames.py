"""What the operators share on the Spark side: tables written and read back, and the text of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.sources.scratch import new_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: a cut of the lineage that survives lost executors."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def whole_text(column: str = "text") -> Column:
    """The text of a row; a missing text counts as an empty one."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the key and the text, under fixed names, so that no other column can clash."""
    return docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), whole_text(text_column).alias("text"))


def shuffle_width(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


HEAVY = 2000  # a key with more than one row in so many is frequent; there are fewer such keys than that


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], uses: str, keep_all: bool = False) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per key and, as ``uses``, how many of the rows have it.

    A frequent key would fill one task of a shuffle, so the entries of frequent keys, fewer than ``HEAVY``, are sent to every
    executor; only rows of other keys, each of which is a small share, are joined by shuffle. Rows whose key the table lacks
    are left out, unless ``keep_all``. The table is read several times: it should be a stored one.
    """
    total = table.select(F.sum(uses)).scalar()
    frequent = F.col(uses) * HEAVY > total
    heavy, light = table.where(frequent).drop(uses), table.where(~frequent).drop(uses)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(heavy), keys).unionByName(rest.join(light, keys, "left" if keep_all else "inner"))
