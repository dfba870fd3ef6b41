"""Named applications of operators to a folder of test tables."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRIES: dict[str, "Entry"] = {}


@dataclass(frozen=True)
class Entry:
    build: Callable[["Tables"], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


class Tables:
    """The tables of a folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def entry(name: str, sql: str | None = None, roles: str = ""):
    """Register a query. ``roles`` names the views, separated by blanks, that its SQL selects from."""
    from .roles import with_roles

    def register(build: Callable[[Tables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(build, with_roles(roles, sql) if sql else None)
        return build

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the fractional columns, so that engines agree on the last bits."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def sql_sum(x: str) -> str:
    """Compensated sum of the unrounded values."""
    return f"fsum({x})"


def sql_avg(x: str) -> str:
    return f"(fsum({x}) / count({x}))"
