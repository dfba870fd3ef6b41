"""CSV and Parquet tables: raw per-city files in, columnar tables and reports out."""

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The dialect of the published files (quotes doubled inside quoted fields).
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"', "inferSchema": False}
# Column that keeps a line with too few or too many fields.
MALFORMED = "_malformed"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).exists(hadoop_path)


def find_csv(spark: SparkSession, folder: str, dataset: str) -> str:
    """The plain file, else the compressed one."""
    for suffix in (".csv", ".csv.gz"):
        path = f"{folder.rstrip('/')}/{dataset}{suffix}"
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"no {dataset}.csv or {dataset}.csv.gz in {folder}")


def read_csv(spark: SparkSession, path: str, multiline: bool = True, keep_malformed: bool = False) -> DataFrame:
    """Every column as text; cleaning gives the types. With ``keep_malformed`` a line with too few or too many fields is also
    kept as it is, in a column of its own; its fields are filled from the left either way. Spark refuses queries of a raw file
    that need that column alone: store the rows first.

    Quoted line breaks need ``multiline``, which reads each file in one task. Without them large plain
    files are split among tasks. The path may also be a folder of part files.
    """
    options = {**CSV_DIALECT, "multiLine": multiline}
    if not keep_malformed:
        return spark.read.options(**options).csv(path)
    # Only the first line is read for the names.
    names = [*spark.read.options(**options).csv(path).columns, MALFORMED]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return spark.read.options(**options, columnNameOfCorruptRecord=MALFORMED).schema(schema).csv(path)


def read_city_csv(
    spark: SparkSession, folder: str, dataset: str, city: str, multiline: bool = True, keep_malformed: bool = False
) -> DataFrame:
    rows = read_csv(spark, find_csv(spark, folder, dataset), multiline, keep_malformed)
    return rows.withColumn("city", F.lit(city))


def select_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that the table has, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def unify(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables on the columns that all of them have."""
    common = sorted(set.intersection(*[set(t.columns) for t in tables]))
    return reduce(DataFrame.unionByName, [t.select(*common) for t in tables])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(
    df: DataFrame, path: str, partition_by: str | Sequence[str] | None = None, mode: str = "overwrite"
) -> None:
    """Write Parquet. Rows are rebalanced by the partition columns first, which keeps the number of
    files down without putting a large partition into a single task."""
    if partition_by:
        keys = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def export_report(df: DataFrame, path: str, single_csv: bool = False) -> DataFrame:
    """Store a report as Parquet and, if asked, as one CSV file built from the stored rows.

    Meant for aggregated reports: the single file is written by one task.
    """
    df.write.mode("overwrite").parquet(f"{path}.parquet")
    stored = df.sparkSession.read.parquet(f"{path}.parquet")
    if single_csv:
        stored.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}.csv")
    return stored

