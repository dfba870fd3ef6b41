"""Timing logs of benchmark runs as a table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The log naming and the field that holds one run's time.
LOG_NAME = r"(?:^|[/=])([^/=]+)_(\d+)w\.txt(?:/[^/]*)?$"
WALL_SECS = r'"wall_secs":\s*([0-9.]+)'


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row per run found in ``<workload>_<workers>w.txt`` logs.

    A log may be one file or a folder of parts named like it. Logs are read by line, so large ones
    are split among tasks; files that follow another naming are left out.
    """
    # The file and its folder are all the name can be in. Names are parsed once per file, not per line; few paths are encoded.
    name = F.substring_index("file", "/", -2)
    decoded = F.when(name.contains("%"), F.url_decode(name)).otherwise(name)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("_metadata.file_path").alias("file"))
    logs = (
        found.withColumn("log", decoded)
        .where(F.col("log").rlike(LOG_NAME))
        .select("file", F.regexp_extract("log", LOG_NAME, 1).alias("workload"), F.regexp_extract("log", LOG_NAME, 2).cast("int").alias("workers"))
    )
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return (
        lines.where(F.col("value").contains('"wall_secs"'))
        .join(F.broadcast(logs), "file")  # a row per file
        .select("workload", "workers", F.explode(F.regexp_extract_all("value", F.lit(WALL_SECS), F.lit(1))).alias("secs"))
        .select("workload", "workers", F.col("secs").try_cast("double").alias("wall_secs"))
    )
