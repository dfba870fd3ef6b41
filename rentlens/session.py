"""The Spark session used by the command line and the tests."""

from pyspark.sql import SparkSession


def get_spark(
    app_name: str = "rentlens",
    master: str | None = None,
    driver_memory: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build or reuse a session. Unset arguments are left to the cluster's own configuration."""
    conf = {
        # Calendar months must not move with the machine's time zone.
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "snappy",
        # AQE sizes the shuffle partitions, splits hot ones and switches small sides to broadcast.
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**conf, **(extra_conf or {})}.items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark
