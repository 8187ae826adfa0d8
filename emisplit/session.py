"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime settings only; none of them changes a result.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of sets or long texts go to Python a few megabytes at a time, however many there are.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

#: Bytes that adaptive execution may put in one partition, at most: a task sorts, groups and windows
#: rows that take some 20 times their shuffled size. A session's own smaller setting stays.
_PARTITION = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 << 20)


def tune(spark: SparkSession) -> SparkSession:
    """Turn on adaptive execution with skew splitting for this session."""
    name, most = _PARTITION
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > most:
        spark.conf.set(name, f"{most}b")
    for name, value in _SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(name: str = "emisplit", cores: str = "*", **extra: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
