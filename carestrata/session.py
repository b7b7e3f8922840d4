"""Session settings every operator relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on; cluster sizing is left to the caller."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "carestrata", options: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.hadoop.parquet.block.size", str(8 * 1024 * 1024))  # small files still split over all cores
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=options or {})
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
