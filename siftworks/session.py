"""Session and table helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "siftworks", cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
