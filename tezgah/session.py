"""A local session for tests and the benchmark; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tezgah")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
