"""CSV files in and out, and a manifest of what was written."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tezgah.schemas import STAGING


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A staging CSV with header under its declared schema; empty fields are NULL.

    The schema is given, not inferred, so the file is read once; Spark splits
    it over the executors, which replaces reading it in chunks.
    """
    return (
        spark.read.schema(STAGING[table])
        .option("header", True)
        .option("nullValue", "")
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, table: str) -> None:
    """Writes the columns the staging file declares, in its order."""
    names = [field.split()[0] for field in STAGING[table].split(", ")]
    df.select(*[c for c in names if c in df.columns]).write.option("header", True).option("nullValue", "").csv(path)


def manifest(files: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, file_path, row_count, file_size)`` per data file, sorted."""
    parts = [
        frame.select(
            F.lit(name).alias("table_name"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("table_name", "file_path")
        .agg(F.count("*").alias("row_count"), F.max("file_size").alias("file_size"))
        for name, frame in files.items()
    ]
    listing = parts[0]
    for part in parts[1:]:
        listing = listing.unionByName(part)
    return listing.orderBy("table_name", "file_path")
