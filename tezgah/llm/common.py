"""Small helpers that several operators use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tezgah.sources.shared import stored


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once per row, not once per use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_row(columns: list[str]) -> Column:
    """The columns as one struct ``row``, so that no added column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """``(row, place)``, stored: each row's columns as a struct and a number of its own, whatever its ``doc_id``."""
    return stored(docs.select(as_row(docs.columns), F.monotonically_increasing_id().alias("place")), name)


def rank(doc_id: Column, text: Column, place: Column) -> Column:
    """The order of rows as a struct: by ``doc_id`` (NULL last), then text, then place."""
    return F.struct(doc_id.isNull().alias("last"), F.coalesce(doc_id, F.lit(0)).cast("long").alias("id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("digest"), place.alias("place"))


#: Rows with whole texts that Spark hands to a Python worker at a time; its own default is 10,000.
TEXTS = 1_000


def few_texts_a_batch(df: DataFrame) -> None:
    """Lowers the session's limit on rows of an Arrow batch, so that batches of long texts stay small on both sides."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= TEXTS:
        conf.set(key, TEXTS)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of digits, a-z (A-Z lower-cased) and all that is not ASCII."""
    return (text or b"").translate(_WORD).split()
