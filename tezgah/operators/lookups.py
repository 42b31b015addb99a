"""Surrogate-key lookups between facts and dimensions.

A lookup needs a few numbers of a dimension row. Up to ``SENT_KEYS`` rows,
which are counted, go to all executors, so that whole facts are not shuffled
for the keys of stores or employees. Past that Spark decides from the size
(``spark.sql.autoBroadcastJoinThreshold``, AQE): the joins are sort-merge joins
on the business key and AQE splits skewed partitions. The one key known
beforehand to be hot, the unknown member, is spread by hand.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.functions.expressions import UNKNOWN

OPEN_END = date(9999, 12, 31)
SLOTS = 512  # copies of the unknown member's row, unless the caller asks for more
#: Rows of a lookup's side that are broadcast, and values (rows by columns); more are joined by a shuffle. The driver
#: builds the table that is sent: 5.4 million rows of two columns took it over 750 MB of heap and less than 1,500, and
#: 7.2 million of four over 1,500.
SENT_KEYS = 6_000_000
SENT_VALUES = 12_000_000
#: Rows of a dimension with its texts that are broadcast.
SENT_ROWS = 1_000_000
_RESERVED = -(2**63)  # start of a key range of 2^62 keys no dimension uses


def _spread(key: str, spread_on: Sequence[str], slots: int | None = None) -> Column:
    """The key, or a reserved key where it is NULL or unknown: one of ``slots``, or any."""
    hashed = F.xxhash64(*spread_on)
    slot = F.shiftrightunsigned(hashed, 2) if slots is None else F.pmod(hashed, F.lit(slots))
    hopeless = F.col(key).isNull() | (F.col(key) == UNKNOWN)
    return F.when(hopeless, slot + F.lit(_RESERVED)).otherwise(F.col(key).cast("bigint"))


def few(df: DataFrame, rows: int | None = None) -> bool:
    """Whether the frame has ``rows`` at most (``SENT_ROWS`` if not given); counts it."""
    return df.count() <= (SENT_ROWS if rows is None else rows)


def sent_if_few(side: DataFrame, counted: DataFrame) -> DataFrame:
    """``side`` of a join, for a broadcast if ``counted``, which has as many rows or more, is few.

    The more columns ``side`` has, the fewer rows are few. A session that turns automatic broadcasts off gets none here either.
    """
    off = side.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return side if off or not few(counted, min(SENT_KEYS, SENT_VALUES // len(side.columns))) else F.broadcast(side)


def point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: Column,
    take: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Joins each fact to the dimension version valid on its day.

    Equality on the business key, with the half of the calendar the version
    covers as residual condition. ``take`` maps dimension columns to output
    names. ``how='left'`` keeps facts without a version (as rejects).
    """
    side = versions.select(
        F.col(key).alias("_key"),
        F.col("scd_start_date").alias("_from"),
        F.coalesce("scd_end_date", F.lit(OPEN_END)).alias("_to"),
        *[F.col(source).alias(name) for source, name in take.items()],
    )
    valid = (F.col(key) == F.col("_key")) & at.between(F.col("_from"), F.col("_to"))
    return facts.join(sent_if_few(side, versions), valid, how).drop("_key", "_from", "_to")


def current_key(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    sk: str,
    spread_on: Sequence[str],
    default: int | None = None,
) -> DataFrame:
    """Left lookup of the current surrogate key, ``default`` where there is none.

    Rows with a NULL or unknown business key resolve to ``default`` in any
    case. They join on reserved keys no dimension row has, so they spread
    over the partitions of the join without matching anything.
    """
    if "is_current" in dimension.columns:
        dimension = dimension.filter("is_current")
    # One row per business key, so that a doubled dimension row cannot double facts.
    side = (
        dimension.filter(F.col(key) != UNKNOWN)
        .groupBy(F.col(key).cast("bigint").alias("_key"))
        .agg(F.min(sk).alias("_found"))
    )
    joined = facts.withColumn("_lookup", _spread(key, spread_on)).join(
        sent_if_few(side, dimension), F.col("_lookup") == F.col("_key"), "left"
    )
    found = F.col("_found") if default is None else F.coalesce("_found", F.lit(default))
    return joined.withColumn(sk, found.cast("bigint")).drop("_key", "_lookup", "_found")


def with_member(
    facts: DataFrame,
    dimension: DataFrame,
    sk: str,
    take: Mapping[str, str],
    spread_on: Sequence[str],
    how: str = "inner",
    slots: int = SLOTS,
) -> DataFrame:
    """Joins dimension attributes by surrogate key, with the unknown member spread.

    The unknown member's single row is repeated once for each of ``slots``
    reserved keys and its facts pick one by hash; every other key stays one
    row. Take as many slots as the join has partitions, or more.
    """
    copies = F.transform(
        F.sequence(F.lit(0), F.lit(slots - 1)), lambda slot: slot + F.lit(_RESERVED)
    )
    keys = F.when(F.col(sk) == UNKNOWN, copies).otherwise(F.array(F.col(sk).cast("bigint")))
    side = dimension.select(
        *[F.col(source).alias(name) for source, name in take.items()],
        F.explode(keys).alias("_sk"),
    )
    keyed = facts.withColumn("_lookup", _spread(sk, spread_on, slots))
    return keyed.join(side, F.col("_lookup") == F.col("_sk"), how).drop("_sk", "_lookup")
