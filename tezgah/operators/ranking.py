"""Global row numbers and NTILE without pulling the rows into one task.

A window without PARTITION BY sorts everything in a single task. Here rows
are range-partitioned and sorted, each row notes its place in its partition,
and one count per partition (a few numbers per task) turns the places into
global positions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.functions.literals import literal_rows
from tezgah.sources.shared import cut

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row number below


@dataclass(frozen=True)
class Score:
    """An NTILE to compute: a numeric column and its direction.

    NULLs sort last when ascending and first when descending.
    """

    column: str
    descending: bool = False


def _positions(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds ``_pos`` (from 0, per group in the given order) and ``_size``."""
    placed = cut(
        df.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", _LOCAL_BITS)
    pieces = (
        placed.groupBy(part.alias("_part"), F.col(group).alias("_group"))
        .agg(F.count("*").alias("n"), F.min("_slot").alias("first"))
        .orderBy("_part", "_group")
        .collect()  # bounded: one row per partition and group
    )
    seen: dict[int, int] = {}
    offsets = []
    for piece in pieces:
        before = seen.get(piece["_group"], 0)
        offsets.append((piece["_part"], piece["_group"], before - piece["first"]))
        seen[piece["_group"]] = before + piece["n"]
    shifts = literal_rows(
        df.sparkSession,
        [(p, g, shift, seen[g]) for p, g, shift in offsets],
        "_part bigint, _group int, _shift bigint, _size bigint",
    )
    on = (part == F.col("_part")) & (F.col(group) == F.col("_group"))
    return (
        placed.join(F.broadcast(shifts), on)
        .withColumn("_pos", F.col("_slot") + F.col("_shift"))
        .drop("_part", "_group", "_shift", "_slot")
    )


def global_row_number(
    df: DataFrame, order: Sequence[str], name: str, start: int | Column = 1
) -> DataFrame:
    """Dense numbers from ``start`` over the whole frame in the given order."""
    numbered = _positions(df.withColumn("_one", F.lit(0)), "_one", order)
    start = F.lit(start) if isinstance(start, int) else start
    return numbered.withColumn(name, F.col("_pos") + start).drop("_one", "_pos", "_size")


def ntiles(
    df: DataFrame, key: str, scores: Mapping[str, Score], buckets: int
) -> DataFrame:
    """``(key, <name>, ...)`` with one NTILE column per score, ties broken by key.

    ``key`` must be unique. All scores share one shuffle: each row is stacked
    once per score, the stack is ranged by (score, value, key), then folded
    back by key.
    """
    entries = []
    for number, score in enumerate(scores.values()):
        value = F.col(score.column).cast("decimal(38,6)")
        nulls = F.when(value.isNull(), -1 if score.descending else 1).otherwise(0)
        entries.append(
            F.struct(
                F.lit(number).alias("_score"),
                nulls.alias("_nulls"),
                (-value if score.descending else value).alias("_value"),
            )
        )
    stacked = df.select(key, F.inline(F.array(*entries)))
    ranked = _positions(stacked, "_score", ["_nulls", "_value", key])
    small = F.floor(F.col("_size") / buckets)
    larger = F.col("_size") % buckets  # this many buckets hold one row more
    edge = larger * (small + 1)
    bucket = F.when(F.col("_pos") < edge, F.floor(F.col("_pos") / (small + 1))).otherwise(
        larger + F.floor((F.col("_pos") - edge) / F.greatest(small, F.lit(1)))
    )
    ranked = ranked.withColumn("_bucket", (bucket + 1).cast("int"))
    return ranked.groupBy(key).agg(
        *[
            F.max(F.when(F.col("_score") == number, F.col("_bucket"))).alias(name)
            for number, name in enumerate(scores)
        ]
    )
