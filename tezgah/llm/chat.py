"""Chat formatting: a dialogue seen from each of its participants, in DataFrame functions only.

For every speaker the dialogue is rendered with that speaker as the assistant
and all others as named users; the mask marks what the assistant says. A row
holds up to ``PART`` turns, so a dialogue of any length is spread over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tezgah.llm.common import partitions
from tezgah.sources.shared import stored

PART = 512
#: The role that is no participant, and the name of a speaker without one.
SYSTEM, NAMELESS = "system", "unknown"
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
_ORDER = ["turn", "role", "text"]


def _plain(text: Column) -> Column:
    """A text that cannot be taken for a header."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def turns_in_parts(conversations: DataFrame, part: int = PART) -> DataFrame:
    """``(conv_id, part, turns)``: up to ``part`` turns ``(position, role, text)`` of a conversation, in order.

    Turns are numbered by a range-partitioned sort: each range numbers its own
    rows, and only conversations that cross from one range to the next, at most
    one for each range, are moved on by what came before.
    """
    spark = conversations.sparkSession
    rows = (
        conversations.where("conv_id is not null")
        .select("conv_id", "turn", F.coalesce("role", F.lit(NAMELESS)).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .distinct()
        .repartitionByRange(partitions(spark), "conv_id", *_ORDER)
        .select("*", F.spark_partition_id().alias("block"))
    )
    rows = stored(rows, "turns")
    counts = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select("conv_id", "block", F.sum("n").over(so_far).alias("before")).where("before > 0")  # a row for each range at most
    within = F.row_number().over(Window.partitionBy("block", "conv_id").orderBy(*_ORDER))
    numbered = rows.withColumn("nth", within - 1).join(F.broadcast(moved), ["conv_id", "block"], "left")
    position = (F.col("nth") + F.coalesce("before", F.lit(0))).alias("position")
    placed = numbered.select("conv_id", position, "role", "text").withColumn("part", F.floor(F.col("position") / part))
    return placed.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("position", "role", "text"))).alias("turns"))


def perspectives(conversations: DataFrame, part: int = PART) -> DataFrame:
    """``(conv_id, assistant, part, n_turns, n_learned, text, mask)`` for every participant and part.

    Participants are the roles of a conversation but ``system``, which every
    rendering has as it is. ``mask`` lists the spans ``[start, stop)`` of
    ``text``, in characters, that the assistant says, end mark included. Turns
    go by ``turn``, ties by role and text; a NULL turn comes first; a row that
    repeats another in all of these counts once. A NULL role is the speaker
    ``unknown``, a NULL text is empty. Rows without ``conv_id`` are left out, a
    conversation without participants gives no row, nor does an empty table.
    Other columns are ignored.
    """
    parts = turns_in_parts(conversations, part)
    speakers = conversations.where("conv_id is not null").select("conv_id", F.coalesce("role", F.lit(NAMELESS)).alias("assistant")).distinct()
    seen = parts.join(speakers.where(F.col("assistant") != SYSTEM), "conv_id")

    def said(turn: Column) -> Column:
        own = turn.role == F.col("assistant")
        head = F.when(turn.role == SYSTEM, F.lit(SYSTEM)).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user:"), _plain(turn.role)))
        return F.struct(own.alias("own"), F.concat(F.lit(OPEN), head, F.lit(CLOSE)).alias("head"), F.concat(_plain(turn.text), F.lit(END)).alias("body"))

    span = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("stop"))
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m.head)
        stop = start + F.length(m.body)
        return F.struct(stop.cast("long").alias("at"), F.when(m.own, F.concat(acc.spans, F.array(span(start, stop)))).otherwise(acc.spans).alias("spans"))

    messages = seen.select("conv_id", "assistant", "part", F.transform("turns", said).alias("messages"))
    return messages.select(
        "conv_id", "assistant", "part", F.size("messages").cast("long").alias("n_turns"),
        F.size(F.filter("messages", lambda m: m.own)).cast("long").alias("n_learned"),
        F.array_join(F.transform("messages", lambda m: F.concat(m.head, m.body)), "").alias("text"),
        F.aggregate("messages", nothing, step, lambda acc: acc.spans).alias("mask"),
    )
