"""Keep-first and insert-unless-present, by an explicit key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tezgah.sources.shared import stored

#: Hashes of repeated keys that are broadcast, 8 bytes each; beyond that whole rows are shuffled.
SENT_HASHES = 1_000_000


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, then by every other column.

    A minimum over a struct instead of ``row_number``: copies of a key
    collapse before the shuffle, so a key holding a third of all rows sends
    one row per task and not its copies. NULLs sort first.
    """
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_mark``: the 64-bit hashes of keys that two or more rows have, by a count over the hash alone."""
    counted = df.select(F.xxhash64(*keys).alias("_mark")).groupBy("_mark").agg(F.count("*").alias("_n"))
    return counted.filter("_n > 1").select("_mark")


def keep_first_stored(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sent: int | None = None, target: DataFrame | None = None
) -> DataFrame:
    """As ``keep_first``, for rows read from storage, which it reads twice; none whose key ``target`` has.

    The minimum over a struct shuffles and sorts whole rows, and so does a join
    with ``target``. Here a first pass counts the keys of both, opening their
    columns only. The hashes that came twice or more are written out and counted:
    up to ``sent`` of them are broadcast, so that all other rows pass without a
    shuffle and the minimum and the join see just the copies, however many one key
    has. Beyond that most rows would have to be shuffled anyway, and the minimum
    over all is the shorter way. Keys of equal hash are told apart by the minimum
    and the join. In the minimum NULLs in a key are equal to each other, in the join
    they match nothing. Both ways give the same rows.
    """
    seen = df.select(*keys) if target is None else df.select(*keys).unionByName(target.select(*keys))
    twice = stored(repeated(seen, keys), "repeated")
    if twice.count() > (SENT_HASHES if sent is None else sent):
        return _not_in(target, keep_first(df, keys, order), keys)
    # hashed as the type that both sides have in common
    marked = df.withColumn("_mark", F.xxhash64(*[F.col(k).cast(seen.schema[k].dataType) for k in keys]))
    single = marked.join(F.broadcast(twice), "_mark", "left_anti").select(*df.columns)
    copies = marked.join(F.broadcast(twice), "_mark", "left_semi").select(*df.columns)
    return single.unionByName(_not_in(target, keep_first(copies, keys, order), keys))


def _not_in(target: DataFrame | None, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows if target is None else rows.join(target.select(*keys), list(keys), "left_anti")


def insert_skip_conflicts(
    target: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[str], in_storage: bool = False
) -> DataFrame:
    """The rows of ``incoming`` to append: first per key, none already in ``target``.

    ``in_storage`` says that ``incoming`` is read from storage, so that reading it twice costs no joins.
    """
    if in_storage:
        return keep_first_stored(incoming, keys, order, target=target)
    return _not_in(target, keep_first(incoming, keys, order), keys)
