"""The product x store stock snapshot.

The warehouse declares this fact and announces its refresh without defining
it; the rules here are ours, from the meaning of the columns.

A snapshot follows from the state before it: stock is that of the earlier day plus
the signed movements since, and the sales of the last 90 days are those of the
earlier day, with the days that entered added and those that left taken away. So a
refresh reads the days since the last state, and as many days that leave the window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.dictionaries import SALE, type_ids
from tezgah.functions.expressions import date_key, major_units, minor_units, ntz
from tezgah.operators.lookups import point_in_time, sent_if_few
from tezgah.plans.batches import BatchLog
from tezgah.plans.sales import SALES
from tezgah.schemas import shaped
from tezgah.sources.shared import CODEC

INVENTORY = "fact.inventory_snapshot"
RATE_DAYS = 90
NEWEST = 20  # states tried before a refresh starts from the first sale again
_PAIR = ["store_id", "product_id"]
_STATE = ["lines", "stock", "sold", "sales"]


@dataclass(frozen=True)
class Earlier:
    """The state of a day before: ``(store_id, product_id, lines, stock, sold, sales)``."""

    state: DataFrame
    day: date


def days_read(day: date, earlier: date | None) -> list[tuple[date | None, date]]:
    """The spans of days whose lines the state of ``day`` needs: all up to it, or those since ``earlier`` and those that leave."""
    if earlier is None:
        return [(None, day)]
    leaving = min(earlier, day - timedelta(RATE_DAYS))
    spans = [(earlier - timedelta(RATE_DAYS - 1), leaving), (earlier + timedelta(1), day)]
    return [(a, b) for a, b in spans if a <= b]


def stock_states(
    sales: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    days: Sequence[date],
    *,
    opening: DataFrame | None = None,
    earlier: Earlier | None = None,
) -> DataFrame:
    """``(store_id, product_id, at, lines, stock, sold, sales)`` at the end of each day, amounts in thousandths.

    Of every product a store has moved or had: ``opening`` is ``(store_id, product_id,
    quantity)``, absent ones are 0. With ``earlier``, whose day lies before all
    others, the lines of ``days_read`` are enough and the opening is in it already.
    All days come from one pass: a line adds to the sums of the days that see it, and
    lines are summed per (store, product) before any join or shuffle.
    """
    days = sorted(days)
    since = earlier.day if earlier else None
    if since and since >= days[0]:
        raise ValueError("the earlier state must lie before all days")
    kind, day = F.col("transaction_type_id"), F.col("transaction_datetime").cast("date")
    moving = sales.filter(kind.isin(type_ids("affects_inventory"))).filter(day <= F.lit(days[-1]))
    amount = minor_units("quantity", 3)
    moved = F.when(kind.isin(type_ids("affects_inventory", "-")), -amount).otherwise(F.abs(amount))
    sums, old = [], []
    for i, at in enumerate(days):
        seen = (day <= F.lit(at)) & (day > F.lit(since) if since else F.lit(True))
        recent = seen & (kind == SALE) & (day > F.date_sub(F.lit(at), RATE_DAYS))
        sign = F.when(recent, 1).otherwise(0)
        kept = since is not None and at - timedelta(RATE_DAYS) < since  # days of the earlier window are in this one too
        if kept:
            leaves = (day > F.date_sub(F.lit(since), RATE_DAYS)) & (day <= F.date_sub(F.lit(at), RATE_DAYS))
            sign = sign - F.when((kind == SALE) & leaves, 1).otherwise(0)
        sums += [
            F.count(F.when(seen, 1)).alias(f"lines{i}"),
            F.sum(F.when(seen, moved).otherwise(0)).alias(f"stock{i}"),
            F.sum(sign * amount).alias(f"sold{i}"),
            F.sum(sign).cast("bigint").alias(f"sales{i}"),
        ]
        old += [F.col(c) * (1 if kept or c in ("lines", "stock") else 0) for c in _STATE]
    by_version = moving.groupBy("store_sk", "product_sk").agg(*sums)
    totals = [f"{c}{i}" for i in range(len(days)) for c in _STATE]
    pairs = by_version.join(sent_if_few(stores.select("store_sk", "store_id"), stores), "store_sk").join(
        sent_if_few(products.select("product_sk", "product_id"), products), "product_sk"
    ).select(*_PAIR, *totals)
    if earlier:
        pairs = pairs.unionByName(earlier.state.select(*_PAIR, *[c.alias(n) for c, n in zip(old, totals, strict=True)]))
    elif opening is not None:
        first = {"lines": F.lit(1).cast("bigint"), "stock": minor_units("quantity", 3)}
        pairs = pairs.unionByName(opening.select(*_PAIR, *[first.get(n.rstrip("0123456789"), F.lit(0).cast("bigint")).alias(n) for n in totals]))
    # Dealt by product, which is enough for this fold and for the join with the products' versions after it.
    per_pair = pairs.repartition("product_id").groupBy(*_PAIR).agg(*[F.sum(c).alias(c) for c in totals])
    states = F.array(*[F.struct(F.lit(at).alias("at"), *[F.col(f"{c}{i}").alias(c) for c in _STATE]) for i, at in enumerate(days)])
    return per_pair.select(*_PAIR, F.inline(states)).filter("lines > 0")


def inventory_snapshot(
    sales: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    days: Sequence[date],
    *,
    opening: DataFrame | None = None,
    earlier: Earlier | None = None,
    **levels,
) -> DataFrame:
    """The snapshot rows of the given days, see ``stock_states`` and ``valued``."""
    return valued(stock_states(sales, stores, products, days, opening=opening, earlier=earlier), stores, products, **levels)


def valued(
    states: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    *,
    counted: Column | None = None,
    min_level: int = 10,
    max_level: int = 60,
    reorder_point: int = 15,
    batch_id: int | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Snapshot rows of states, under the versions and prices of their day.

    The rate of sale is that of the last 90 days. ``counted`` is a stock that an
    expression of ``store_id`` and ``product_id`` adds to each pair.
    """
    stock = major_units("stock", 3) if counted is None else counted + major_units("stock", 3)
    state = states.select(*_PAIR, F.col("at").alias("_at"), F.col("sold").alias("_sold"), F.col("sales").alias("_sales"), stock.cast("decimal(12,3)").alias("stock_qty"))

    priced = point_in_time(
        state, products, "product_id", F.col("_at"),
        {"product_sk": "product_sk", "cost_price": "_cost", "list_price": "_list"}, "inner",
    )
    priced = point_in_time(priced, stores, "store_id", F.col("_at"), {"store_sk": "store_sk"}, "inner")
    stock, at = F.col("stock_qty"), F.col("_at")
    sold = major_units("_sold", 3).cast("decimal(12,3)")
    priced = priced.withColumns(
        {
            "date_id": date_key(at),
            "stock_value_cost": (stock * F.col("_cost")).cast("decimal(14,2)"),
            "stock_value_retail": (stock * F.col("_list")).cast("decimal(14,2)"),
            "min_stock_level": F.lit(min_level),
            "max_stock_level": F.lit(max_level),
            "reorder_point": F.lit(reorder_point),
            "days_of_stock": F.when(sold > 0, stock * RATE_DAYS / sold),
            "is_stockout": stock <= 0,
            "is_overstock": stock > max_level,
            "is_slow_mover": F.col("_sales") == 0,
            "etl_batch_id": F.lit(batch_id),
            "etl_loaded_at": F.localtimestamp() if loaded_at is None else loaded_at,
        }
    )
    return shaped(priced.withColumn("inv_sk", F.xxhash64("date_id", "store_sk", "product_sk")), INVENTORY)


class StockStates:
    """The states that refreshes left, by the batch that wrote them, and the opening stock."""

    def __init__(self, log: BatchLog):
        self.log = log
        self.root = log.path.rsplit("/", 1)[0] + "/stock_state"

    def _all(self) -> DataFrame:
        pair = ", ".join(f"{c} bigint" for c in (*_PAIR, *_STATE))
        return self.log._folder(self.root, f"{pair}, batch_id bigint, as_of int")

    def write(self, states: DataFrame, batch_id: int) -> DataFrame:
        """Keeps the states of a batch; returns them as they were written, so that they are worked out once."""
        path = f"{self.root}/batch_id={batch_id}"
        rows = states.select(*_PAIR, *_STATE, date_key("at").alias("as_of"))
        rows.write.mode("overwrite").option("compression", CODEC).partitionBy("as_of").parquet(path)
        kept = self.log.spark.read.schema(rows.schema).parquet(path)
        return kept.withColumn("at", F.to_date(F.col("as_of").cast("string"), "yyyyMMdd")).select(states.columns)

    def opening(self, counted: DataFrame | None, batch_id: int) -> DataFrame:
        """The opening stock: as given now, which is kept, or as given last; no rows if it never was."""
        folder, ddl = f"{self.root}_opening", "store_id bigint, product_id bigint, quantity decimal(12,3)"
        if counted is not None:
            names = [field.split()[0] for field in ddl.split(", ")]
            counted.select(*[F.col(n) for n in names]).write.mode("overwrite").option("compression", CODEC).parquet(f"{folder}/batch_id={batch_id}")
        kept = self.log._folder(folder, f"{ddl}, batch_id bigint")
        last = kept.agg(F.max("batch_id")).first()[0]
        return kept.filter(F.col("batch_id") == F.lit(last)).drop("batch_id")

    def before(self, day: date) -> Earlier | None:
        """The latest state before ``day`` that still holds.

        It no longer does if sales of its day or earlier came in since: any load that is
        later, or ended later, and reaches back so far or doesn't say how far.
        """
        log = self.log.batches().filter("status = 'SUCCESS'")
        known = self._all().select("as_of", "batch_id").distinct().filter(F.col("as_of") < int(f"{day:%Y%m%d}"))
        newest = known.join(log.select("batch_id", "start_time"), "batch_id").orderBy(F.desc("as_of"), F.desc("batch_id")).limit(NEWEST).collect()
        if not newest:
            return None
        reaches = F.coalesce(F.col("watermark_from").cast("date"), F.lit("0001-01-01").cast("date"))
        loads = log.filter(F.col("target_table") == SALES)
        back = loads.agg(*[F.min(F.when((F.col("batch_id") > row["batch_id"]) | (F.col("end_time") >= ntz(row["start_time"])), reaches)).alias(f"b{i}") for i, row in enumerate(newest)]).first()
        for row, reached in zip(newest, back, strict=True):
            at = date(row["as_of"] // 10000, row["as_of"] // 100 % 100, row["as_of"] % 100)
            if reached is None or reached > at:
                mine = (F.col("as_of") == row["as_of"]) & (F.col("batch_id") == row["batch_id"])
                return Earlier(self._all().filter(mine), at)
        return None
