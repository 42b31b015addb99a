"""Loading the receipt-line fact: incremental by watermark, or in bulk."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.functions.expressions import UNKNOWN, date_key, ntz, sales_measures
from tezgah.operators.dedupe import insert_skip_conflicts
from tezgah.operators.lookups import current_key, point_in_time
from tezgah.schemas import shaped
from tezgah.sources.shared import stored

SALES = "fact.sales_transaction"
SALES_KEY = ("transaction_id", "line_number", "date_id", "source_system")
LINE = ("transaction_id", "line_number")
ALWAYS_AFTER, ALWAYS_BEFORE = "0001-01-01 00:00:00", "9999-12-31 00:00:00"
# Which of several copies of a receipt line is kept.
FIRST_COPY = ("product_id", "store_id", "quantity", "discount_amount", "vat_amount")


@dataclass(frozen=True)
class SalesLoad:
    """``rows`` to append to the fact, and the staged ``rejects`` with a reason.

    ``rows`` are ``finish(lines)``: a caller that shuffles them shuffles the narrower lines.
    """

    rows: DataFrame
    rejects: DataFrame
    lines: DataFrame
    finish: Callable[[DataFrame], DataFrame]


def in_window(staged: DataFrame, after: date | datetime | str, upto: date | datetime | str) -> DataFrame:
    """The staged rows of the half-open window ``(after, upto]``."""
    moment = F.col("transaction_datetime")
    return staged.filter((moment > ntz(after)) & (moment <= ntz(upto)))


def resolve_versions(staged: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Adds the store and product version valid on the day of sale, NULL if none.

    Products come first: staged lines that were joined by product just before lie as that join needs them.
    """
    day = F.col("transaction_datetime").cast("date")
    known = point_in_time(staged, products, "product_id", day, {"product_sk": "product_sk"})
    located = point_in_time(known, stores, "store_id", day, {"store_sk": "store_sk"})
    return located.select(*staged.columns, "store_sk", "product_sk")


def _as_fact(resolved: DataFrame, batch_id: int | None, loaded_at: Column | None) -> DataFrame:
    keyed = resolved.withColumns(
        {
            "sales_tx_sk": F.xxhash64(*SALES_KEY),
            "etl_batch_id": F.lit(batch_id).cast("bigint"),
            "etl_loaded_at": F.localtimestamp() if loaded_at is None else loaded_at,
        }
    )
    return shaped(sales_measures(keyed), SALES)


def incremental_sales(
    staged: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    employees: DataFrame,
    campaigns: DataFrame,
    *,
    watermark_from: date | datetime | str,
    watermark_to: date | datetime | str,
    existing: DataFrame | None = None,
    batch_id: int | None = None,
    loaded_at: Column | None = None,
    shared: bool = False,
) -> SalesLoad:
    """One incremental load over ``(watermark_from, watermark_to]``.

    Store and product are looked up as of the sale, customer, employee and
    campaign as of now. Lines without store or product are rejected. Of the
    rest one copy per receipt line and day is kept, unless ``existing`` has
    that line already. Loading the same window twice adds nothing. ``shared``
    writes the looked-up lines once for both outputs, and copies are then found
    by their keys before whole lines are compared; else each output is a plan of its own.
    """
    window = in_window(staged, watermark_from, watermark_to)
    resolved = resolve_versions(window, stores, products)
    if shared:
        resolved = stored(resolved, "resolved")
    no_store, no_product = F.col("store_sk").isNull(), F.col("product_sk").isNull()

    rejects = resolved.filter(no_store | no_product).select(
        *staged.columns,
        F.when(no_store & no_product, "both")
        .when(no_store, "no_store")
        .otherwise("no_product")
        .alias("reject_reason"),
    )

    # One filter per key: this lets the optimizer read both left joins as inner.
    accepted = resolved.filter(F.col("store_sk").isNotNull()).filter(F.col("product_sk").isNotNull())
    accepted = accepted.withColumns(
        {"date_id": date_key("transaction_datetime"), "source_system": F.lit("POS")}
    )
    # Lookups below give one key per line, so copies can go before them.
    fresh = insert_skip_conflicts(existing, accepted, SALES_KEY, FIRST_COPY, in_storage=shared)
    fresh = current_key(fresh, customers, "customer_id", "customer_sk", LINE, default=UNKNOWN)
    fresh = current_key(fresh, employees, "employee_id", "employee_sk", LINE)
    fresh = current_key(fresh, campaigns, "campaign_id", "campaign_sk", LINE, default=UNKNOWN)
    finish = partial(_as_fact, batch_id=batch_id, loaded_at=loaded_at)
    return SalesLoad(finish(fresh), rejects, fresh, finish)


def bulk_load(
    staged: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    campaigns: DataFrame,
    *,
    existing: DataFrame | None = None,
    batch_id: int | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """First fill of the fact: every key as of now, lines without store or product dropped."""
    keyed = current_key(staged, stores, "store_id", "store_sk", LINE)
    keyed = current_key(keyed, products, "product_id", "product_sk", LINE)
    keyed = keyed.dropna(subset=["store_sk", "product_sk"]).withColumn("source_system", F.lit("POS"))
    fresh = insert_skip_conflicts(existing, keyed, SALES_KEY, FIRST_COPY)
    fresh = current_key(fresh, customers, "customer_id", "customer_sk", LINE, default=UNKNOWN)
    fresh = current_key(fresh, campaigns, "campaign_id", "campaign_sk", LINE, default=UNKNOWN)
    return _as_fact(fresh.withColumn("employee_sk", F.lit(None).cast("bigint")), batch_id, loaded_at)
