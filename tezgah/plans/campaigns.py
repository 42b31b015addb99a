"""Campaign x store performance.

Declared by the warehouse but loaded by nothing there; the rules are ours,
from the meaning of the columns.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.dictionaries import SALE
from tezgah.functions.expressions import MONEY, UNKNOWN, date_key, exact_sum, half_up_int, major_units, minor_units
from tezgah.operators.lookups import point_in_time
from tezgah.plans.batches import BatchLog
from tezgah.schemas import shaped

PERFORMANCE = "fact.campaign_performance"


def first_purchases(sales: DataFrame) -> DataFrame:
    """``(customer_sk, first)``: the day of a customer's first plain sale. Minima of parts merge to that of the whole."""
    mine = sales.filter((F.col("transaction_type_id") == SALE) & (F.col("customer_sk") != UNKNOWN))
    return mine.groupBy("customer_sk").agg(F.min("date_id").alias("first"))


def days_used(campaigns: DataFrame) -> tuple[date, date] | None:
    """From the first reference day to the last campaign day: all that a refresh needs of the sales, but for first purchases."""
    length = F.datediff("end_date", "start_date") + 1
    real = campaigns.filter(F.col("campaign_sk") != UNKNOWN)
    low, high = real.agg(F.min(F.date_sub("start_date", length)), F.max("end_date")).first()
    return (low, high) if low and high else None


class FirstPurchases:
    """First purchases as a table that refreshes add to, from the sales loaded since.

    Sales are only ever added, under rising batch numbers, so the minima of the loads
    up to a batch and of those after it are all there is, however late a sale was.
    """

    def __init__(self, log: BatchLog):
        self.log = log
        self.root = log.path.rsplit("/", 1)[0] + "/first_purchase"

    def upto(self, sales: DataFrame, batch_id: int) -> DataFrame:
        """Those of all ``sales``, of which only rows loaded since the last call are read."""
        kept = "customer_sk bigint, first int, upto bigint"
        known = self.log._folder(self.root, kept).agg(F.max("upto")).first()[0]
        settled = min(batch_id, self.log.first_unsettled() or batch_id) - 1  # a stream may yet add rows under a number it holds
        loaded = F.coalesce("etl_batch_id", F.lit(0))
        if known is None or known < settled:
            fresh = sales.filter(loaded <= settled)
            fresh = fresh if known is None else fresh.filter(F.col("etl_batch_id") > known)
            first_purchases(fresh).write.mode("overwrite").parquet(f"{self.root}/upto={settled}")
        parts = self.log._folder(self.root, kept).select("customer_sk", "first")
        parts = parts.unionByName(first_purchases(sales.filter(F.col("etl_batch_id") > settled)))
        return parts.groupBy("customer_sk").agg(F.min("first").alias("first"))


def campaign_performance(
    sales: DataFrame,
    stores: DataFrame,
    campaigns: DataFrame,
    *,
    first: DataFrame | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """One row per campaign and store that sold under it.

    Sales are the plain sales attributed to the campaign within its dates.
    The baseline is the store's mean daily net sales over as many days just
    before, times the days of the campaign. A new customer is one whose first
    purchase of all falls within the campaign. Rows hang under the store
    version valid on the campaign's last day. With ``first`` (``customer_sk,
    first``) the sales of ``days_used`` are enough.
    """
    sold = sales.filter(F.col("transaction_type_id") == SALE)
    real = campaigns.filter(F.col("campaign_sk") != UNKNOWN).select(
        "campaign_sk", "start_date", "end_date",
        date_key("start_date").alias("start_date_id"), date_key("end_date").alias("end_date_id"),
    )
    sites = stores.select("store_sk", "store_id")
    dates = real.select(F.col("campaign_sk").alias("_campaign"), "start_date_id", "end_date_id")
    attributed = (
        sold.filter(F.col("campaign_sk") != UNKNOWN)
        .join(
            dates,
            (F.col("campaign_sk") == F.col("_campaign"))
            & F.col("date_id").between(F.col("start_date_id"), F.col("end_date_id")),
        )
        .join(sites, "store_sk")
    )
    group = ["campaign_sk", "store_id"]
    first = first_purchases(sales) if first is None else first

    # Sold lines fold once, per product (with the sums) and per customer; the rows left are the distinct counts.
    amounts = {"net_sales_amount": 2, "discount_amount": 2, "quantity": 3}
    product = F.struct(F.lit(True).alias("_product"), F.col("product_sk").cast("bigint").alias("_id"), *[minor_units(c, n).alias(c) for c, n in amounts.items()])
    customer = F.struct(F.lit(False).alias("_product"), F.col("customer_sk").cast("bigint").alias("_id"), *[F.lit(None).cast("bigint").alias(c) for c in amounts])
    folded = attributed.select(*group, "start_date_id", "end_date_id", F.inline(F.array(product, customer)))
    folded = folded.groupBy(*group, "_product", "_id").agg(*[F.sum(c).alias(c) for c in amounts], F.max("start_date_id").alias("_from"), F.max("end_date_id").alias("_to"))
    # a product meets no customer: its key is NULL there
    buyer = F.when(~F.col("_product") & (F.col("_id") != UNKNOWN), F.col("_id"))
    met = folded.withColumn("_buyer", buyer).join(first.select(F.col("customer_sk").alias("_buyer"), "first"), "_buyer", "left")
    totals = met.groupBy(*group).agg(
        *[major_units(F.sum(c), n).alias(c) for c, n in amounts.items()],
        F.count(F.when(F.col("_product"), F.col("_id"))).alias("participating_sku_count"),
        F.count("_buyer").alias("unique_customers"),
        F.count_if(F.col("_buyer").isNotNull() & F.col("first").between(F.col("_from"), F.col("_to"))).alias("new_customers"),
    ).select(
        *group,
        F.col("net_sales_amount").cast(MONEY).alias("total_sales_amount"),
        F.col("discount_amount").cast(MONEY).alias("total_discount_given"),
        half_up_int("quantity").alias("total_units_sold"),
        "participating_sku_count", "unique_customers", "new_customers",
    )

    # Each campaign's reference days, so that the join is by day and not by range.
    length = F.datediff("end_date", "start_date") + 1
    reference = real.select(
        "campaign_sk",
        F.explode(
            F.sequence(F.date_sub("start_date", length), F.date_sub("start_date", F.lit(1)))
        ).alias("_day"),
    ).select("campaign_sk", date_key("_day").alias("date_id"))
    baseline = (
        sold.groupBy("store_sk", "date_id")
        .agg(exact_sum("net_sales_amount").alias("_net"))
        .join(reference, "date_id")
        .join(sites, "store_sk")
        .groupBy(*group)
        # mean over n days times n campaign days: the n's cancel
        .agg(F.sum("_net").cast(MONEY).alias("baseline_sales_amount"))
    )

    rows = (
        totals.join(baseline, group, "left")
        .join(real, "campaign_sk")
    )
    rows = point_in_time(rows, stores, "store_id", F.col("end_date"), {"store_sk": "store_sk"}, "inner")
    gained = (
        F.col("total_sales_amount") - F.coalesce("baseline_sales_amount", F.lit(0).cast(MONEY))
    ).cast(MONEY)
    given = F.col("total_discount_given")
    rows = rows.withColumns(
        {
            "camp_perf_sk": F.xxhash64("campaign_sk", "store_sk"),
            "incremental_sales": gained,
            "campaign_roi_pct": F.when(given > 0, (gained - given).cast(MONEY) * 100 / given),
            "etl_loaded_at": F.localtimestamp() if loaded_at is None else loaded_at,
        }
    )
    return shaped(rows, PERFORMANCE)
