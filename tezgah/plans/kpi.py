"""Daily store KPIs (two definitions) and the KPI catalogue."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tezgah.dictionaries import RETURN, SALE, SHRINKAGE, type_ids
from tezgah.functions.expressions import (
    MONEY, UNKNOWN, exact_sum, guarded_ratio, half_up_int, major_units, minor_units, stored_ratio,
)
from tezgah.schemas import shaped

KPI = "fact.daily_store_kpi"
PCT = "decimal(18,4)"


def _key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def daily_store_kpi(
    sales: DataFrame,
    customers: DataFrame,
    date_from: date | None = None,
    date_to: date | None = None,
    *,
    targets: DataFrame | None = None,
    batch_id: int | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """The daily KPI fact, re-aggregated from the receipt lines of the window.

    Sales amounts take every transaction type with direction ``-``. Receipts
    and customers are counted apart: lines first fold to one row per receipt
    (that pass also carries the sums), and to one row per customer, so none is
    multiplied. Each side is dealt by day and store once, for both of its folds.
    ``targets(date_id, store_sk, sales_target)`` is optional.
    """
    if date_from is not None:
        sales = sales.filter(F.col("date_id") >= _key(date_from))
    if date_to is not None:
        sales = sales.filter(F.col("date_id") <= _key(date_to))
    day = ["date_id", "store_sk"]
    kind = F.col("transaction_type_id")
    outgoing = kind.isin(type_ids(direction="-"))
    known = sales.filter(kind.isin(type_ids()))  # the inner join with the type dictionary

    def units_if(condition: Column, c: str | Column, digits: int = 2) -> Column:
        return F.sum(F.when(condition, minor_units(c, digits)).otherwise(0))

    amounts = {
        "gross_sales": units_if(outgoing, "gross_sales_amount"),
        "discount_amount": units_if(outgoing, "discount_amount"),
        "net_sales": units_if(outgoing, "net_sales_amount"),
        "cogs": units_if(outgoing, "cogs_amount"),
        "gross_margin": units_if(outgoing, "gross_margin_amount"),
        "vat_collected": units_if(F.col("vat_amount").isNotNull(), "vat_amount"),
        "return_amount": units_if(kind == RETURN, F.abs("net_sales_amount")),
    }
    volumes = {
        "units_sold": units_if(kind == SALE, "quantity", 3),
        "units_returned": units_if(kind == RETURN, "quantity", 3),
    }
    receipts = {
        "transaction_count": F.max(F.when(kind == SALE, 1).otherwise(0)),
        "return_transaction_count": F.max(F.when(kind == RETURN, 1).otherwise(0)),
    }
    per_receipt = known.repartition(*day).groupBy(*day, "transaction_id").agg(
        *[value.alias(name) for name, value in (amounts | volumes | receipts).items()]
    )
    totals = per_receipt.groupBy(*day).agg(
        *[major_units(F.sum(c)).alias(c) for c in amounts],
        *[major_units(F.sum(c), 3).alias(c) for c in volumes],
        *[F.sum(c).alias(c) for c in receipts],
    )

    enrolled = customers.filter("loyalty_enrolled").select(F.col("customer_sk").alias("_sk"))
    visitors = known.filter(F.col("customer_sk") != UNKNOWN).select(*day, "customer_sk").repartition(*day).distinct()
    counted = (
        visitors.join(enrolled, F.col("customer_sk") == F.col("_sk"), "left")
        .groupBy(*day)
        .agg(F.count("*").alias("unique_customers"), F.count("_sk").alias("loyalty_customers"))
    )
    rows = totals.join(counted, day, "left").fillna(0, ["unique_customers", "loyalty_customers"])
    if targets is None:
        rows = rows.withColumn("sales_target", F.lit(None).cast(MONEY))
    else:
        rows = rows.join(targets.select(*day, "sales_target"), day, "left")

    net, count = F.col("net_sales"), F.col("transaction_count")
    rows = rows.withColumns(
        {
            "kpi_sk": F.xxhash64(*day),
            "avg_basket_size": stored_ratio(net, count, "decimal(12,2)"),
            "avg_basket_items": stored_ratio(F.col("units_sold"), count, "decimal(8,2)"),
            "gross_margin_pct": stored_ratio(F.col("gross_margin"), net, PCT, per=100),
            "return_rate_pct": stored_ratio(F.col("return_amount"), net, PCT, per=100),
            "etl_batch_id": F.lit(batch_id).cast("bigint"),
            "etl_loaded_at": F.localtimestamp() if loaded_at is None else loaded_at,
        }
    )
    return shaped(generated(rows), KPI)


def generated(kpi: DataFrame) -> DataFrame:
    """KPI rows with what every write of the table works out: whole units, half-up, and the share of the target."""
    return kpi.withColumns(
        {
            "units_sold": half_up_int("units_sold"),
            "units_returned": half_up_int("units_returned"),
            "sales_vs_target_pct": stored_ratio(F.col("net_sales"), F.col("sales_target"), PCT, per=100, otherwise=None),
        }
    )


def with_targets(kpi: DataFrame, uplift: str = "1.08") -> DataFrame:
    """The KPI rows with ``sales_target = net_sales * uplift``, half-up to cents."""
    target = F.round(F.col("net_sales") * F.lit(uplift).cast("decimal(4,2)"), 2).cast(MONEY)
    return generated(kpi.withColumn("sales_target", target))


def pos_daily_kpi(staged: DataFrame) -> DataFrame:
    """The till-side daily KPIs: plain sales only, anonymous counted as one customer.

    Works on staged lines by store id. Two distinct counts over one
    ``(day, store)`` group are taken as in ``daily_store_kpi``.
    """
    sold = staged.filter(F.col("transaction_type_id") == SALE)
    day = ["date_id", "store_id"]
    quantity = F.col("quantity")
    per_receipt = sold.repartition(*day).groupBy(*day, "transaction_id").agg(
        F.sum(F.col("unit_list_price") * quantity).alias("gross_sales"),
        F.sum("discount_amount").alias("discount_amount"),
        F.sum(F.col("unit_selling_price") * quantity - F.col("discount_amount")).alias("net_sales"),
        F.sum(F.col("unit_cost") * quantity).alias("cogs"),
        F.sum("vat_amount").alias("vat_collected"),
        F.sum("quantity").alias("units_sold"),
    )
    sums = [c for c in per_receipt.columns if c not in (*day, "transaction_id")]
    totals = per_receipt.groupBy(*day).agg(
        *[F.sum(c).alias(c) for c in sums], F.count("*").alias("transaction_count")
    )
    customers = (
        sold.filter(F.col("customer_id").isNotNull())
        .select(*day, "customer_id")
        .repartition(*day)
        .distinct()
        .groupBy(*day)
        .agg(F.count("*").alias("unique_customers"))
    )
    rows = totals.join(customers, day, "left").fillna(0, ["unique_customers"])
    margin = F.col("net_sales") - F.col("cogs")
    return rows.withColumns(
        {
            "gross_margin": margin.cast(MONEY),
            "avg_basket_size": _even_ratio(F.col("net_sales"), F.col("transaction_count"), 1, 2),
            "gross_margin_pct": _even_ratio(margin, F.col("net_sales"), 100, 4),
            "sales_target": F.bround(F.col("net_sales") * F.lit("1.08").cast("decimal(4,2)"), 2).cast(MONEY),
        }
    ).withColumns({c: F.col(c).cast(MONEY) for c in ("gross_sales", "net_sales", "cogs")})


def _even_ratio(num: Column, den: Column, per: int, digits: int) -> Column:
    """Ratio rounded half-even, as data frames round; a zero divisor gives NULL."""
    den = den.cast("decimal(17,5)")
    value = num.cast("decimal(17,5)") * F.lit(per) / den
    return F.when(den != 0, F.bround(value, digits)).cast(f"decimal(18,{digits})")


# Catalogue codes for which no table holds the inputs (visitor
# counts, survey scores). They are reported as NULL.
WITHOUT_INPUTS = ("CONVERSION_RATE", "NPS")


def kpi_catalog(kpi: DataFrame, stores: DataFrame, calendar: DataFrame) -> DataFrame:
    """``(year, month, store_id, kpi_code, value)`` for the sales-side KPIs."""
    days = calendar.select("date_id", "year_number", "month_number")
    sites = stores.select("store_sk", "store_id", "store_sqm", "headcount")
    # One row per store version and month reaches the store join.
    monthly = (
        kpi.join(F.broadcast(days), "date_id")
        .groupBy("year_number", "month_number", "store_sk")
        .agg(*[F.sum(c).alias(c) for c in
               ("gross_sales", "return_amount", "net_sales", "cogs", "units_sold", "transaction_count")])
        .join(sites, "store_sk")
        .groupBy("year_number", "month_number", "store_id")
        .agg(
            *[F.sum(c).alias(c) for c in
              ("gross_sales", "return_amount", "net_sales", "cogs", "units_sold", "transaction_count")],
            F.max("store_sqm").alias("store_sqm"),
            F.max("headcount").alias("headcount"),
        )
    )
    values = {
        "NET_SALES": (F.col("gross_sales") - F.col("return_amount")).cast("double"),
        "GROSS_MARGIN": guarded_ratio(F.col("net_sales") - F.col("cogs"), "net_sales", per=100),
        "UNITS_SOLD": F.col("units_sold").cast("double"),
        "BASKET_SIZE": guarded_ratio("net_sales", "transaction_count"),
        "BASKET_ITEMS": guarded_ratio("units_sold", "transaction_count"),
        "SALES_PER_SQM": guarded_ratio("net_sales", "store_sqm"),
        "STAFF_SALES": guarded_ratio("net_sales", "headcount"),
        **{code: F.lit(None).cast("double") for code in WITHOUT_INPUTS},
    }
    return _long(monthly, ["year_number", "month_number", "store_id"], values)


def _long(df: DataFrame, ids: list[str], values: dict[str, Column]) -> DataFrame:
    wide = df.select(*ids, *[v.alias(c) for c, v in values.items()])
    return wide.unpivot(ids, list(values), "kpi_code", "value")


def kpi_inventory(
    snapshot: DataFrame, sales: DataFrame, stores: DataFrame, calendar: DataFrame
) -> DataFrame:
    """``(date_id, store_id, kpi_code, value)`` for the stock-side KPIs.

    Cost of goods and shrinkage are those of the year up to the snapshot day,
    and the turn divides by the average stock value of that year's snapshots.
    Sales fold per store and day; running totals over a store's days then answer
    any number of snapshot days by two lookups each.
    """
    sites = stores.select("store_sk", "store_id")
    stock = (
        snapshot.groupBy("date_id", "store_sk")
        .agg(
            F.count("*").alias("skus"),
            F.sum(F.col("is_stockout").cast("int")).alias("stockouts"),
            exact_sum("stock_value_cost").alias("stock_value"),
            exact_sum("stock_qty", 3).alias("stock_qty"),
        )
        .join(sites, "store_sk")
        .groupBy("date_id", "store_id")
        .agg(*[F.sum(c).alias(c) for c in ("skus", "stockouts", "stock_value", "stock_qty")])
    )
    year = Window.partitionBy("store_id").orderBy("_nth").rangeBetween(-364, 0)  # a row per snapshot day
    dated = stock.join(calendar.select("date_id", F.unix_date("full_date").alias("_nth")), "date_id")
    stock = dated.withColumn("average_value", F.avg(F.col("stock_value").cast("double")).over(year)).drop("_nth")
    kind = F.col("transaction_type_id")
    daily = (
        sales.filter(kind.isin(SALE, SHRINKAGE))
        .groupBy("date_id", "store_sk")
        .agg(
            F.sum(F.when(kind == SALE, minor_units("cogs_amount")).otherwise(0)).alias("cogs"),
            F.sum(F.when(kind == SHRINKAGE, minor_units("quantity", 3)).otherwise(0)).alias("shrinkage"),
        )
        .join(sites, "store_sk")
        .groupBy("store_id", F.unix_date(F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")).alias("_nth"))
        .agg(F.sum("cogs").alias("cogs"), F.sum("shrinkage").alias("shrinkage"))
    )
    # A year's figure is the total up to its last day less that up to the day before its first.
    none = F.lit(0).cast("bigint")
    ends = F.array(*[F.struct((F.col("_nth") - back).alias("_nth"), F.lit(sign).alias("_sign")) for back, sign in ((0, 1), (365, -1))])
    asked = dated.select("store_id", "date_id", F.inline(ends)).select("*", none.alias("cogs"), none.alias("shrinkage"))
    known = daily.select("store_id", F.lit(None).cast("int").alias("date_id"), "_nth", F.lit(0).alias("_sign"), "cogs", "shrinkage")
    upto = Window.partitionBy("store_id").orderBy("_nth").rangeBetween(Window.unboundedPreceding, 0)  # a row per day, and two per snapshot
    totals = known.unionByName(asked).withColumns({c: F.sum(c).over(upto) for c in ("cogs", "shrinkage")})
    flow = (
        totals.filter("_sign <> 0")
        .groupBy("date_id", "store_id")
        .agg(*[major_units(F.sum(F.col(c) * F.col("_sign")), n).alias(c) for c, n in (("cogs", 2), ("shrinkage", 3))])
    )
    joined = stock.join(flow, ["date_id", "store_id"])
    values = {
        "STOCKOUT_RATE": guarded_ratio("stockouts", "skus", per=100),
        "INVENTORY_TURN": guarded_ratio("cogs", "average_value"),
        "SHRINKAGE_RATE": guarded_ratio("shrinkage", "stock_qty", per=100),
    }
    return _long(joined, ["date_id", "store_id"], values)
