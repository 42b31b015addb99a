"""The registered queries: every operator over the demo model.

Decimals leave as DOUBLE (of exact sums), audit columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tezgah import dictionaries
from tezgah.functions.calendar import dim_date as calendar_of
from tezgah.functions.expressions import attribute_hash, finite_or_null, guarded_ratio, sales_measures
from tezgah.operators import quality
from tezgah.operators.dedupe import insert_skip_conflicts, keep_first
from tezgah.operators.lookups import current_key, few, sent_if_few
from tezgah.operators.ranking import Score, ntiles
from tezgah.operators.scd import CUSTOMER, PRODUCT, STORE, Parent, classify, scd1_upsert, scd2_apply
from tezgah.plans import batches as log
from tezgah.plans import marts
from tezgah.plans.campaigns import PERFORMANCE
from tezgah.plans.campaigns import campaign_performance as campaigns_job
from tezgah.plans.inventory import INVENTORY
from tezgah.plans.inventory import inventory_snapshot as inventory_job
from tezgah.plans.jobs import Jobs
from tezgah.plans.kpi import KPI, daily_store_kpi, pos_daily_kpi, with_targets
from tezgah.plans.kpi import kpi_catalog as catalog_job
from tezgah.plans.kpi import kpi_inventory as stock_kpi_job
from tezgah.plans.publish import report_views
from tezgah.plans.rejects import RejectStore
from tezgah.plans.sales import FIRST_COPY, LINE, SALES, bulk_load, resolve_versions
from tezgah.schemas import shaped
from tezgah.sources.csv_files import manifest, read_csv, write_csv
from tezgah.sources.demo_model import AFTER_ALL, AS_OF, BEFORE_ALL, CHANGE, FIRST_DAY, LAST_DAY, OPENING, SNAPSHOT_DAYS, DemoModel
from tezgah.sources.shared import FREED, cut, scratch_path, setting, sized_tasks, stored
from tezgah.sources.warehouse import Warehouse
from tezgah.streaming.sales import stream_sales

Query = Callable[[SparkSession, str], DataFrame]
AUDIT = ("created_at", "updated_at", "etl_loaded_at", "etl_batch_id")
HASHED_KEYS = ("sales_tx_sk", "kpi_sk", "inv_sk", "camp_perf_sk")
NOW = "2002-01-01 00:00:00"
QUERIES: dict[str, Query] = {}


def _registered(build: Callable[[DemoModel], DataFrame]) -> Callable[[DemoModel], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        model = DemoModel(spark, folder)
        sized_tasks(spark, model.source("lineitem").count())
        # A query of many writes else has the shuffle files of all of them on disk at its end.
        with setting(spark, FREED, "true"):
            result = build(model)
        return boundary(result)

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def boundary(df: DataFrame) -> DataFrame:
    df = df.drop(*AUDIT, *HASHED_KEYS)
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


# Sources ---------------------------------------------------------------------


@_registered
def src_csv_roundtrip(m: DemoModel) -> DataFrame:
    """Staged sales out to CSV and back under the declared schema."""
    path = scratch_path(m.spark, "csv")
    write_csv(m.stg_sales, path, "stg_sales_transaction")
    return read_csv(m.spark, path, "stg_sales_transaction")


@_registered
def src_sanitize_nonfinite(m: DemoModel) -> DataFrame:
    """Rates with zero divisors: NaN and infinities become NULL."""
    price, tax, off = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    infinite = F.when(F.col("l_returnflag") == "R", float("-inf")).otherwise(float("inf"))
    raw = m.source("lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(tax == 0, infinite).otherwise(price * tax).alias("per_tax"),
        F.when(off == 0, float("nan")).otherwise(price * off).alias("per_discount"),
    )
    return finite_or_null(raw)


@_registered
def src_manifest(m: DemoModel) -> DataFrame:
    """Rows of two written tables by their files, and whether all files have a name and a size."""
    files = {}
    for name, frame in {"stg_store": m.stg_store(), "stg_sales_transaction": m.stg_sales}.items():
        path = scratch_path(m.spark, name)
        write_csv(frame, path, name)
        files[name] = m.spark.read.option("header", True).csv(path)
    return manifest(files).groupBy("table_name").agg(
        F.sum("row_count").alias("row_count"), F.bool_and((F.col("file_size") > 0) & F.col("file_path").like("%.csv")).alias("has_files")
    )


@_registered
def ins_skip_conflicts(m: DemoModel) -> DataFrame:
    """Lines from the change day on, unless an earlier day has the line number already."""
    moment = F.col("transaction_datetime")
    before = keep_first(m.stg_sales.filter(moment < F.lit(CHANGE)), LINE, FIRST_COPY)
    return insert_skip_conflicts(before, m.stg_sales.filter(moment >= F.lit(CHANGE)), LINE, FIRST_COPY)


@_registered
def scan_partition_window(m: DemoModel) -> DataFrame:
    """A date window of the stored fact; only its months are opened."""
    wh = Warehouse(m.spark)
    wh.append(SALES, m.sales)
    return wh.read(SALES, date(1998, 6, 15), date(1998, 8, 14)).drop("gross_margin_pct", "year_month")


# Dictionaries, dimensions ------------------------------------------------------


@_registered
def dict_transaction_type(m: DemoModel) -> DataFrame:
    """The transaction types with the staged lines of each."""
    used = m.stg_sales.groupBy("transaction_type_id").agg(F.count("*").alias("n"))
    types = m.dictionary("d_transaction_type")
    return types.join(used, "transaction_type_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@_registered
def dim_date(m: DemoModel) -> DataFrame:
    """The calendar from the first to the last shipment, with the lines of each day."""
    shipped = m.source("lineitem").select(F.col("l_shipdate").cast("date").alias("full_date"))
    per_day = shipped.groupBy("full_date").agg(F.count("*").alias("lines"))
    span = per_day.agg(F.min("full_date").alias("low"), F.max("full_date").alias("high"))
    days = span.select(F.explode(F.sequence("low", "high")).alias("day"))
    marked = calendar_of(days).join(per_day, "full_date", "left")
    return marked.withColumn("lines", F.coalesce("lines", F.lit(0)))


@_registered
def dim_customer_unknown(m: DemoModel) -> DataFrame:
    """Customers with the unknown member."""
    return m.customer.select(
        "customer_sk", "customer_id", "customer_segment", "age_band", "gender", "city",
        "loyalty_enrolled", "loyalty_tier", "clv_segment", "scd_start_date", "is_current",
    )


@_registered
def fact_sales_measures(m: DemoModel) -> DataFrame:
    """Generated columns and defaults of the fact, for the staged lines."""
    blank = F.lit(None).cast("bigint")
    rows = m.stg_sales.withColumns(
        {
            "customer_sk": blank,
            "campaign_sk": blank,
            "discount_amount": F.when(F.col("discount_amount") != 0, F.col("discount_amount")),
        }
    )
    return sales_measures(rows).select(
        "transaction_id", "line_number", "date_id", "quantity", "discount_amount", "customer_sk",
        "campaign_sk", "gross_sales_amount", "net_sales_amount", "cogs_amount", "gross_margin_amount",
    )


@_registered
def expr_guarded_ratio(m: DemoModel) -> DataFrame:
    """The three guards of a ratio, per store and day."""
    sums = m.stg_sales.groupBy("store_id", "date_id").agg(
        F.sum("quantity").alias("units"), F.sum("discount_amount").alias("discount")
    )
    return sums.select(
        "store_id", "date_id",
        guarded_ratio("units", "discount", per=100, otherwise=0).alias("else_zero"),
        guarded_ratio("discount", "units").alias("else_null"),
        guarded_ratio("discount", "units", guard="nonzero").alias("nonzero"),
    )


# Joins --------------------------------------------------------------------------


@_registered
def join_scd2_point_in_time(m: DemoModel) -> DataFrame:
    """Store and product version on the day of sale; NULL where there is none."""
    found = resolve_versions(m.stg_sales, m.store, m.product)
    return found.select(*LINE, "date_id", "store_id", "product_id", "store_sk", "product_sk")


@_registered
def join_current_lookup(m: DemoModel) -> DataFrame:
    """Current customer, employee and campaign keys, with the unknown member."""
    rows = m.stg_sales.select(*LINE, "date_id", "customer_id", "employee_id", "campaign_id")
    rows = current_key(rows, m.customer, "customer_id", "customer_sk", LINE, default=-1)
    rows = current_key(rows, m.employee, "employee_id", "employee_sk", LINE)
    return current_key(rows, m.campaign, "campaign_id", "campaign_sk", LINE, default=-1)


@_registered
def load_lookup_current(m: DemoModel) -> DataFrame:
    """The bulk load: every key as of now."""
    rows = bulk_load(m.stg_sales, m.store, m.product, m.customer, m.campaign)
    return rows.select(
        *LINE, "date_id", "store_sk", "product_sk", "customer_sk", "campaign_sk", "quantity", "net_sales_amount"
    )


# Versioned dimensions --------------------------------------------------------------


def _known_stores(m: DemoModel) -> DataFrame:
    """First versions of the stores in credit, as the state before a load."""
    credit = m.source("supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("store_id"))
    first = m.store.filter("scd_version = 1").join(credit, "store_id", "left_semi")
    return first.withColumns({"is_current": F.lit(True), "scd_end_date": F.lit(None).cast("date")})


def _known_products(m: DemoModel) -> DataFrame:
    small = m.source("part").filter("p_size <= 45").select(F.col("p_partkey").alias("product_id"))
    first = m.product.filter("scd_version = 1").join(small, "product_id", "left_semi")
    return first.withColumns({"is_current": F.lit(True), "scd_end_date": F.lit(None).cast("date")})


_SCD = ("scd_version", "scd_start_date", "scd_end_date", "is_current", "scd_hash")


@_registered
def scd2_hash(m: DemoModel) -> DataFrame:
    """Attribute hashes of all staged stores and products."""
    parts = [
        staged.select(
            F.lit(spec.table).alias("table_name"),
            F.col(spec.key).alias("business_id"),
            attribute_hash(spec.tracked).alias("scd_hash"),
        )
        for spec, staged in ((STORE, m.stg_store()), (PRODUCT, m.stg_product()))
    ]
    return parts[0].unionByName(parts[1])


@_registered
def scd2_changed_keys(m: DemoModel) -> DataFrame:
    """Products whose attributes differ from their current version."""
    acted = classify(_known_products(m), m.stg_product(), PRODUCT)
    return acted.filter("scd_action = 'changed'").select("product_id", "scd_hash")


@_registered
def scd2_new_keys(m: DemoModel) -> DataFrame:
    """Products never seen before."""
    acted = classify(_known_products(m), m.stg_product(), PRODUCT)
    return acted.filter("scd_action = 'new'").select("product_id", "scd_hash")


@_registered
def scd2_next_version(m: DemoModel) -> DataFrame:
    """The next version number of every staged product, against all stored versions."""
    return classify(m.product, m.stg_product(), PRODUCT).select("product_id", "scd_version")


@_registered
def scd2_store_apply(m: DemoModel) -> DataFrame:
    """Stores versioned, with one region group unknown to the warehouse."""
    regions = m.region.filter("nuts2_name <> 'MIDDLE EAST'")
    change = scd2_apply(
        _known_stores(m), m.stg_store(), STORE, CHANGE, Parent(regions, "region_id", "region_sk")
    )
    return change.rows.select("store_sk", "store_id", "store_code", "cluster", "region_sk", *_SCD)


@_registered
def scd2_product_apply(m: DemoModel) -> DataFrame:
    """Products versioned."""
    parent = Parent(m.category, "category_id", "category_sk")
    change = scd2_apply(_known_products(m), m.stg_product(), PRODUCT, CHANGE, parent)
    return change.rows.select("product_sk", "product_id", "sku_code", "list_price", "category_sk", *_SCD)


@_registered
def scd2_customer_apply(m: DemoModel) -> DataFrame:
    """Customers versioned: those well in credit became gold members."""
    rich = m.source("customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("_rich"))
    staged = m.stg_customer.join(rich, F.col("customer_id") == F.col("_rich"), "left").withColumn(
        "customer_segment", F.when(F.col("_rich").isNotNull(), "Gold").otherwise(F.col("customer_segment"))
    ).drop("_rich")
    change = scd2_apply(m.customer, staged, CUSTOMER, CHANGE)
    return change.rows.select("customer_sk", "customer_id", "customer_segment", *_SCD[:-1])


@_registered
def scd1_region_upsert(m: DemoModel) -> DataFrame:
    """Regions overwritten: one group of them is new, all get another name."""
    target = m.region.filter("nuts2_name <> 'EUROPE'")
    staged = m.stg_region.withColumn("region_name", F.upper("region_name"))
    served = m.source("supplier").groupBy(F.col("s_nationkey").cast("bigint").alias("region_id")).agg(
        F.count("*").alias("stores")
    )
    rows = scd1_upsert(target, staged, "region_id", "region_sk")
    return rows.select("region_sk", "region_id", "region_name", "city", "nuts2_name").join(
        served, "region_id", "left"
    ).withColumn("stores", F.coalesce("stores", F.lit(0)))


# Facts ----------------------------------------------------------------------------


_FACT = (
    "transaction_id", "line_number", "date_id", "store_sk", "product_sk", "customer_sk", "employee_sk",
    "campaign_sk", "payment_method_id", "transaction_type_id", "quantity", "unit_list_price",
    "unit_selling_price", "unit_cost", "gross_sales_amount", "discount_amount", "net_sales_amount",
    "cogs_amount", "gross_margin_amount", "vat_amount", "transaction_datetime",
)


@_registered
def etl_incremental_sales(m: DemoModel) -> DataFrame:
    """All staged sales loaded."""
    return m.sales.select(*_FACT)


_REJECTED = (*LINE, "date_id", "store_id", "product_id", "reject_reason")


@_registered
def etl_sales_rejects(m: DemoModel) -> DataFrame:
    """Staged lines without a store or product version, as the reject store holds them after a load."""
    log_of = log.BatchLog(m.spark, Warehouse(m.spark).root)
    store = RejectStore(log_of)
    with log_of.batch("incremental_sales", SALES, "INCREMENTAL", "POS") as batch:
        batch.count(rejected=store.write(m.load().rejects, batch.id))
    return store.waiting().select(*_REJECTED)


@_registered
def etl_rejects_replayed(m: DemoModel) -> DataFrame:
    """A load before every fifth store is known, then those stores arrive and the rejects are loaded."""
    wh = Warehouse(m.spark)
    jobs = Jobs(wh)
    for name, frame in (_dimensions(m) | {"dim.store": m.store.filter("store_id % 5 <> 0")}).items():
        wh.replace(name, frame)
    jobs.incremental_sales(m.stg_sales, BEFORE_ALL, AFTER_ALL)
    wh.replace("dim.store", m.store)
    jobs.replay_rejects()
    return wh.read(SALES).select(*_FACT)


@_registered
def etl_batch_log(m: DemoModel) -> DataFrame:
    """The state of every batch from the steps logged."""
    return log.latest_state(m.log_steps)


@_registered
def etl_watermark(m: DemoModel) -> DataFrame:
    """How far each target is loaded."""
    return log.watermarks(log.latest_state(m.log_steps))


_KPI = (
    "date_id", "store_sk", "gross_sales", "discount_amount", "net_sales", "cogs", "gross_margin",
    "vat_collected", "return_amount", "units_sold", "units_returned", "transaction_count",
    "return_transaction_count", "unique_customers", "loyalty_customers", "avg_basket_size",
    "avg_basket_items", "gross_margin_pct", "return_rate_pct",
)


@_registered
def kpi_daily_store(m: DemoModel) -> DataFrame:
    """Daily store KPIs from the fact."""
    return daily_store_kpi(m.stored_sales, m.customer).select(*_KPI)


@_registered
def kpi_daily_store_pos(m: DemoModel) -> DataFrame:
    """Daily store KPIs from the tills."""
    return pos_daily_kpi(m.stg_sales)


GAP, WINDOW = date(1998, 6, 20), (date(1998, 6, 15), date(1998, 7, 10))


@_registered
def etl_kpi_window_replace(m: DemoModel) -> DataFrame:
    """KPIs of all days, then a window refreshed from sales that lost returns and one day."""
    wh = Warehouse(m.spark)
    wh.append(KPI, daily_store_kpi(m.stored_sales, m.customer))
    corrected = m.stored_sales.filter((F.col("date_id") != _key(GAP)) & (F.col("transaction_type_id") != 2))
    wh.replace_window(KPI, daily_store_kpi(corrected, m.customer, *WINDOW), *WINDOW)
    return wh.read(KPI).select(*_KPI)


def _key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


@_registered
def inventory_snapshot(m: DemoModel) -> DataFrame:
    """Stock of every store and product on two days."""
    return inventory_job(m.sales, m.store, m.product, SNAPSHOT_DAYS, counted=m.counted())


BETWEEN = date(1998, 8, 15)


@_registered
def inventory_incremental(m: DemoModel) -> DataFrame:
    """The same stock, refreshed in three steps, of which each reads on from the state of the one before."""
    wh = Warehouse(m.spark)
    jobs = Jobs(wh)
    for name, frame in _dimensions(m).items():
        wh.replace(name, frame)
    load = m.load(shared=True)  # written once looked up, so that the shuffles before are off the disk by then
    wh.append(SALES, load.lines, finish=load.finish)
    stores, products = m.store.select("store_sk", "store_id"), m.product.select("product_sk", "product_id")
    pairs = wh.read(SALES).select("store_sk", "product_sk").distinct().join(sent_if_few(stores, m.store), "store_sk")
    pairs = pairs.join(sent_if_few(products, m.product), "product_sk").select("store_id", "product_id").distinct()
    first, last = SNAPSHOT_DAYS
    jobs.refresh_inventory([first], opening=pairs.withColumn("quantity", m.counted().cast("decimal(12,3)")))
    for day in (BETWEEN, last):
        jobs.refresh_inventory([day])
    return wh.read(INVENTORY).drop("year_month")


@_registered
def campaign_performance(m: DemoModel) -> DataFrame:
    """Campaigns by store."""
    return campaigns_job(m.stored_sales, m.store, m.campaign)


@_registered
def set_union_periods(m: DemoModel) -> DataFrame:
    """Staged sales of two periods put together and counted by day."""
    moment = F.col("transaction_datetime")
    early, late = m.stg_sales.filter(moment < F.lit(CHANGE)), m.stg_sales.filter(moment >= F.lit(CHANGE))
    return early.unionByName(late).groupBy("date_id").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("units")
    )


# Windows ---------------------------------------------------------------------------


def _one_score(m: DemoModel, name: str, score: Score) -> DataFrame:
    base = cut(marts.rfm_base(m.sales, m.customer, AS_OF))
    return ntiles(base, "customer_sk", {name: score}, 5).join(
        base.select("customer_sk", score.column), "customer_sk"
    )


@_registered
def win_ntile_recency(m: DemoModel) -> DataFrame:
    return _one_score(m, "r_score", Score("recency_gun", descending=True))


@_registered
def win_ntile_frequency(m: DemoModel) -> DataFrame:
    return _one_score(m, "f_score", Score("alisveris_sayisi"))


@_registered
def win_ntile_monetary(m: DemoModel) -> DataFrame:
    return _one_score(m, "m_score", Score("toplam_harcama"))


# Marts ----------------------------------------------------------------------------


@_registered
def mart_sales_daily(m: DemoModel) -> DataFrame:
    return marts.sales_daily(
        m.sales, m.calendar, m.store, m.product, m.category, m.customer, m.campaign, m.region, send_stores=few(m.store)
    )


@_registered
def mart_published(m: DemoModel) -> DataFrame:
    """A statement over a published report, which shows what was appended after it was published."""
    wh = Warehouse(m.spark)
    tables = _dimensions(m) | {"dim.date": m.calendar, "dim.product_category": m.category, "dim.region": m.region}
    for name, frame in tables.items():
        wh.replace(name, frame)
    reports = report_views(wh, AS_OF, NOW)
    # The day is part of a line's key, so each load reads its own lines only and the fact isn't written before.
    for part in (F.col("date_id") < _key(CHANGE), F.col("date_id") >= _key(CHANGE)):
        wh.append(SALES, m.sales.filter(part))
        monthly = reports.sql("SELECT yil, month_number, departman, count(*) AS n, sum(adet) AS units FROM mart_v_sales_daily GROUP BY ALL")
    return monthly


@_registered
def mart_store_kpi_monthly(m: DemoModel) -> DataFrame:
    kpi = with_targets(daily_store_kpi(m.stored_sales, m.customer))
    return marts.store_kpi_monthly(kpi, m.calendar, m.store, m.region)


@_registered
def mart_inventory_alert(m: DemoModel) -> DataFrame:
    stock = inventory_job(m.sales, m.store, m.product, SNAPSHOT_DAYS, counted=m.counted())
    return marts.inventory_alert(stock, m.calendar, m.store, m.product, m.category, m.region)


@_registered
def mart_category_performance(m: DemoModel) -> DataFrame:
    return marts.category_performance(m.sales, m.calendar, m.store, m.product, m.category, m.region)


@_registered
def mart_customer_rfm(m: DemoModel) -> DataFrame:
    return marts.customer_rfm(m.sales, m.customer, AS_OF)


@_registered
def mart_etl_monitor(m: DemoModel) -> DataFrame:
    return marts.etl_monitor(log.latest_state(m.log_steps), NOW)


# KPI catalogue -----------------------------------------------------------------------


@_registered
def kpi_catalog(m: DemoModel) -> DataFrame:
    return catalog_job(daily_store_kpi(m.stored_sales, m.customer), m.store, m.calendar)


@_registered
def kpi_inventory(m: DemoModel) -> DataFrame:
    stock = stored(inventory_job(m.stored_sales, m.store, m.product, SNAPSHOT_DAYS, counted=m.counted()), "stock")
    return stock_kpi_job(stock, m.stored_sales, m.store, m.calendar)


# Quality ------------------------------------------------------------------------------


def _results(m: DemoModel) -> dict[str, DataFrame]:
    """The results of the jobs, with their digests as keys; each rule reads them once."""
    return {
        KPI: daily_store_kpi(m.stored_sales, m.customer),
        INVENTORY: inventory_job(m.stored_sales, m.store, m.product, SNAPSHOT_DAYS, counted=m.counted()),
        PERFORMANCE: campaigns_job(m.stored_sales, m.store, m.campaign),
    }


def _checked(m: DemoModel, results: bool = True) -> dict[str, DataFrame]:
    """The 20 tables as they stand before cleaning: sales as staged, with repeats. ``results`` are those that jobs work out."""
    frames = {f"dict.{name}": m.dictionary(name) for name in dictionaries.NAMES}
    if results:
        frames |= _results(m)
    sales = resolve_versions(m.stg_sales, m.store, m.product)
    sales = current_key(sales, m.customer, "customer_id", "customer_sk", LINE)
    sales = sales.withColumns(
        {
            "found_customer": F.col("customer_sk"),
            "employee_sk": F.col("employee_id") + 1,
            "campaign_sk": F.col("campaign_id"),
            "source_system": F.lit("POS"),
            "sales_tx_sk": F.col("transaction_id") * 10 + F.col("line_number"),
            "etl_loaded_at": F.col("transaction_datetime"),
        }
    )
    # without the column default, so that unknown customers show as missing
    sales = sales_measures(sales).withColumn("customer_sk", F.col("found_customer"))
    return frames | {
        "dim.date": m.calendar,
        "dim.region": m.region,
        "dim.store": m.store,
        "dim.product_category": m.category,
        "dim.product": m.product,
        "dim.customer": m.customer,
        "dim.employee": m.employee,
        "dim.campaign": m.campaign,
        SALES: shaped(sales, SALES),
        log.LOG: log.latest_state(m.log_steps),
    }


@_registered
def dq_duplicate_keys(m: DemoModel) -> DataFrame:
    return quality.duplicate_keys(_checked(m), apart={KPI, INVENTORY, PERFORMANCE, SALES})


@_registered
def dq_orphans(m: DemoModel) -> DataFrame:
    return quality.orphans(_checked(m))


@_registered
def dq_not_null(m: DemoModel) -> DataFrame:
    return quality.not_null(_checked(m))


@_registered
def dq_domain(m: DemoModel) -> DataFrame:
    return quality.domain(_checked(m, results=False))


@_registered
def dq_width(m: DemoModel) -> DataFrame:
    return quality.width(_checked(m, results=False))  # the results have no columns of a width


@_registered
def dq_scd2(m: DemoModel) -> DataFrame:
    """Consistency of the versioned dimensions; stores with all versions marked current."""
    broken = m.store.withColumn("is_current", F.lit(True)).withColumn(
        "scd_end_date", F.when(F.col("store_id") % 2 == 0, F.col("scd_end_date"))
    )
    return quality.scd2(
        {"dim.store": broken, "dim.product": m.product, "dim.customer": m.customer, "dim.employee": m.employee}
    )


# Runs ----------------------------------------------------------------------------------


def _dimensions(m: DemoModel) -> dict[str, DataFrame]:
    return {
        "dim.store": m.store, "dim.product": m.product, "dim.customer": m.customer,
        "dim.employee": m.employee, "dim.campaign": m.campaign,
    }


@_registered
def etl_full_run(m: DemoModel) -> DataFrame:
    """A warehouse filled, run through the night of the change, and caught up.

    Sales up to the eve load in one go, then the nightly run versions stores
    and products and loads one day, then the rest loads from the watermark.
    """
    wh = Warehouse(m.spark)
    jobs = Jobs(wh)
    campaigns = m.campaign.filter("campaign_id > 0").drop("campaign_sk", "created_at")
    jobs.bootstrap(
        {
            "stg_region": m.stg_region,
            "stg_product_category": m.stg_category,
            "stg_store": m.stg_store(False),
            "stg_product": m.stg_product(False),
            "stg_customer": m.stg_customer,
            "stg_employee": m.stg_employee,
            "stg_campaign": campaigns,
        },
        FIRST_DAY, LAST_DAY, OPENING,
    )
    eve = CHANGE - timedelta(days=1)
    # A load's window is one of shipments, so each load joins its own lines only and all of them aren't written before.
    staged = m.stg_sales
    jobs.incremental_sales(staged, BEFORE_ALL, eve)
    jobs.refresh_daily_kpi(FIRST_DAY, eve)
    night = {"stg_store": m.stg_store(), "stg_product": m.stg_product(), "stg_sales_transaction": staged}
    jobs.run_etl(night, CHANGE)
    jobs.incremental_sales(staged, None, AFTER_ALL)
    jobs.refresh_daily_kpi(CHANGE, LAST_DAY)
    return wh.read(KPI).select(*_KPI)


def _streamed(m: DemoModel) -> Warehouse:
    """The staged sales delivered in three drops, the middle one twice, and loaded by the stream."""
    wh = Warehouse(m.spark)
    landing, checkpoint = scratch_path(m.spark, "landing"), scratch_path(m.spark, "stream")
    moment = F.col("transaction_datetime")
    ends = [date(1997, 6, 30), date(1999, 12, 31), AFTER_ALL]
    for after, upto in zip([BEFORE_ALL, *ends], ends):
        inside = (moment > F.lit(after)) & (moment <= F.lit(upto))
        # The moment is the shipment's, so each drop joins its own lines only and all of them aren't written before.
        m.stg_sales.filter(inside).write.mode("append").parquet(landing)
        if upto == ends[1]:
            m.spark.read.schema(m.stg_sales.schema).parquet(landing).filter(inside).write.mode("append").parquet(landing)
        stream_sales(m.spark, landing, checkpoint, wh, lambda: _dimensions(m))
    return wh


@_registered
def stream_incremental_sales(m: DemoModel) -> DataFrame:
    """The sales loaded by the stream."""
    return _streamed(m).read(SALES).select(*_FACT)


@_registered
def stream_rejects(m: DemoModel) -> DataFrame:
    """The lines the stream could not place; a line delivered again with the same content is one."""
    return RejectStore(log.BatchLog(m.spark, _streamed(m).root)).waiting().select(*_REJECTED)
