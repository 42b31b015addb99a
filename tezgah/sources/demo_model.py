"""Order-management tables seen as a retail chain.

Maps ``region nation customer supplier part orders lineitem`` to the staging,
dimension and fact frames of the warehouse: suppliers are stores, parts are
products, order lines are receipt lines. Everything is lazy; each attribute
builds a plan over the source Parquet files.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tezgah import dictionaries
from tezgah.functions.calendar import date_range, dim_date
from tezgah.functions.expressions import UNKNOWN, attribute_hash, date_key
from tezgah.functions.literals import literal_rows
from tezgah.operators.scd import CUSTOMER, EMPLOYEE, PRODUCT, STORE
from tezgah.plans.kpi import KPI
from tezgah.plans.sales import SALES, SalesLoad, incremental_sales
from tezgah.schemas import shaped
from tezgah.sources.shared import stored

OPENING = date(1990, 1, 1)
CHANGE = date(1998, 7, 1)  # the day second versions start
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 12, 31)
BEFORE_ALL, AFTER_ALL = date(1990, 1, 1), date(2002, 1, 1)
AS_OF = LAST_DAY
SNAPSHOT_DAYS = (date(1998, 6, 30), date(2001, 10, 15))

# Fixed values of the mapping.
FORMATS = ("HYPER", "SUPER", "EXPRESS", "OUTLET")
CLUSTERS = ("A", "B", "C", "D")
PART_TYPES = ("SMALL", "MEDIUM", "LARGE", "ECONOMY", "STANDARD", "PROMO")
AGE_BANDS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
TIERS = ("Platin", "Altın", "Gümüş", None)
SEGMENTS = ("Metropolitan", "Urban", "Rural")
NO_STORE = -404  # staged for some receipts, known to no dimension
GENDERS = ("M", "F", "U")
CLV = ("High", "Medium", "Low")


def _nth(values: tuple, position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def _coded(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


class DemoModel:
    """The frames of the warehouse over one folder of source tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def dictionary(self, name: str) -> DataFrame:
        return dictionaries.dictionary(self.spark, name)

    # Static and overwritten dimensions -------------------------------------

    @cached_property
    def calendar(self) -> DataFrame:
        return dim_date(date_range(self.spark, FIRST_DAY, LAST_DAY))

    @cached_property
    def stg_region(self) -> DataFrame:
        nation, region = self.source("nation"), self.source("region")
        key = F.col("n_nationkey")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            key.cast("bigint").alias("region_id"),
            _coded("R", key).alias("region_code"),
            F.concat(F.col("n_name"), F.lit(" Bölgesi")).alias("region_name"),
            F.col("n_name").alias("city"),
            _coded("C", key).alias("city_code"),
            _coded("TR", F.col("n_regionkey")).alias("nuts2_code"),
            F.col("r_name").alias("nuts2_name"),
            F.lit("Europe/Istanbul").alias("timezone"),
            _nth(SEGMENTS, key % 3).alias("population_segment"),
        )

    @cached_property
    def region(self) -> DataFrame:
        rows = self.stg_region.withColumn("region_sk", F.col("region_id") + 1)
        return self._stored(rows, "dim.region")

    @cached_property
    def stg_category(self) -> DataFrame:
        kinds = self.source("part").select("p_type", "p_brand", _size_band().alias("band")).distinct()
        brand = _brand_number()
        return kinds.select(
            _category_id(F.col("band")).alias("category_id"),
            _coded("D", F.array_position(F.array(*[F.lit(t) for t in PART_TYPES]), F.col("p_type"))).alias(
                "department_code"
            ),
            F.col("p_type").alias("department_name"),
            _coded("K", brand).alias("category_code"),
            F.col("p_brand").alias("category_name"),
            F.concat(_coded("K", brand), _coded("-", F.col("band"))).alias("subcategory_code"),
            F.concat(F.col("p_brand"), _coded("-", F.col("band"))).alias("subcategory_name"),
            F.col("p_type").isin("SMALL", "MEDIUM").alias("is_food"),
            F.lit(False).alias("is_private_label"),
            F.when(F.col("p_type") == "SMALL", 1).otherwise(20).cast("decimal(5,2)").alias("vat_rate"),
        )

    @cached_property
    def category(self) -> DataFrame:
        rows = self.stg_category.withColumn("category_sk", F.col("category_id") + 1)
        return self._stored(rows, "dim.product_category")

    @cached_property
    def campaign(self) -> DataFrame:
        rows = [(UNKNOWN, UNKNOWN, "NO_CAMPAIGN", "Kampanyasız", None, None, date(2000, 1, 1), date(2099, 12, 31))]
        rows += [
            (i, i, f"CAMP-{i:03d}", f"Yaz {1995 + i}", "İndirim", "Mağaza",
             date(1995 + i, 6, 1), date(1995 + i, 8, 31))
            for i in range(1, 5)
        ]
        frame = literal_rows(
            self.spark, rows,
            "campaign_sk bigint, campaign_id bigint, campaign_code string, campaign_name string, "
            "campaign_type string, channel string, start_date date, end_date date",
        )
        return self._stored(frame.withColumn("is_active", F.lit(True)), "dim.campaign")

    # Versioned dimensions ---------------------------------------------------

    def stg_store(self, changed: bool = True) -> DataFrame:
        """Staged stores; every third has moved to the next cluster if ``changed``."""
        key = F.col("s_suppkey")
        shift = F.when(key % 3 == 0, 1).otherwise(0) if changed else F.lit(0)
        size = 200 + (key * 37) % 5000
        return self.source("supplier").select(
            key.alias("store_id"),
            _coded("STR-", key).alias("store_code"),
            F.col("s_name").alias("store_name"),
            _coded("S", key).alias("store_short_name"),
            _nth(FORMATS, key % 4).alias("format_code"),
            size.cast("int").alias("store_sqm"),
            F.floor(size * 72 / F.lit(100)).cast("int").alias("selling_sqm"),
            F.col("s_nationkey").cast("bigint").alias("region_id"),
            (key % 8 == 0).alias("is_mall_store"),
            (key % 13 == 0).alias("is_franchise"),
            _nth(CLUSTERS, ((key * 7) % 4 + shift) % 4).alias("cluster"),
            (4 + key % 40).cast("int").alias("headcount"),
            F.lit(date(1989, 1, 1)).alias("opening_date"),
        )

    def stg_product(self, changed: bool = True) -> DataFrame:
        """Staged products; every fifth costs a tenth more if ``changed``."""
        key = F.col("p_partkey")
        price = F.col("p_retailprice").cast("decimal(12,2)")
        if changed:
            raised = F.round(price * F.lit("1.1").cast("decimal(2,1)"), 2).cast("decimal(12,2)")
            price = F.when(key % 5 == 0, raised).otherwise(price)
        return self.source("part").select(
            key.alias("product_id"),
            _coded("869", key).alias("sku_code"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            _category_id(_size_band()).alias("category_id"),
            F.lit("ADET").alias("unit_of_measure"),
            _coded("SUP-", key % 100).alias("supplier_code"),
            price.alias("list_price"),
            F.round(price * F.lit("0.6").cast("decimal(2,1)"), 2).cast("decimal(12,2)").alias("cost_price"),
            F.when(key % 17 == 0, "DISCONTINUED").when(key % 11 == 0, "SEASONAL").otherwise("ACTIVE").alias(
                "status_code"
            ),
            (F.col("p_type") == "PROMO").alias("is_private_label"),
            (F.col("p_type") == "SMALL").alias("is_perishable"),
        )

    @cached_property
    def store(self) -> DataFrame:
        rows = self._versions(self.stg_store(False), self.stg_store(True), STORE, 3)
        return self._stored(rows.withColumn("region_sk", F.col("region_id") + 1), "dim.store")

    @cached_property
    def product(self) -> DataFrame:
        rows = self._versions(self.stg_product(False), self.stg_product(True), PRODUCT, 5)
        return self._stored(rows.withColumn("category_sk", F.col("category_id") + 1), "dim.product")

    @cached_property
    def stg_customer(self) -> DataFrame:
        key = F.col("c_custkey")
        nation = self.source("nation").select("n_nationkey", F.col("n_name").alias("city"))
        return self.source("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("customer_id"),
            F.col("c_mktsegment").alias("customer_segment"),
            _nth(AGE_BANDS, key % 6).alias("age_band"),
            _nth(GENDERS, key % 3).alias("gender"),
            "city",
            (key % 3 != 0).alias("loyalty_enrolled"),
            _nth(TIERS, key % 4).alias("loyalty_tier"),
            _nth(CLV, key % 3).alias("clv_segment"),
        )

    @cached_property
    def customer(self) -> DataFrame:
        """Known customers and the unknown member."""
        known = self.stg_customer.withColumns(
            {
                "customer_sk": F.col("customer_id") + 1,
                "scd_hash": attribute_hash(CUSTOMER.tracked),
                "scd_start_date": F.lit(OPENING),
                "is_current": F.lit(True),
                "scd_version": F.lit(1),
            }
        )
        unknown = literal_rows(
            self.spark, [(UNKNOWN, UNKNOWN, "Anonim", "U", False, date(2000, 1, 1), True, 1)],
            "customer_sk bigint, customer_id bigint, customer_segment string, gender string, "
            "loyalty_enrolled boolean, scd_start_date date, is_current boolean, scd_version int",
        )
        return self._stored(known, "dim.customer").unionByName(self._stored(unknown, "dim.customer"))

    @cached_property
    def stg_employee(self) -> DataFrame:
        number = F.col("s_suppkey") * 10 + F.col("seat")
        seats = self.source("supplier").select(
            "s_suppkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("seat")
        )
        return seats.select(
            number.alias("employee_id"),
            _coded("EMP-", number).alias("employee_code"),
            _coded("Çalışan ", number).alias("full_name"),
            F.when(F.col("seat") == 0, "Mağaza Müdürü").otherwise("Kasiyer").alias("job_title"),
            F.lit("Satış").alias("department"),
            F.lit("Tam Zamanlı").alias("employment_type"),
            F.col("s_suppkey").alias("store_id"),
            (F.col("s_suppkey") * 10).alias("manager_employee_id"),
        )

    @cached_property
    def employee(self) -> DataFrame:
        rows = self.stg_employee.withColumns(
            {
                "employee_sk": F.col("employee_id") + 1,
                "scd_hash": attribute_hash(EMPLOYEE.tracked),
                "scd_start_date": F.lit(OPENING),
                "is_current": F.lit(True),
                "scd_version": F.lit(1),
            }
        )
        return self._stored(rows, "dim.employee")

    # Sales --------------------------------------------------------------------

    @cached_property
    def stg_sales(self) -> DataFrame:
        """Receipt lines as the tills deliver them, with repeats and unknown keys."""
        line, orders, part = self.source("lineitem"), self.source("orders"), self.source("part")
        joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
            part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey")
        )
        order, money = F.col("l_orderkey"), "decimal(12,2)"
        price = F.col("p_retailprice").cast(money)
        rate = 1 - F.col("l_discount").cast("decimal(4,2)")
        kind = (
            F.when(F.col("l_returnflag") == "R", 2)
            .when(order % 50 == 0, 5)
            .when(order % 50 == 1, 8)
            .otherwise(1)
        )
        units = F.col("l_quantity").cast("decimal(10,3)")
        priced = joined.select(
            order.alias("transaction_id"),
            F.col("l_linenumber").alias("line_number"),
            F.when(order % 97 == 0, NO_STORE).otherwise(F.col("l_suppkey")).alias("store_id"),
            F.col("l_partkey").alias("product_id"),
            F.when(F.col("o_custkey") % 17 == 0, UNKNOWN).otherwise(F.col("o_custkey")).alias("customer_id"),
            (F.col("l_suppkey") * 10 + F.col("l_linenumber") % 3).alias("employee_id"),
            F.when(order % 101 == 0, 99)
            .when(F.col("o_orderpriority") == "5-LOW", UNKNOWN)
            .otherwise(F.substring("o_orderpriority", 1, 1).cast("bigint"))
            .cast("bigint")
            .alias("campaign_id"),
            (1 + order % 9).cast("int").alias("payment_method_id"),
            kind.alias("transaction_type_id"),
            F.when(kind == 2, -units).otherwise(units).cast("decimal(10,3)").alias("quantity"),
            price.alias("unit_list_price"),
            (price * rate).cast(money).alias("unit_selling_price"),
            (price * F.lit("0.60").cast("decimal(3,2)")).cast(money).alias("unit_cost"),
            units.alias("_units"),
            F.col("l_tax").cast("decimal(4,2)").alias("_tax"),
            F.col("l_shipdate").alias("transaction_datetime"),
        )
        selling, amount = F.col("unit_selling_price"), "decimal(14,2)"
        return priced.withColumns(
            {
                "discount_amount": ((F.col("unit_list_price") - selling) * F.col("_units")).cast(amount),
                "vat_amount": (selling * F.col("_units") * F.col("_tax")).cast(amount),
                "date_id": date_key("transaction_datetime"),
            }
        ).drop("_units", "_tax")

    def load(self, existing: DataFrame | None = None, shared: bool = False) -> SalesLoad:
        """All staged sales through the incremental load, against every version."""
        return incremental_sales(
            self.stg_sales, self.store, self.product, self.customer, self.employee, self.campaign,
            watermark_from=BEFORE_ALL, watermark_to=AFTER_ALL, existing=existing, shared=shared,
        )

    @cached_property
    def sales(self) -> DataFrame:
        """The loaded fact as a plan: for reports that pass over it once."""
        return self.load().rows

    @staticmethod
    def counted() -> Column:
        """What the demo's stores had of a product before their first sale, as no count is in the tables."""
        return 20 + (F.col("store_id") * 13 + F.col("product_id") * 7) % 60

    @cached_property
    def stored_sales(self) -> DataFrame:
        """The loaded fact as a written table: for jobs that pass over it repeatedly."""
        # The looked-up lines are written too: then the shuffles before them are off the disk, and only copies meet by whole lines.
        return stored(self.load(shared=True).rows, "sales")

    # Batch log -------------------------------------------------------------------

    @cached_property
    def log_steps(self) -> DataFrame:
        """A load log seen in the orders: each order is a batch, opened when ordered.

        Open orders have only their first step; the others a second one with
        the outcome, some tenths of a second per key later.
        """
        orders = self.source("orders")
        key, opened = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
        status = F.col("o_orderstatus")
        ended = opened + F.make_dt_interval(secs=(key % 977 * 7 + 3) / F.lit(10))
        target = F.when(key % 3 == 0, "dim.store").when(key % 3 == 1, KPI).otherwise(SALES)
        strategy = F.when(key % 3 == 0, "SCD2").when(key % 3 == 1, "TRUNCATE_INSERT").otherwise("INCREMENTAL")
        base = orders.select(
            key.alias("batch_id"),
            _coded("load_", key % 3).alias("batch_name"),
            target.alias("target_table"),
            strategy.alias("load_strategy"),
            F.lit("POS").alias("source_system"),
            status.alias("_status"),
            opened.alias("start_time"),
            ended.alias("_ended"),
            F.lit(0).cast("bigint").alias("rows_extracted"),
            (key % 1000).alias("_rows"),
            F.lit(0).cast("bigint").alias("rows_updated"),
            F.lit(0).cast("bigint").alias("rows_rejected"),
            F.date_sub(opened, 1).cast("timestamp_ntz").alias("watermark_from"),
            opened.alias("watermark_to"),
        )
        first = base.withColumns(
            {
                "step": F.lit(1),
                "status": F.lit("RUNNING"),
                "end_time": F.lit(None).cast("timestamp_ntz"),
                "rows_inserted": F.lit(0).cast("bigint"),
                "error_message": F.lit(None).cast("string"),
            }
        )
        failed = F.col("_status") == "F"
        outcome = F.when(failed, "FAILED").when(F.col("batch_id") % 7 == 0, "PARTIAL").otherwise("SUCCESS")
        second = base.filter(F.col("_status") != "O").withColumns(
            {
                "step": F.lit(2),
                "status": outcome,
                "end_time": F.col("_ended"),
                "rows_inserted": F.when(failed, 0).otherwise(F.col("_rows")),
                "error_message": F.when(failed, _coded("error in load ", F.col("batch_id"))),
            }
        )
        return first.unionByName(second).drop("_status", "_ended", "_rows")

    # ---------------------------------------------------------------------------

    @staticmethod
    def _versions(before: DataFrame, after: DataFrame, spec, every: int) -> DataFrame:
        """First versions, and second ones from the change day for each ``every``-th key."""
        moves = F.col(spec.key) % every == 0
        first = before.withColumns(
            {
                "scd_version": F.lit(1),
                "scd_start_date": F.lit(OPENING),
                "scd_end_date": F.when(moves, F.date_sub(F.lit(CHANGE), 1)),
                "is_current": ~moves,
            }
        )
        second = after.filter(moves).withColumns(
            {
                "scd_version": F.lit(2),
                "scd_start_date": F.lit(CHANGE),
                "scd_end_date": F.lit(None).cast("date"),
                "is_current": F.lit(True),
            }
        )
        return first.unionByName(second).withColumns(
            {
                spec.sk: F.col(spec.key) * 10 + F.col("scd_version"),
                "scd_hash": attribute_hash(spec.tracked),
            }
        )

    @staticmethod
    def _stored(rows: DataFrame, table: str) -> DataFrame:
        stamp = F.lit("1990-01-01 00:00:00").cast("timestamp_ntz")
        return shaped(rows.withColumns({"created_at": stamp, "updated_at": stamp}), table)


def _size_band() -> Column:
    return F.floor(F.col("p_size") / F.lit(10))


def _brand_number() -> Column:
    return F.substring_index("p_brand", "#", -1).cast("bigint")


def _category_id(band: Column) -> Column:
    kind = F.array_position(F.array(*[F.lit(t) for t in PART_TYPES]), F.col("p_type"))
    return (kind * 1000 + _brand_number() * 10 + band).cast("bigint")
