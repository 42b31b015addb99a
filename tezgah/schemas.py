"""Tables of the warehouse: columns, keys and the constraints to check.

Column lines read ``name type``; ``string(n)`` carries the declared width and
a trailing ``!`` means NOT NULL. Surrogate and business keys are BIGINT, as
32-bit keys run out long before the data volume this is meant for.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_COLUMN = re.compile(r"(\w+)\s+([a-z_]+(?:\([\d,]+\))?)(!?)$")


@dataclass(frozen=True)
class Table:
    """One table: its schema and what must hold for its rows."""

    name: str
    columns: str
    primary_key: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()  # column, table, column
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    business_key: str | None = None  # of a versioned dimension
    sequence: str | None = None  # generated surrogate key, absent from inputs

    def _parsed(self) -> list[tuple[str, str, bool]]:
        lines = [line.strip() for line in self.columns.strip().splitlines()]
        return [(m[1], m[2], bool(m[3])) for m in map(_COLUMN.match, lines)]

    @property
    def schema(self) -> T.StructType:
        text = ", ".join(
            f"{name} {'string' if kind.startswith('string') else kind}"
            for name, kind, _ in self._parsed()
        )
        return T.StructType.fromDDL(text)

    @property
    def not_null(self) -> list[str]:
        return [name for name, _, required in self._parsed() if required]

    @property
    def widths(self) -> dict[str, int]:
        return {
            name: int(kind[len("string("):-1])
            for name, kind, _ in self._parsed()
            if kind.startswith("string(")
        }


_SCD2 = """
scd_start_date date!
scd_end_date date
is_current boolean!
scd_version int!
scd_hash string(64)
created_at timestamp_ntz!
updated_at timestamp_ntz!
"""

_TABLES = [
    Table(
        "dict.d_currency",
        """currency_code string(3)!
        currency_name string(50)!
        currency_symbol string(5)!
        is_active boolean!""",
        ("currency_code",),
    ),
    Table(
        "dict.d_day_type",
        """day_type_id int!
        day_type_name string(30)!
        is_working_day boolean!""",
        ("day_type_id",),
    ),
    Table(
        "dict.d_store_format",
        """format_code string(10)!
        format_name string(50)!
        avg_sqm_min int
        avg_sqm_max int
        description string(200)""",
        ("format_code",),
    ),
    Table(
        "dict.d_product_status",
        """status_code string(15)!
        status_name string(40)!
        is_sellable boolean!""",
        ("status_code",),
    ),
    Table(
        "dict.d_transaction_type",
        """transaction_type_id int!
        type_name string(50)!
        affects_inventory boolean!
        affects_revenue boolean!
        direction string(1)!""",
        ("transaction_type_id",),
        domains={"direction": ("+", "-")},
    ),
    Table(
        "dict.d_payment_method",
        """payment_method_id int!
        method_name string(40)!
        is_digital boolean!""",
        ("payment_method_id",),
    ),
    Table(
        "dict.d_kpi_definition",
        """kpi_code string(30)!
        kpi_name string(100)!
        kpi_category string(50)!
        unit string(20)!
        higher_is_better boolean!
        description string
        formula string""",
        ("kpi_code",),
    ),
    Table(
        "dim.date",
        """date_id int!
        full_date date!
        day_of_week int!
        day_name string(15)!
        day_name_tr string(15)!
        day_of_month int!
        day_of_year int!
        week_of_year int!
        week_start_date date!
        month_number int!
        month_name string(15)!
        month_name_tr string(15)!
        month_short string(3)!
        quarter_number int!
        quarter_name string(2)!
        year_number int!
        fiscal_week int!
        fiscal_month int!
        fiscal_quarter int!
        fiscal_year int!
        is_weekend boolean!
        is_public_holiday boolean!
        is_religious_day boolean!
        holiday_name string(100)
        day_type_id int
        season string(10)""",
        ("date_id",),
        references=(("day_type_id", "dict.d_day_type", "day_type_id"),),
    ),
    Table(
        "dim.region",
        """region_sk bigint!
        region_id bigint!
        region_code string(10)!
        region_name string(60)!
        city string(60)!
        city_code string(10)!
        district string(60)
        nuts2_code string(5)
        nuts2_name string(60)
        latitude decimal(10,7)
        longitude decimal(10,7)
        timezone string(40)!
        population_segment string(20)
        created_at timestamp_ntz!
        updated_at timestamp_ntz!""",
        ("region_sk",),
        unique=(("region_id",),),
        sequence="region_sk",
    ),
    Table(
        "dim.store",
        """store_sk bigint!
        store_id bigint!
        store_code string(20)!
        store_name string(100)!
        store_short_name string(40)
        format_code string(10)
        store_sqm int
        selling_sqm int
        checkout_count int
        region_sk bigint
        address string(255)
        mall_name string(100)
        is_mall_store boolean!
        opening_date date
        renovation_date date
        closing_date date
        is_franchise boolean!
        cluster string(20)
        headcount int"""
        + _SCD2,
        ("store_sk",),
        references=(
            ("format_code", "dict.d_store_format", "format_code"),
            ("region_sk", "dim.region", "region_sk"),
        ),
        business_key="store_id",
        sequence="store_sk",
    ),
    Table(
        "dim.product_category",
        """category_sk bigint!
        category_id bigint!
        department_code string(10)!
        department_name string(60)!
        category_code string(15)!
        category_name string(80)!
        subcategory_code string(20)!
        subcategory_name string(100)!
        segment_code string(25)
        segment_name string(100)
        is_food boolean!
        is_private_label boolean!
        vat_rate decimal(5,2)!
        shelf_life_days int
        created_at timestamp_ntz!
        updated_at timestamp_ntz!""",
        ("category_sk",),
        unique=(("category_id",),),
        sequence="category_sk",
    ),
    Table(
        "dim.product",
        """product_sk bigint!
        product_id bigint!
        sku_code string(30)!
        product_name string(255)!
        product_short_name string(100)
        brand string(80)
        supplier_name string(100)
        supplier_code string(20)
        category_sk bigint
        unit_of_measure string(10)!
        net_weight_gr decimal(10,3)
        package_size string(30)
        list_price decimal(12,2)
        cost_price decimal(12,2)
        status_code string(10)
        is_private_label boolean!
        is_perishable boolean!"""
        + _SCD2,
        ("product_sk",),
        references=(
            ("category_sk", "dim.product_category", "category_sk"),
            ("status_code", "dict.d_product_status", "status_code"),
        ),
        business_key="product_id",
        sequence="product_sk",
    ),
    Table(
        "dim.customer",
        """customer_sk bigint!
        customer_id bigint!
        customer_segment string(30)
        age_band string(15)
        gender string(1)
        city string(60)
        acquisition_channel string(40)
        loyalty_enrolled boolean!
        loyalty_tier string(20)
        clv_segment string(20)
        total_visits_ytd int
        total_spend_ytd decimal(14,2)"""
        + _SCD2,
        ("customer_sk",),
        domains={"gender": ("M", "F", "U")},
        business_key="customer_id",
        sequence="customer_sk",
    ),
    Table(
        "dim.employee",
        """employee_sk bigint!
        employee_id bigint!
        employee_code string(20)!
        full_name string(100)!
        job_title string(80)
        department string(60)
        employment_type string(20)
        store_id bigint
        manager_employee_id bigint"""
        + _SCD2,
        ("employee_sk",),
        business_key="employee_id",
        sequence="employee_sk",
    ),
    Table(
        "dim.campaign",
        """campaign_sk bigint!
        campaign_id bigint!
        campaign_code string(30)!
        campaign_name string(150)!
        campaign_type string(40)
        channel string(30)
        discount_type string(20)
        discount_value decimal(10,2)
        start_date date!
        end_date date!
        budget_try decimal(14,2)
        is_active boolean!
        created_at timestamp_ntz!""",
        ("campaign_sk",),
        unique=(("campaign_id",),),
        sequence="campaign_sk",
    ),
    Table(
        "fact.sales_transaction",
        """sales_tx_sk bigint!
        transaction_id bigint!
        line_number int!
        date_id int!
        store_sk bigint!
        product_sk bigint!
        customer_sk bigint!
        employee_sk bigint
        campaign_sk bigint!
        payment_method_id int
        transaction_type_id int!
        quantity decimal(10,3)!
        unit_list_price decimal(12,2)!
        unit_selling_price decimal(12,2)!
        unit_cost decimal(12,2)!
        gross_sales_amount decimal(14,2)!
        discount_amount decimal(14,2)!
        net_sales_amount decimal(14,2)!
        cogs_amount decimal(14,2)!
        gross_margin_amount decimal(14,2)
        vat_amount decimal(14,2)
        gross_margin_pct decimal(7,4)
        transaction_datetime timestamp_ntz!
        etl_batch_id bigint
        etl_loaded_at timestamp_ntz!
        source_system string(30)!""",
        ("sales_tx_sk", "date_id"),
        unique=(("transaction_id", "line_number", "source_system", "date_id"),),
        references=(
            ("date_id", "dim.date", "date_id"),
            ("store_sk", "dim.store", "store_sk"),
            ("product_sk", "dim.product", "product_sk"),
            ("customer_sk", "dim.customer", "customer_sk"),
            ("employee_sk", "dim.employee", "employee_sk"),
            ("campaign_sk", "dim.campaign", "campaign_sk"),
            ("payment_method_id", "dict.d_payment_method", "payment_method_id"),
            ("transaction_type_id", "dict.d_transaction_type", "transaction_type_id"),
        ),
    ),
    Table(
        "fact.daily_store_kpi",
        """kpi_sk bigint!
        date_id int!
        store_sk bigint!
        gross_sales decimal(16,2)!
        discount_amount decimal(16,2)!
        net_sales decimal(16,2)!
        cogs decimal(16,2)!
        gross_margin decimal(16,2)!
        vat_collected decimal(16,2)!
        return_amount decimal(16,2)!
        units_sold int!
        units_returned int!
        transaction_count bigint!
        return_transaction_count bigint!
        unique_customers bigint!
        loyalty_customers bigint!
        avg_basket_size decimal(12,2)
        avg_basket_items decimal(8,2)
        gross_margin_pct decimal(18,4)
        return_rate_pct decimal(18,4)
        loyalty_rate_pct decimal(7,4)
        sku_count_active int
        sku_count_stockout int
        stockout_rate_pct decimal(7,4)
        total_inventory_value decimal(16,2)
        sales_target decimal(16,2)
        transaction_target int
        sales_vs_target_pct decimal(18,4)
        etl_batch_id bigint
        etl_loaded_at timestamp_ntz!""",
        ("kpi_sk",),
        unique=(("date_id", "store_sk"),),
        references=(
            ("date_id", "dim.date", "date_id"),
            ("store_sk", "dim.store", "store_sk"),
        ),
    ),
    Table(
        "fact.inventory_snapshot",
        """inv_sk bigint!
        date_id int!
        store_sk bigint!
        product_sk bigint!
        stock_qty decimal(12,3)!
        stock_value_cost decimal(14,2)!
        stock_value_retail decimal(14,2)!
        min_stock_level decimal(12,3)
        max_stock_level decimal(12,3)
        reorder_point decimal(12,3)
        days_of_stock decimal(18,2)
        is_stockout boolean!
        is_overstock boolean!
        is_slow_mover boolean!
        etl_batch_id bigint
        etl_loaded_at timestamp_ntz!""",
        ("inv_sk",),
        unique=(("date_id", "store_sk", "product_sk"),),
        references=(
            ("date_id", "dim.date", "date_id"),
            ("store_sk", "dim.store", "store_sk"),
            ("product_sk", "dim.product", "product_sk"),
        ),
    ),
    Table(
        "fact.campaign_performance",
        """camp_perf_sk bigint!
        campaign_sk bigint!
        store_sk bigint!
        start_date_id int
        end_date_id int
        participating_sku_count bigint!
        total_sales_amount decimal(16,2)!
        baseline_sales_amount decimal(16,2)
        incremental_sales decimal(16,2)
        total_discount_given decimal(16,2)!
        total_units_sold int!
        unique_customers bigint!
        new_customers bigint!
        campaign_roi_pct decimal(18,4)
        etl_loaded_at timestamp_ntz!""",
        ("camp_perf_sk",),
        unique=(("campaign_sk", "store_sk"),),
        references=(
            ("campaign_sk", "dim.campaign", "campaign_sk"),
            ("store_sk", "dim.store", "store_sk"),
            ("start_date_id", "dim.date", "date_id"),
            ("end_date_id", "dim.date", "date_id"),
        ),
    ),
    Table(
        "staging.etl_batch_log",
        """batch_id bigint!
        batch_name string(100)!
        target_table string(100)!
        load_strategy string(20)!
        source_system string(50)
        status string(20)!
        start_time timestamp_ntz!
        end_time timestamp_ntz
        rows_extracted bigint
        rows_inserted bigint
        rows_updated bigint
        rows_rejected bigint
        watermark_from timestamp_ntz
        watermark_to timestamp_ntz
        error_message string""",
        ("batch_id",),
        domains={
            "load_strategy": ("INCREMENTAL", "TRUNCATE_INSERT", "FULL_LOAD", "SCD2"),
            "status": ("RUNNING", "SUCCESS", "FAILED", "PARTIAL"),
        },
    ),
]

TABLES: dict[str, Table] = {table.name: table for table in _TABLES}

# Input files: what the staging CSVs hold (an empty field is NULL).
STAGING: dict[str, str] = {
    "stg_region": "region_id bigint, region_code string, region_name string, city string, "
    "city_code string, nuts2_code string, nuts2_name string, timezone string, "
    "population_segment string, latitude decimal(10,7), longitude decimal(10,7)",
    "stg_product_category": "category_id bigint, department_code string, department_name string, "
    "category_code string, category_name string, subcategory_code string, "
    "subcategory_name string, is_food boolean, is_private_label boolean, vat_rate decimal(5,2)",
    "stg_store": "store_id bigint, store_code string, store_name string, store_short_name string, "
    "format_code string, store_sqm int, selling_sqm int, region_id bigint, is_mall_store boolean, "
    "is_franchise boolean, cluster string, headcount int, opening_date date, scd_start_date date, "
    "scd_end_date date, is_current boolean, scd_version int",
    "stg_product": "product_id bigint, sku_code string, product_name string, brand string, "
    "category_id bigint, unit_of_measure string, list_price decimal(12,2), cost_price decimal(12,2), "
    "status_code string, is_private_label boolean, is_perishable boolean, scd_start_date date, "
    "scd_end_date date, is_current boolean, scd_version int",
    "stg_customer": "customer_id bigint, customer_segment string, age_band string, gender string, "
    "city string, loyalty_enrolled boolean, loyalty_tier string, clv_segment string, "
    "scd_start_date date, scd_end_date date, is_current boolean, scd_version int",
    "stg_sales_transaction": "transaction_id bigint, line_number int, store_id bigint, "
    "product_id bigint, customer_id bigint, employee_id bigint, campaign_id bigint, "
    "payment_method_id int, transaction_type_id int, quantity decimal(10,3), "
    "unit_list_price decimal(12,2), unit_selling_price decimal(12,2), unit_cost decimal(12,2), "
    "discount_amount decimal(14,2), vat_amount decimal(14,2), transaction_datetime timestamp_ntz, "
    "date_id int",
    "fact_daily_store_kpi": "date_id int, store_id bigint, gross_sales decimal(16,2), "
    "discount_amount decimal(16,2), net_sales decimal(16,2), cogs decimal(16,2), "
    "vat_collected decimal(16,2), units_sold decimal(16,3), transaction_count bigint, "
    "unique_customers bigint, gross_margin decimal(16,2), avg_basket_size decimal(12,2), "
    "gross_margin_pct decimal(18,4), sales_target decimal(16,2)",
}




def shaped(df: DataFrame, table: str) -> DataFrame:
    """The frame with exactly the table's columns and types; missing ones NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in TABLES[table].schema
        ]
    )
