"""Keys, references, required columns and widths of the 20 tables, apart from the library's own catalogue."""

from __future__ import annotations

import re

# The public constraints. ``(n)`` is a declared width, ``!`` marks a required column; others aren't listed.
_COLUMNS = {
    "dict.d_currency": """
        currency_code(3)! currency_name(50)! currency_symbol(5)! is_active!""",
    "dict.d_day_type": """
        day_type_id! day_type_name(30)! is_working_day!""",
    "dict.d_store_format": """
        format_code(10)! format_name(50)! description(200)""",
    "dict.d_product_status": """
        status_code(15)! status_name(40)! is_sellable!""",
    "dict.d_transaction_type": """
        transaction_type_id! type_name(50)! affects_inventory! affects_revenue! direction(1)!""",
    "dict.d_payment_method": """
        payment_method_id! method_name(40)! is_digital!""",
    "dict.d_kpi_definition": """
        kpi_code(30)! kpi_name(100)! kpi_category(50)! unit(20)! higher_is_better!""",
    "dim.date": """
        date_id! full_date! day_of_week! day_name(15)! day_name_tr(15)! day_of_month! day_of_year!
        week_of_year! week_start_date! month_number! month_name(15)! month_name_tr(15)! month_short(3)!
        quarter_number! quarter_name(2)! year_number! fiscal_week! fiscal_month! fiscal_quarter! fiscal_year!
        is_weekend! is_public_holiday! is_religious_day! holiday_name(100) season(10)""",
    "dim.region": """
        region_sk! region_id! region_code(10)! region_name(60)! city(60)! city_code(10)! district(60)
        nuts2_code(5) nuts2_name(60) timezone(40)! population_segment(20) created_at! updated_at!""",
    "dim.store": """
        store_sk! store_id! store_code(20)! store_name(100)! store_short_name(40) format_code(10) address(255)
        mall_name(100) is_mall_store! is_franchise! cluster(20) scd_start_date! is_current! scd_version!
        scd_hash(64) created_at! updated_at!""",
    "dim.product_category": """
        category_sk! category_id! department_code(10)! department_name(60)! category_code(15)!
        category_name(80)! subcategory_code(20)! subcategory_name(100)! segment_code(25) segment_name(100)
        is_food! is_private_label! vat_rate! created_at! updated_at!""",
    "dim.product": """
        product_sk! product_id! sku_code(30)! product_name(255)! product_short_name(100) brand(80)
        supplier_name(100) supplier_code(20) unit_of_measure(10)! package_size(30) status_code(10)
        is_private_label! is_perishable! scd_start_date! is_current! scd_version! scd_hash(64) created_at!
        updated_at!""",
    "dim.customer": """
        customer_sk! customer_id! customer_segment(30) age_band(15) gender(1) city(60) acquisition_channel(40)
        loyalty_enrolled! loyalty_tier(20) clv_segment(20) scd_start_date! is_current! scd_version!
        scd_hash(64) created_at! updated_at!""",
    "dim.employee": """
        employee_sk! employee_id! employee_code(20)! full_name(100)! job_title(80) department(60)
        employment_type(20) scd_start_date! is_current! scd_version! scd_hash(64) created_at! updated_at!""",
    "dim.campaign": """
        campaign_sk! campaign_id! campaign_code(30)! campaign_name(150)! campaign_type(40) channel(30)
        discount_type(20) start_date! end_date! is_active! created_at!""",
    "fact.sales_transaction": """
        sales_tx_sk! transaction_id! line_number! date_id! store_sk! product_sk! customer_sk! campaign_sk!
        transaction_type_id! quantity! unit_list_price! unit_selling_price! unit_cost! gross_sales_amount!
        discount_amount! net_sales_amount! cogs_amount! transaction_datetime! etl_loaded_at!
        source_system(30)!""",
    "fact.daily_store_kpi": """
        kpi_sk! date_id! store_sk! gross_sales! discount_amount! net_sales! cogs! gross_margin! vat_collected!
        return_amount! units_sold! units_returned! transaction_count! return_transaction_count!
        unique_customers! loyalty_customers! etl_loaded_at!""",
    "fact.inventory_snapshot": """
        inv_sk! date_id! store_sk! product_sk! stock_qty! stock_value_cost! stock_value_retail! is_stockout!
        is_overstock! is_slow_mover! etl_loaded_at!""",
    "fact.campaign_performance": """
        camp_perf_sk! campaign_sk! store_sk! participating_sku_count! total_sales_amount!
        total_discount_given! total_units_sold! unique_customers! new_customers! etl_loaded_at!""",
    "staging.etl_batch_log": """
        batch_id! batch_name(100)! target_table(100)! load_strategy(20)! source_system(50) status(20)!
        start_time!""",
}
KEYS = {
    "dict.d_currency": ["currency_code"],
    "dict.d_day_type": ["day_type_id"],
    "dict.d_store_format": ["format_code"],
    "dict.d_product_status": ["status_code"],
    "dict.d_transaction_type": ["transaction_type_id"],
    "dict.d_payment_method": ["payment_method_id"],
    "dict.d_kpi_definition": ["kpi_code"],
    "dim.date": ["date_id"],
    "dim.region": ["region_sk", "region_id"],
    "dim.store": ["store_sk"],
    "dim.product_category": ["category_sk", "category_id"],
    "dim.product": ["product_sk"],
    "dim.customer": ["customer_sk"],
    "dim.employee": ["employee_sk"],
    "dim.campaign": ["campaign_sk", "campaign_id"],
    "fact.sales_transaction": ["sales_tx_sk,date_id", "transaction_id,line_number,source_system,date_id"],
    "fact.daily_store_kpi": ["kpi_sk", "date_id,store_sk"],
    "fact.inventory_snapshot": ["inv_sk", "date_id,store_sk,product_sk"],
    "fact.campaign_performance": ["camp_perf_sk", "campaign_sk,store_sk"],
    "staging.etl_batch_log": ["batch_id"],
}
REFERENCES = {
    "dim.date": ["day_type_id dict.d_day_type"],
    "dim.store": ["format_code dict.d_store_format", "region_sk dim.region"],
    "dim.product": ["category_sk dim.product_category", "status_code dict.d_product_status"],
    "fact.sales_transaction": [
        "date_id dim.date", "store_sk dim.store", "product_sk dim.product", "customer_sk dim.customer", "employee_sk dim.employee",
        "campaign_sk dim.campaign", "payment_method_id dict.d_payment_method", "transaction_type_id dict.d_transaction_type",
    ],
    "fact.daily_store_kpi": ["date_id dim.date", "store_sk dim.store"],
    "fact.inventory_snapshot": ["date_id dim.date", "store_sk dim.store", "product_sk dim.product"],
    "fact.campaign_performance": ["campaign_sk dim.campaign", "store_sk dim.store", "start_date_id dim.date", "end_date_id dim.date"],
}

_PARTS = re.compile(r"(\w+)(?:\((\d+)\))?(!?)")
_READ = {table: [_PARTS.fullmatch(word).groups() for word in text.split()] for table, text in _COLUMNS.items()}
REQUIRED = {table: [name for name, _, need in columns if need] for table, columns in _READ.items()}
WIDE = {table: [name for name, width, _ in columns if width] for table, columns in _READ.items() if any(width for _, width, _ in columns)}
