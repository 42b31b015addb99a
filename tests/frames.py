"""Small hand-made tables for the tests."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tezgah.functions.literals import literal_rows
from tezgah.schemas import STAGING, shaped

D = Decimal
STAMP = datetime(2020, 1, 1)


def stores(spark, rows):
    """rows: (store_sk, store_id, start, end, current, version)"""
    frame = spark.createDataFrame(
        rows,
        "store_sk bigint, store_id bigint, scd_start_date date, scd_end_date date, "
        "is_current boolean, scd_version int",
    ).withColumns({"store_sqm": F.lit(100), "headcount": F.lit(4), "format_code": F.lit("SUPER"),
                   "region_sk": F.lit(1)})
    return shaped(frame, "dim.store")


def products(spark, rows):
    """rows: (product_sk, product_id, start, end, current, version)"""
    frame = spark.createDataFrame(
        rows,
        "product_sk bigint, product_id bigint, scd_start_date date, scd_end_date date, "
        "is_current boolean, scd_version int",
    ).withColumns({"list_price": F.lit("10.00"), "cost_price": F.lit("6.00"), "category_sk": F.lit(1)})
    return shaped(frame, "dim.product")


def customers(spark, ids, enrolled=()):
    rows = [(-1, -1, False, date(2000, 1, 1), True, 1)]
    rows += [(100 + i, i, i in enrolled, date(2000, 1, 1), True, 1) for i in ids]
    frame = spark.createDataFrame(
        rows,
        "customer_sk bigint, customer_id bigint, loyalty_enrolled boolean, scd_start_date date, "
        "is_current boolean, scd_version int",
    )
    return shaped(frame, "dim.customer")


def employees(spark, ids=(7,)):
    frame = spark.createDataFrame(
        [(500 + i, i, True) for i in ids], "employee_sk bigint, employee_id bigint, is_current boolean"
    )
    return shaped(frame, "dim.employee")


def campaigns(spark):
    frame = spark.createDataFrame(
        [(-1, -1, date(2000, 1, 1), date(2099, 12, 31)), (3, 30, date(2024, 1, 10), date(2024, 1, 19))],
        "campaign_sk bigint, campaign_id bigint, start_date date, end_date date",
    )
    return shaped(frame, "dim.campaign")


def staged(spark, lines):
    """lines: dicts over defaults, one per staged sales line."""
    base = {
        "transaction_id": 1, "line_number": 1, "store_id": 1, "product_id": 1, "customer_id": 5,
        "employee_id": 7, "campaign_id": -1, "payment_method_id": 1, "transaction_type_id": 1,
        "quantity": D("1"), "unit_list_price": D("10"), "unit_selling_price": D("9"), "unit_cost": D("6"),
        "discount_amount": D("1"), "vat_amount": D("0.9"),
        "transaction_datetime": datetime(2024, 1, 15, 12), "date_id": None,
    }
    names = [field.split()[0] for field in STAGING["stg_sales_transaction"].split(", ")]
    rows = [tuple({**base, **line}[n] for n in names) for line in lines]
    frame = literal_rows(spark, rows, STAGING["stg_sales_transaction"])
    key = F.date_format("transaction_datetime", "yyyyMMdd").cast("int")
    return frame.withColumn("date_id", key)


ALWAYS = date(1990, 1, 1)
ONE_STORE = [(11, 1, ALWAYS, None, True, 1)]
ONE_PRODUCT = [(21, 1, ALWAYS, None, True, 1)]
