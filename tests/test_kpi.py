import random
from collections import defaultdict
from datetime import date, datetime
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

from pyspark.sql import functions as F

from tests.frames import ALWAYS, ONE_PRODUCT, ONE_STORE, campaigns, customers, employees, products, staged, stores
from tezgah.plans.inventory import inventory_snapshot
from tezgah.plans.campaigns import campaign_performance
from tezgah.plans.kpi import daily_store_kpi, kpi_catalog, pos_daily_kpi, with_targets
from tezgah.plans.sales import incremental_sales
from tezgah.functions.calendar import date_range, dim_date


def facts(spark, lines, store_rows=ONE_STORE, product_rows=ONE_PRODUCT):
    return incremental_sales(
        staged(spark, lines), stores(spark, store_rows), products(spark, product_rows), customers(spark, range(5, 9)),
        employees(spark), campaigns(spark), watermark_from="2000-01-01", watermark_to="2030-01-01",
    ).rows


def test_directions_customers_and_rounding(spark):
    lines = [
        {"transaction_id": 1, "quantity": D("1.5"), "customer_id": 5},
        {"transaction_id": 1, "line_number": 2, "quantity": D("1"), "customer_id": 5},
        {"transaction_id": 2, "transaction_type_id": 2, "quantity": D("-2.5"), "customer_id": 6},
        {"transaction_id": 3, "transaction_type_id": 5, "quantity": D("1"), "customer_id": -1},
        {"transaction_id": 4, "transaction_type_id": 3, "customer_id": -1},
    ]
    row = daily_store_kpi(facts(spark, lines), customers(spark, [5, 6], enrolled=[6])).first()
    # types 1, 5: 1.5*9-1, 1*9-1, 1*9-1; the return adds VAT and its amount only
    assert row["net_sales"] == D("28.50") and row["gross_sales"] == D("35.00")
    assert row["vat_collected"] == D("4.50")
    assert row["return_amount"] == D("23.50")
    assert (row["units_sold"], row["units_returned"]) == (3, -3)  # 2.5 and -2.5
    assert (row["transaction_count"], row["return_transaction_count"]) == (1, 1)
    assert (row["unique_customers"], row["loyalty_customers"]) == (2, 1)
    assert row["avg_basket_size"] == D("28.50") and row["avg_basket_items"] == D("2.50")
    assert row["sales_target"] is None and row["sales_vs_target_pct"] is None


def test_no_sale_gives_zero_ratios(spark):
    lines = [{"transaction_type_id": 2, "quantity": D("-1"), "discount_amount": D("0")}]
    row = daily_store_kpi(facts(spark, lines), customers(spark, [5])).first()
    assert [row[c] for c in ("avg_basket_size", "gross_margin_pct", "return_rate_pct")] == [0, 0, 0]


def test_targets(spark):
    kpi = daily_store_kpi(facts(spark, [{}]), customers(spark, [5]))
    row = with_targets(kpi).first()
    assert row["sales_target"] == D("8.64") and row["sales_vs_target_pct"] == D("92.5926")
    planned = spark.createDataFrame([(20240115, 11, D("16.00"))], "date_id int, store_sk bigint, sales_target decimal(16,2)")
    row = daily_store_kpi(facts(spark, [{}]), customers(spark, [5]), targets=planned).first()
    assert row["sales_vs_target_pct"] == D("50.0000")


def test_against_brute_force(spark):
    rng = random.Random(7)
    lines = [
        {
            "transaction_id": rng.randrange(60), "line_number": i, "customer_id": rng.choice([-1, 5, 6, 7]),
            "transaction_type_id": rng.choice([1, 1, 1, 2, 5, 8]), "quantity": D(rng.randrange(1, 9)),
            "discount_amount": D(rng.randrange(0, 300)) / 100, "transaction_datetime": datetime(2024, 1, rng.choice([14, 15]), 10),
        }
        for i in range(300)
    ]
    got = {r["date_id"]: r for r in daily_store_kpi(facts(spark, lines), customers(spark, range(5, 9), enrolled=[5, 6])).collect()}
    for day in (14, 15):
        mine = [x for x in lines if x["transaction_datetime"].day == day]
        out = [x for x in mine if x["transaction_type_id"] in (1, 5, 8)]
        net = sum(x["quantity"] * 9 - x["discount_amount"] for x in out)
        receipts = len({x["transaction_id"] for x in mine if x["transaction_type_id"] == 1})
        row = got[20240100 + day]
        assert row["net_sales"] == net
        assert row["transaction_count"] == receipts
        assert row["unique_customers"] == len({x["customer_id"] for x in mine} - {-1})
        assert row["loyalty_customers"] == len({x["customer_id"] for x in mine} & {5, 6})
        assert row["avg_basket_size"] == (net / receipts).quantize(D("0.01"), ROUND_HALF_UP)


def test_pos_definition(spark):
    lines = [
        {"transaction_id": 1, "customer_id": -1}, {"transaction_id": 2, "customer_id": -1, "quantity": D("2")},
        {"transaction_id": 3, "transaction_type_id": 2, "quantity": D("-1")},
    ]
    row = pos_daily_kpi(staged(spark, lines)).first()
    assert (row["transaction_count"], row["unique_customers"]) == (2, 1)
    assert row["net_sales"] == D("25.00") and row["gross_margin"] == D("7.00")
    assert row["avg_basket_size"] == D("12.50") and row["sales_target"] == D("27.00")


def test_catalogue_has_every_sales_code(spark):
    kpi = daily_store_kpi(facts(spark, [{}]), customers(spark, [5]))
    calendar = dim_date(date_range(spark, date(2024, 1, 1), date(2024, 1, 31)))
    values = {r["kpi_code"]: r["value"] for r in kpi_catalog(kpi, stores(spark, ONE_STORE), calendar).collect()}
    assert values["NET_SALES"] == 10.0 and values["SALES_PER_SQM"] == 0.08 and values["STAFF_SALES"] == 2.0
    assert values["NPS"] is None and values["CONVERSION_RATE"] is None


def test_inventory_against_brute_force(spark):
    rng = random.Random(3)
    lines = [
        {
            "transaction_id": i, "store_id": rng.choice([1, 2]), "product_id": rng.choice([1, 2]),
            "transaction_type_id": rng.choice([1, 2, 3, 4, 5, 8]), "quantity": D(rng.randrange(1, 6)),
            "transaction_datetime": datetime(2024, rng.randrange(1, 7), 10, 9),
        }
        for i in range(200)
    ]
    for x in lines:
        x["quantity"] = -x["quantity"] if x["transaction_type_id"] == 2 else x["quantity"]
    sites = [(11, 1, ALWAYS, None, True, 1), (12, 2, ALWAYS, None, True, 1)]
    goods = [(21, 1, ALWAYS, date(2024, 2, 29), False, 1), (22, 1, date(2024, 3, 1), None, True, 2),
             (23, 2, ALWAYS, None, True, 1)]
    days = [date(2024, 2, 15), date(2024, 6, 30)]
    rows = inventory_snapshot(
        facts(spark, lines, sites, goods), stores(spark, sites), products(spark, goods), days,
        counted=20 + (F.col("store_id") * 13 + F.col("product_id") * 7) % 60,
    ).collect()
    expected = {}
    for at in days:
        state = defaultdict(lambda: [D(0), D(0)])
        for x in lines:
            sold_on = x["transaction_datetime"].date()
            if sold_on > at or x["transaction_type_id"] not in (1, 2, 4, 5):
                continue
            entry = state[x["store_id"], x["product_id"]]
            entry[0] += -x["quantity"] if x["transaction_type_id"] in (1, 5) else abs(x["quantity"])
            if x["transaction_type_id"] == 1 and (at - sold_on).days < 90:
                entry[1] += x["quantity"]
        for (store, product), (moved, sold) in state.items():
            sk = 23 if product == 2 else (21 if at < date(2024, 3, 1) else 22)
            stock = 20 + (store * 13 + product * 7) % 60 + moved
            left = (stock * 90 / sold).quantize(D("0.01"), ROUND_HALF_UP) if sold else None
            expected[at.year * 10000 + at.month * 100 + at.day, 10 + store, sk] = (stock, left, stock <= 0, stock > 60)
    got = {
        (r["date_id"], r["store_sk"], r["product_sk"]): (r["stock_qty"], r["days_of_stock"], r["is_stockout"], r["is_overstock"])
        for r in rows
    }
    assert got == expected


def test_campaign_performance(spark):
    # campaign 30 runs 2024-01-10 .. 2024-01-19; the ten days before are its baseline
    at = lambda day: datetime(2024, 1, day, 9)
    lines = [
        {"transaction_id": 1, "customer_id": 5, "transaction_datetime": at(5)},
        {"transaction_id": 2, "customer_id": 5, "campaign_id": 30, "transaction_datetime": at(12)},
        {"transaction_id": 3, "customer_id": 6, "campaign_id": 30, "transaction_datetime": at(13), "quantity": D("3")},
        {"transaction_id": 4, "customer_id": 7, "campaign_id": 30, "transaction_datetime": at(25)},
    ]
    row = campaign_performance(facts(spark, lines), stores(spark, ONE_STORE), campaigns(spark)).collect()
    assert len(row) == 1
    row = row[0]
    assert row["total_sales_amount"] == D("34.00") and row["baseline_sales_amount"] == D("8.00")
    assert row["incremental_sales"] == D("26.00") and row["total_discount_given"] == D("2.00")
    assert row["campaign_roi_pct"] == D("1200.0000")
    assert (row["unique_customers"], row["new_customers"], row["participating_sku_count"]) == (2, 1, 1)


def test_a_campaign_refresh_reads_its_days_and_keeps_first_purchases(spark, monkeypatch):
    from tezgah.plans.campaigns import PERFORMANCE
    from tezgah.plans.jobs import Jobs
    from tezgah.plans.sales import SALES
    from tezgah.sources.warehouse import Warehouse

    at = lambda month, day: datetime(2024, month, day, 9)
    bought = [
        {"transaction_id": 1, "customer_id": 5, "campaign_id": 30, "transaction_datetime": at(1, 12)},
        {"transaction_id": 2, "customer_id": 6, "campaign_id": 30, "transaction_datetime": at(1, 13)},
        {"transaction_id": 3, "customer_id": 7, "transaction_datetime": at(5, 13)},
    ]
    jobs = Jobs(Warehouse(spark))
    for name, frame in {"dim.store": stores(spark, ONE_STORE), "dim.product": products(spark, ONE_PRODUCT), "dim.customer": customers(spark, [5, 6, 7]),
                        "dim.employee": employees(spark), "dim.campaign": campaigns(spark)}.items():
        jobs.wh.replace(name, frame)

    def refreshed():
        opened, real = [], Warehouse.read
        monkeypatch.setattr(Warehouse, "read", lambda self, table, *days: (opened.append(days) if table == SALES else None, real(self, table, *days))[1])
        jobs.refresh_campaign_performance()
        monkeypatch.setattr(Warehouse, "read", real)
        assert (date(2023, 12, 31), date(2024, 1, 19)) in opened
        row = jobs.wh.read(PERFORMANCE).first()
        whole = campaign_performance(jobs.wh.read(SALES), jobs.wh.read("dim.store"), jobs.wh.read("dim.campaign")).first()
        assert {**row.asDict(), "etl_loaded_at": None} == {**whole.asDict(), "etl_loaded_at": None}
        return row["unique_customers"], row["new_customers"]

    jobs.incremental_sales(staged(spark, bought), "2023-01-01", "2025-01-01")
    assert refreshed() == (2, 2)
    # a sale of the year before comes in late: customer 6 was no new one
    jobs.incremental_sales(staged(spark, [{"transaction_id": 9, "customer_id": 6, "transaction_datetime": datetime(2023, 3, 1, 9)}]), "2023-01-01", "2024-01-01")
    assert refreshed() == (2, 1)
    assert refreshed() == (2, 1)
