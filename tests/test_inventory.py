"""Stock from the state of an earlier day against stock from the first sale."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.frames import ALWAYS, campaigns, customers, employees, products, staged, stores
from tezgah.functions.literals import literal_rows
from tezgah.plans.inventory import INVENTORY, Earlier, days_read, inventory_snapshot, stock_states
from tezgah.plans.jobs import Jobs
from tezgah.plans.sales import SALES, incremental_sales
from tezgah.sources.shared import stored
from tezgah.sources.warehouse import Warehouse

SITES = [(11, 1, ALWAYS, None, True, 1), (12, 2, ALWAYS, None, True, 1)]
GOODS = [(21, 1, ALWAYS, date(2024, 2, 29), False, 1), (22, 1, date(2024, 3, 1), None, True, 2), (23, 2, ALWAYS, None, True, 1)]
COUNTED = "store_id bigint, product_id bigint, quantity decimal(12,3)"


def lines(seed, n, first=date(2024, 1, 1), days=400, start=0):
    rng = random.Random(seed)
    kinds = [rng.choice([1, 1, 1, 2, 4, 5, 8]) for _ in range(n)]
    return [
        {
            "transaction_id": start + i, "store_id": rng.choice([1, 2]), "product_id": rng.choice([1, 2]), "transaction_type_id": kind,
            "quantity": D(rng.randrange(1, 6)) * (-1 if kind == 2 else 1),
            "transaction_datetime": datetime.combine(first + timedelta(rng.randrange(days)), datetime.min.time()) + timedelta(hours=rng.randrange(24)),
        }
        for i, kind in enumerate(kinds)
    ]


def facts(spark, rows):
    return incremental_sales(
        staged(spark, rows), stores(spark, SITES), products(spark, GOODS), customers(spark, [5]), employees(spark), campaigns(spark),
        watermark_from="2000-01-01", watermark_to="2030-01-01",
    ).rows


def content(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("step", [1, 40, 90, 91, 200])
def test_steps_give_what_the_whole_history_gives(spark, step):
    sales = stored(facts(spark, lines(step, 400)), "facts")
    opening = literal_rows(spark, [(1, 1, D("7.500")), (9, 9, D("1.000"))], COUNTED)
    sites, goods = stores(spark, SITES), products(spark, GOODS)
    day = date(2024, 4, 20)
    earlier = None
    for _ in range(3):
        spans = days_read(day, earlier.day if earlier else None)
        at = F.col("transaction_datetime").cast("date")
        near = F.lit(False)
        for low, high in spans:
            near = near | ((at >= F.lit(low or ALWAYS)) & (at <= F.lit(high)))
        state = stored(stock_states(sales.filter(near), sites, goods, [day], opening=opening, earlier=earlier), "state")
        whole = stock_states(sales, sites, goods, [day], opening=opening)
        assert content(state) == content(whole) and state.count() == 5
        earlier, day = Earlier(state.drop("at"), day), day + timedelta(step)


def test_no_more_is_read_than_entered_and_left():
    assert days_read(date(2024, 6, 30), None) == [(None, date(2024, 6, 30))]
    assert days_read(date(2024, 6, 30), date(2024, 6, 29)) == [(date(2024, 4, 1), date(2024, 4, 1)), (date(2024, 6, 30), date(2024, 6, 30))]


@pytest.fixture
def jobs(spark):
    made = Jobs(Warehouse(spark))
    frames = {"dim.store": stores(spark, SITES), "dim.product": products(spark, GOODS), "dim.customer": customers(spark, [5]),
              "dim.employee": employees(spark), "dim.campaign": campaigns(spark)}
    for name, frame in frames.items():
        made.wh.replace(name, frame)
    return made


def test_refreshes_go_on_from_the_last_state_and_start_anew_after_late_sales(spark, jobs, monkeypatch):
    spans = []
    real = Warehouse.read

    def read(self, table, low=None, high=None):
        if table == SALES:
            spans.append((low, high))
        return real(self, table, low, high)

    first = lines(1, 150, date(2024, 1, 1), 120)
    second = lines(2, 60, date(2024, 5, 1), 30, start=1000)
    late = lines(3, 10, date(2024, 2, 1), 5, start=2000)
    opening = literal_rows(spark, [(1, 1, D("7.500"))], COUNTED)
    jobs.incremental_sales(staged(spark, first), "2023-12-31", "2024-05-01")
    jobs.refresh_inventory([date(2024, 4, 30)], opening)
    jobs.incremental_sales(staged(spark, second), None, "2024-06-01")
    monkeypatch.setattr(Warehouse, "read", read)

    def refreshed(day):
        spans.clear()
        jobs.refresh_inventory([day])
        monkeypatch.setattr(Warehouse, "read", real)
        whole = inventory_snapshot(jobs.wh.read(SALES), jobs.wh.read("dim.store"), jobs.wh.read("dim.product"), [day], opening=opening)
        mine = jobs.wh.read(INVENTORY).filter(F.col("date_id") == int(f"{day:%Y%m%d}"))
        monkeypatch.setattr(Warehouse, "read", read)
        columns = [c for c in whole.columns if not c.startswith("etl_")]
        assert content(mine.select(*columns)) == content(whole.select(*columns)) != []
        return list(spans)

    assert refreshed(date(2024, 5, 31)) == [(date(2024, 2, 1), date(2024, 3, 2)), (date(2024, 5, 1), date(2024, 5, 31))]
    jobs.incremental_sales(staged(spark, late), "2024-01-31", "2024-03-01")
    assert refreshed(date(2024, 6, 1)) == [(None, date(2024, 6, 1))]
    assert refreshed(date(2024, 6, 2)) == [(date(2024, 3, 4), date(2024, 3, 4)), (date(2024, 6, 2), date(2024, 6, 2))]
