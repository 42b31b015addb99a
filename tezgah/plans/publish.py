"""The report views over a warehouse, for SQL users and for export."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame

from tezgah.operators.lookups import few
from tezgah.plans import marts
from tezgah.plans.batches import LOG, BatchLog
from tezgah.plans.inventory import INVENTORY
from tezgah.plans.kpi import KPI
from tezgah.plans.sales import SALES
from tezgah.schemas import TABLES
from tezgah.sources.warehouse import Warehouse

NAMES = ("v_sales_daily", "v_store_kpi_monthly", "v_inventory_alert", "v_category_performance", "v_customer_rfm", "v_etl_monitor")


class Reports(Mapping):
    """The six views by name, each built from the tables as they stand when it is asked for.

    ``as_of`` is today for recency, ``now`` for running batches. Nothing runs before
    a view is asked for; a view that needs a job of its own (RFM, daily sales for the number of stores) runs it then.
    """

    def __init__(self, wh: Warehouse, as_of: date, now: str, history: str = "current", prefix: str = "mart_"):
        self.wh, self.as_of, self.now, self.history, self.prefix = wh, as_of, now, history, prefix

    def __iter__(self) -> Iterator[str]:
        return iter(NAMES)

    def __len__(self) -> int:
        return len(NAMES)

    def __getitem__(self, name: str) -> DataFrame:
        read, history = self.wh.read, self.history

        def context(*tables: str) -> list[DataFrame]:
            return [read(f"dim.{table}") for table in tables]

        match name:
            case "v_sales_daily":
                tables = context("date", "store", "product", "product_category", "customer", "campaign", "region")
                return marts.sales_daily(read(SALES), *tables, history, send_stores=few(tables[1]))
            case "v_store_kpi_monthly":
                return marts.store_kpi_monthly(read(KPI), *context("date", "store", "region"), history)
            case "v_inventory_alert":
                return marts.inventory_alert(read(INVENTORY), *context("date", "store", "product", "product_category", "region"), history)
            case "v_category_performance":
                return marts.category_performance(read(SALES), *context("date", "store", "product", "product_category", "region"), history)
            case "v_customer_rfm":
                return marts.customer_rfm(read(SALES), *context("customer"), self.as_of)
            case "v_etl_monitor":
                return marts.etl_monitor(BatchLog(self.wh.spark, self.wh.root).batches(), self.now)
        raise KeyError(name)

    def sql(self, text: str) -> DataFrame:
        """A statement over the views (``mart_v_sales_daily`` ...) and the tables (``fact_sales_transaction`` ...).

        The names it mentions stand for the tables as they are now, so rows added
        since the last statement show. Other names stay what they are in the session.
        """
        mentioned = set(re.findall(r"\w+", text))
        for name in NAMES:
            if self.prefix + name in mentioned:
                self[name].createOrReplaceTempView(self.prefix + name)
        tables = [table for table in TABLES if table.replace(".", "_") in mentioned and table != LOG]
        self.wh.register_views(tables)
        return self.wh.spark.sql(text)


def report_views(wh: Warehouse, as_of: date, now: str, history: str = "current") -> Reports:
    return Reports(wh, as_of, now, history)


def register_views(views: Mapping[str, DataFrame], prefix: str = "mart_") -> None:
    """Temp views for statements outside ``Reports.sql``; they show the tables as they are now."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(prefix + name)


def export(views: Mapping[str, DataFrame], folder: str) -> None:
    """Each view as Parquet below ``folder``, for tools that read files."""
    for name, frame in views.items():
        frame.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
