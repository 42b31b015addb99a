"""The load procedures: each reads and writes warehouse tables and logs a batch.

Arguments and defaults follow the procedures they replace; the staged frames,
which those found in tables, are passed in. A job that fails is logged as
FAILED and raises. Jobs run one after the other, as each reads what the one
before wrote.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tezgah import dictionaries
from tezgah.functions.calendar import date_range, dim_date
from tezgah.functions.expressions import UNKNOWN, date_key, month_key
from tezgah.functions.literals import literal_rows
from tezgah.operators.dedupe import insert_skip_conflicts
from tezgah.operators.scd import CUSTOMER, EMPLOYEE, PRODUCT, STORE, Parent, ScdSpec, scd1_upsert, scd2_apply
from tezgah.plans.batches import BatchLog
from tezgah.plans.campaigns import PERFORMANCE, FirstPurchases, campaign_performance, days_used
from tezgah.plans.inventory import INVENTORY, StockStates, days_read, stock_states, valued
from tezgah.plans.kpi import KPI, daily_store_kpi, generated
from tezgah.plans.rejects import RejectStore
from tezgah.plans.sales import ALWAYS_AFTER, ALWAYS_BEFORE, SALES, bulk_load, incremental_sales
from tezgah.schemas import TABLES, shaped
from tezgah.sources.csv_files import read_csv
from tezgah.sources.shared import cut, stored
from tezgah.sources.warehouse import Warehouse

# Source systems as the batch log names them.
ERP, POS, DW, SYSTEM = "ERP", "POS", "DW", "SYSTEM"
_PARENTS = {
    "dim.store": ("dim.region", "region_id", "region_sk"),
    "dim.product": ("dim.product_category", "category_id", "category_sk"),
}


# The campaigns of a first load.
CAMPAIGN_COLUMNS = (
    "campaign_id bigint, campaign_code string, campaign_name string, campaign_type string, channel string, "
    "start_date date, end_date date"
)
DEFAULT_CAMPAIGNS = [
    (1, "CAMP-001", "Yılbaşı İndirimi 2023", "İndirim", "Tüm Kanal", date(2022, 12, 15), date(2023, 1, 5)),
    (2, "CAMP-002", "Ramazan Kampanyası 2023", "İndirim", "Mağaza", date(2023, 3, 23), date(2023, 4, 21)),
    (3, "CAMP-003", "Yaz Sezonu 2023", "BOGO", "Tüm Kanal", date(2023, 6, 1), date(2023, 8, 31)),
    (4, "CAMP-004", "Yılbaşı İndirimi 2024", "İndirim", "Tüm Kanal", date(2023, 12, 15), date(2024, 1, 5)),
    (5, "CAMP-005", "Yaz Sezonu 2024", "BOGO", "Online", date(2024, 6, 1), date(2024, 8, 31)),
]


class Jobs:
    """The load procedures over one warehouse."""

    def __init__(self, warehouse: Warehouse):
        self.wh = warehouse
        self.spark: SparkSession = warehouse.spark
        self.log = BatchLog(self.spark, warehouse.root)
        self.rejects = RejectStore(self.log)
        self.stock = StockStates(self.log)

    # Dictionaries, calendar, unknown members --------------------------------

    def create(self) -> None:
        """Dictionaries and the unknown members of customer and campaign."""
        for name in dictionaries.NAMES:
            table = f"dict.{name}"
            if not self.wh.exists(table):
                self.wh.replace(table, dictionaries.dictionary(self.spark, name))
        seeds = {
            "dim.customer": (
                "customer_sk bigint, customer_id bigint, customer_segment string, gender string, "
                "loyalty_enrolled boolean, scd_start_date date, is_current boolean, scd_version int",
                (UNKNOWN, UNKNOWN, "Anonim", "U", False, date(2000, 1, 1), True, 1),
            ),
            "dim.campaign": (
                "campaign_sk bigint, campaign_id bigint, campaign_code string, campaign_name string, "
                "start_date date, end_date date, is_active boolean",
                (UNKNOWN, UNKNOWN, "NO_CAMPAIGN", "Kampanyasız", date(2000, 1, 1), date(2099, 12, 31), True),
            ),
        }
        for table, (columns, row) in seeds.items():
            if not self.wh.exists(table):
                seed = literal_rows(self.spark, [row], columns)
                stamps = {"created_at": F.localtimestamp(), "updated_at": F.localtimestamp()}
                self.wh.replace(table, shaped(seed.withColumns(stamps), table))

    def load_dim_date(
        self,
        start: date = date(2020, 1, 1),
        end: date = date(2030, 12, 31),
        holidays: DataFrame | None = None,
    ) -> None:
        with self.log.batch("load_dim_date", "dim.date", "FULL_LOAD", SYSTEM, start, end) as batch:
            days = dim_date(date_range(self.spark, start, end), holidays)
            known = self.wh.read("dim.date").select("date_id")
            batch.count(inserted=self.wh.append("dim.date", days.join(known, "date_id", "left_anti"))["rows"])

    # Dimensions ------------------------------------------------------------------

    def scd1(self, table: str, staged: DataFrame, key: str, defaults: dict | None = None) -> None:
        """Overwrites region, category or campaign rows by business key."""
        with self.log.batch(f"scd1_{table.split('.')[1]}", table, "FULL_LOAD", ERP) as batch:
            target = self.wh.read(table)
            before, given = target.count(), staged.count()
            after = self.wh.replace(table, scd1_upsert(target, staged, key, TABLES[table].sequence, defaults))["rows"]
            batch.count(inserted=after - before, updated=given - (after - before))

    def scd2(
        self, spec: ScdSpec, staged: DataFrame, effective: date | None = None, hash_null: str = "skip"
    ) -> None:
        """Versions a dimension; counts are of the rows really written."""
        name = spec.table.split(".")[1]
        with self.log.batch(f"scd2_{name}", spec.table, "SCD2", ERP) as batch:
            parent = None
            if spec.table in _PARENTS:
                table, key, sk = _PARENTS[spec.table]
                parent = Parent(self.wh.read(table), key, sk)
            target = self.wh.read(spec.table)
            staged = _tracked(staged, spec)
            change = scd2_apply(target, staged, spec, effective or date.today(), parent, hash_null)
            self.wh.replace(spec.table, change.rows)
            batch.count(
                inserted=change.inserted.count(),
                updated=change.expired.count(),
                rejected=change.rejected.count(),
            )

    def scd2_store(self, staged: DataFrame, effective: date | None = None) -> None:
        self.scd2(STORE, staged, effective)

    def scd2_product(self, staged: DataFrame, effective: date | None = None) -> None:
        self.scd2(PRODUCT, staged, effective)

    def scd2_customer(self, staged: DataFrame, effective: date | None = None) -> None:
        self.scd2(CUSTOMER, staged, effective)

    def scd2_employee(self, staged: DataFrame, effective: date | None = None) -> None:
        self.scd2(EMPLOYEE, staged, effective)

    # Facts -----------------------------------------------------------------------

    def incremental_sales(
        self,
        staged: DataFrame,
        watermark_from: date | datetime | str | None = None,
        watermark_to: date | datetime | str | None = None,
    ) -> None:
        """Appends the staged sales of ``(from, to]``; from the last success if not given."""
        start = watermark_from if watermark_from is not None else self.log.watermark(SALES)
        end = watermark_to if watermark_to is not None else datetime.now()
        with self.log.batch("incremental_sales", SALES, "INCREMENTAL", POS, start, end) as batch:
            read = self.wh.read
            load = incremental_sales(
                staged, read("dim.store"), read("dim.product"), read("dim.customer"),
                read("dim.employee"), read("dim.campaign"),
                watermark_from=start, watermark_to=end,
                existing=read(SALES, _day(start), _day(end)), batch_id=batch.id, shared=True,
            )
            rejected = self.rejects.write(load.rejects, batch.id)
            written = self.wh.append(SALES, load.lines, finish=load.finish)["rows"]
            batch.count(inserted=written, rejected=rejected)

    def replay_rejects(self) -> None:
        """Loads the rejects whose store and product have become known; the others wait on, with their reason of today."""
        with self.log.batch("replay_rejects", SALES, "INCREMENTAL", DW) as batch:
            read = self.wh.read
            waiting = stored(self.rejects.waiting(), "waiting")
            months = waiting.agg(F.count("*").alias("n"), F.collect_set(month_key(date_key("transaction_datetime"))).alias("months")).first()
            load = incremental_sales(
                waiting.drop("reject_reason", "rejected_at", "etl_batch_id"),
                read("dim.store"), read("dim.product"), read("dim.customer"),
                read("dim.employee"), read("dim.campaign"),
                watermark_from=ALWAYS_AFTER, watermark_to=ALWAYS_BEFORE,
                existing=read(SALES).filter(F.col("year_month").isin(months["months"])), batch_id=batch.id, shared=True,
            )
            rejected = self.rejects.write(load.rejects, batch.id)
            written = self.wh.append(SALES, load.lines, finish=load.finish)["rows"]
            self.rejects.replayed(waiting.select("etl_batch_id").distinct(), batch.id)
            batch.count(extracted=months["n"], inserted=written, rejected=rejected)

    def bulk_sales(self, staged: DataFrame) -> None:
        """First fill of the sales fact, with the keys of today."""
        with self.log.batch("bulk_sales", SALES, "FULL_LOAD", POS) as batch:
            read = self.wh.read
            rows = bulk_load(
                staged, read("dim.store"), read("dim.product"), read("dim.customer"),
                read("dim.campaign"), existing=read(SALES), batch_id=batch.id,
            )
            batch.count(inserted=self.wh.append(SALES, rows)["rows"])

    def refresh_daily_kpi(
        self,
        date_from: date | None = None,
        date_to: date | None = None,
        targets: DataFrame | None = None,
    ) -> None:
        """Replaces the KPI rows of the window by a new aggregation of the sales."""
        start, end = date_from or date.today() - timedelta(days=7), date_to or date.today()
        with self.log.batch("refresh_daily_kpi", KPI, "TRUNCATE_INSERT", DW, start, end) as batch:
            rows = daily_store_kpi(
                self.wh.read(SALES, start, end), self.wh.read("dim.customer"), start, end,
                targets=targets, batch_id=batch.id,
            )
            batch.count(inserted=self.wh.replace_window(KPI, rows, start, end)["in_window"])

    def load_daily_kpi(self, rows: DataFrame) -> None:
        """First fill of the KPI fact from POS figures by store id, current stores only."""
        with self.log.batch("load_daily_kpi", KPI, "FULL_LOAD", POS) as batch:
            stores = self.wh.read("dim.store").filter("is_current").select("store_id", "store_sk")
            keyed = rows.join(stores, "store_id").withColumns(
                {
                    "kpi_sk": F.xxhash64("date_id", "store_sk"),
                    "etl_batch_id": F.lit(batch.id),
                    "etl_loaded_at": F.localtimestamp(),
                }
            )
            zero = ["return_amount", "units_returned", "return_transaction_count", "loyalty_customers"]
            filled = shaped(generated(keyed.withColumns({c: F.lit(0) for c in zero})), KPI)
            fresh = insert_skip_conflicts(self.wh.read(KPI), filled, ["date_id", "store_sk"], [])
            batch.count(inserted=self.wh.append(KPI, fresh)["rows"])

    def refresh_inventory(self, days: Sequence[date], opening: DataFrame | None = None) -> None:
        """Replaces the stock snapshots of the given days, starting from the last state that still holds.

        ``opening`` (store_id, product_id, quantity) is what was counted before the first
        sale. It is kept for later refreshes; giving it anew starts from the first sale.
        """
        first, last = min(days), max(days)
        with self.log.batch("refresh_inventory", INVENTORY, "TRUNCATE_INSERT", DW, first, last) as batch:
            counted = self.stock.opening(opening, batch.id)
            earlier = self.stock.before(first) if opening is None else None
            spans = [self.wh.read(SALES, low, high) for low, high in days_read(last, earlier.day if earlier else None)]
            stores, products = self.wh.read("dim.store"), self.wh.read("dim.product")
            states = stock_states(reduce(DataFrame.unionByName, spans), stores, products, days, opening=counted, earlier=earlier)
            states = self.stock.write(states, batch.id)
            rows = valued(states, stores, products, batch_id=batch.id)
            existing = self.wh.read(INVENTORY, first, last)
            ids = [d.year * 10000 + d.month * 100 + d.day for d in days]
            others = shaped(existing.filter(~F.col("date_id").isin(ids)), INVENTORY)
            mine = F.count_if(F.col("etl_batch_id") == batch.id)
            batch.count(inserted=self.wh.replace_window(INVENTORY, others.unionByName(rows), first, last, mine=mine)["mine"])

    def refresh_campaign_performance(self) -> None:
        """Recomputes every campaign x store row; rows no longer produced stay."""
        with self.log.batch("refresh_campaigns", PERFORMANCE, "TRUNCATE_INSERT", DW) as batch:
            campaigns = self.wh.read("dim.campaign")
            used = days_used(campaigns)
            first = FirstPurchases(self.log).upto(self.wh.read(SALES), batch.id)
            sales = self.wh.read(SALES, *used) if used else self.wh.read(SALES).limit(0)
            rows = cut(campaign_performance(sales, self.wh.read("dim.store"), campaigns, first=first))
            key = ["campaign_sk", "store_sk"]
            others = self.wh.read(PERFORMANCE).join(rows.select(*key), key, "left_anti")
            self.wh.replace(PERFORMANCE, others.unionByName(rows))
            batch.count(inserted=rows.count())

    # Orchestration ---------------------------------------------------------------

    def run_etl(self, staging: Mapping[str, DataFrame], run_date: date | None = None) -> None:
        """One nightly run: dimensions, yesterday's sales, the last three days' KPIs."""
        day = run_date or date.today()
        self.scd2_store(staging["stg_store"], day)
        self.scd2_product(staging["stg_product"], day)
        self.incremental_sales(staging["stg_sales_transaction"], day - timedelta(days=1), day)
        self.refresh_daily_kpi(day - timedelta(days=3), day - timedelta(days=1))

    def bootstrap(
        self, staging: Mapping[str, DataFrame], start: date, end: date, effective: date
    ) -> None:
        """Fills an empty warehouse in order of dependence, up to the bulk of sales.

        Staged stores, products and customers become first versions. Campaigns
        and employees are optional, and so are sales and KPIs.
        """
        self.create()
        self.load_dim_date(start, end)
        self.scd1("dim.region", staging["stg_region"], "region_id")
        categories = staging["stg_product_category"]
        self.scd1("dim.product_category", categories, "category_id")
        for spec, name in ((STORE, "stg_store"), (PRODUCT, "stg_product"), (CUSTOMER, "stg_customer"),
                           (EMPLOYEE, "stg_employee")):
            if name in staging:
                self.scd2(spec, staging[name], effective)
        if "stg_campaign" in staging:
            self.scd1("dim.campaign", staging["stg_campaign"], "campaign_id", {"is_active": F.lit(True)})
        if "stg_sales_transaction" in staging:
            self.bulk_sales(staging["stg_sales_transaction"])
        if "fact_daily_store_kpi" in staging:
            self.load_daily_kpi(staging["fact_daily_store_kpi"])

    def bootstrap_csv(self, folder: str, start: date = date(2020, 1, 1), end: date = date(2030, 12, 31),
                      effective: date = date(2020, 1, 1), campaigns: DataFrame | None = None) -> None:
        """``bootstrap`` from the seven CSV files of a folder, with the default campaigns if none are given."""
        names = ("stg_region", "stg_product_category", "stg_store", "stg_product", "stg_customer",
                 "stg_sales_transaction", "fact_daily_store_kpi")
        staging = {name: read_csv(self.spark, f"{folder}/{name}.csv", name) for name in names}
        if campaigns is None:
            campaigns = literal_rows(self.spark, DEFAULT_CAMPAIGNS, CAMPAIGN_COLUMNS)
        self.bootstrap(staging | {"stg_campaign": campaigns}, start, end, effective)


def _tracked(staged: DataFrame, spec: ScdSpec) -> DataFrame:
    """The staged frame with the tracked attributes its file lacks, as NULL."""
    missing = {c: F.lit(None).cast("string") for c in spec.tracked if c not in staged.columns}
    return staged.withColumns(missing) if missing else staged


def _day(moment: date | datetime | str) -> date:
    if isinstance(moment, datetime):
        return moment.date()
    return moment if isinstance(moment, date) else date.fromisoformat(str(moment)[:10])
