from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.frames import staged
from tezgah.functions.literals import literal_rows
from tezgah.plans.batches import FIRST_WATERMARK, latest_state
from tezgah.plans.jobs import Jobs
from tezgah.plans.kpi import KPI, daily_store_kpi, pos_daily_kpi
from tezgah.plans.publish import export, register_views, report_views
from tezgah.plans.sales import SALES
from tezgah.schemas import STAGING, shaped
from tezgah.sources.csv_files import read_csv, write_csv
from tezgah.sources.shared import scratch_path
from tezgah.sources.warehouse import Warehouse


@pytest.fixture
def jobs(spark):
    return Jobs(Warehouse(spark))


def staging(spark, lines):
    region = literal_rows(spark, [(1, "R", "Bölge", "X", "X1", None, None, "Europe/Istanbul", "Urban", None, None)],
                          STAGING["stg_region"])
    category = literal_rows(spark, [(1, "D", "Dept", "K", "Cat", "K-1", "Sub", True, False, D("1.00"))],
                            STAGING["stg_product_category"])
    store = literal_rows(
        spark, [(1, "STR-1", "Bir", "S1", "SUPER", 100, 72, 1, False, False, "A", 4, date(2010, 1, 1),
                 date(2020, 1, 1), None, True, 1)], STAGING["stg_store"])
    product = literal_rows(
        spark, [(1, "869", "Ürün", "Marka", 1, "ADET", D("10.00"), D("6.00"), "ACTIVE", False, False,
                 date(2020, 1, 1), None, True, 1)], STAGING["stg_product"])
    customer = literal_rows(
        spark, [(5, "Gold", "18-24", "M", "X", True, None, "High", date(2020, 1, 1), None, True, 1)],
        STAGING["stg_customer"])
    sales = staged(spark, lines)
    return {
        "stg_region": region, "stg_product_category": category, "stg_store": store, "stg_product": product,
        "stg_customer": customer, "stg_sales_transaction": sales, "fact_daily_store_kpi": pos_daily_kpi(sales),
    }


def test_bootstrap_from_csv(spark, jobs):
    folder = scratch_path(spark, "csv")
    lines = [{"transaction_id": 1}, {"transaction_id": 2, "store_id": 9}, {"transaction_id": 3, "customer_id": -1, "campaign_id": 3}]
    for name, frame in staging(spark, lines).items():
        write_csv(frame, f"{folder}/{name}.csv", name)
    jobs.bootstrap_csv(folder, date(2024, 1, 1), date(2024, 12, 31))
    sales = jobs.wh.read(SALES).collect()
    assert sorted((r["transaction_id"], r["store_sk"], r["customer_sk"]) for r in sales) == [(1, 1, 1), (3, 1, -1)]
    campaigns = {r["campaign_id"]: r["campaign_sk"] for r in jobs.wh.read("dim.campaign").collect()}
    assert set(campaigns) == {-1, 1, 2, 3, 4, 5}
    assert {r["transaction_id"]: r["campaign_sk"] for r in sales} == {1: -1, 3: campaigns[3]}
    assert jobs.wh.read("dim.date").count() == 366
    assert {r["customer_sk"] for r in jobs.wh.read("dim.customer").collect()} == {-1, 1}
    kpi = jobs.wh.read(KPI).collect()
    assert [(r["store_sk"], r["transaction_count"], r["unique_customers"]) for r in kpi] == [(1, 2, 2)]
    # loading all of it again adds nothing
    jobs.bootstrap_csv(folder, date(2024, 1, 1), date(2024, 12, 31))
    assert jobs.wh.read(SALES).count() == 2 and jobs.wh.read("dim.store").count() == 1
    loads = jobs.log.batches().filter("batch_name = 'load_dim_date'").orderBy("batch_id").collect()
    assert [r["rows_inserted"] for r in loads] == [366, 0]


def test_first_kpi_load_rounds_and_compares_with_the_target(spark, jobs):
    frames = staging(spark, [{"transaction_id": 1}])
    kpi = frames["fact_daily_store_kpi"].withColumns(
        {"net_sales": F.lit(D("108.00")), "sales_target": F.lit(D("216.00")), "units_sold": F.lit(D("2.500"))}
    )
    jobs.bootstrap(frames | {"fact_daily_store_kpi": kpi}, date(2024, 1, 1), date(2024, 12, 31), date(2020, 1, 1))
    row = jobs.wh.read(KPI).first()
    assert (row["units_sold"], row["sales_vs_target_pct"]) == (3, D("50.0000"))
    assert jobs.wh.read("dim.date").count() == 366 and jobs.wh.read(KPI).count() == 1
    log = jobs.log.batches()
    assert {r["status"] for r in log.select("status").distinct().collect()} == {"SUCCESS"}


def test_nightly_run(spark, jobs):
    lines = [
        {"transaction_id": 1, "transaction_datetime": datetime(2024, 1, 14, 12)},
        {"transaction_id": 2, "transaction_datetime": datetime(2024, 1, 15, 0)},
        {"transaction_id": 3, "transaction_datetime": datetime(2024, 1, 15, 12)},
    ]
    frames = staging(spark, lines)
    jobs.bootstrap({k: v for k, v in frames.items() if "sales" not in k and "kpi" not in k},
                   date(2024, 1, 1), date(2024, 12, 31), date(2020, 1, 1))
    moved = {**frames, "stg_store": frames["stg_store"].withColumn("cluster", F.lit("B"))}
    jobs.run_etl(moved, date(2024, 1, 15))
    assert sorted(r["transaction_id"] for r in jobs.wh.read(SALES).collect()) == [1, 2]
    bound = {r["transaction_id"]: r["store_sk"] for r in jobs.wh.read(SALES).collect()}
    assert bound[1] != bound[2]  # the new version starts on the run day
    assert [r["date_id"] for r in jobs.wh.read(KPI).collect()] == [20240114]
    jobs.incremental_sales(moved["stg_sales_transaction"], None, "2024-01-16 00:00:00")
    assert jobs.wh.read(SALES).count() == 3
    last = jobs.log.batches().orderBy(F.desc("batch_id")).first()
    assert (last["rows_inserted"], last["watermark_from"]) == (1, datetime(2024, 1, 15))
    # a window refresh equals a full recomputation
    jobs.refresh_daily_kpi(date(2024, 1, 14), date(2024, 1, 16))
    whole = daily_store_kpi(jobs.wh.read(SALES), jobs.wh.read("dim.customer"))
    columns = [c for c in whole.columns if not c.startswith("etl_")]
    assert sorted(jobs.wh.read(KPI).select(*columns).collect()) == sorted(whole.select(*columns).collect())
    jobs.refresh_inventory([date(2024, 1, 15), date(2024, 1, 16)], literal_rows(spark, [(1, 1, D("40.000")), (7, 7, D("1.000"))],
                           "store_id bigint, product_id bigint, quantity decimal(12,3)"))
    jobs.refresh_inventory([date(2024, 1, 16)])
    stock = {r["date_id"]: r["stock_qty"] for r in jobs.wh.read("fact.inventory_snapshot").collect()}
    assert stock == {20240115: D("37.000"), 20240116: D("37.000")}
    jobs.refresh_campaign_performance()
    assert jobs.wh.read("fact.campaign_performance").count() == 0
    views = report_views(jobs.wh, date(2024, 2, 1), "2024-02-01 00:00:00")
    register_views(views)
    folder = scratch_path(spark, "export")
    export(views, folder)
    widths = {"v_sales_daily": 52, "v_store_kpi_monthly": 30, "v_inventory_alert": 20, "v_category_performance": 23,
              "v_customer_rfm": 15, "v_etl_monitor": 17}
    for name, width in widths.items():
        frame = spark.read.parquet(f"{folder}/{name}")
        assert len(frame.columns) == width
        assert frame.count() == spark.sql(f"SELECT * FROM mart_{name}").count()
    # the reports follow the tables
    shown = "SELECT count(*) AS n FROM mart_v_sales_daily JOIN dim_store USING (store_id)"
    before = views.sql(shown).first()["n"]
    more = [{"transaction_id": 50 + i, "transaction_datetime": datetime(2024, 1, 16, 12)} for i in range(3)]
    jobs.incremental_sales(staged(spark, more), "2024-01-16", "2024-01-17")
    assert views.sql(shown).first()["n"] == before + 3 * 2  # the store has two versions
    # the sale bound to the closed store version is not shown
    assert views.sql("SELECT transaction_id FROM mart_v_sales_daily WHERE transaction_id < 50 ORDER BY 1").collect() == [(2,), (3,)]


def test_publishing_runs_no_job(spark, jobs):
    broken = Jobs(Warehouse(spark))
    broken.wh.read = None  # publishing reads nothing
    reports = report_views(broken.wh, date(2024, 2, 1), "2024-02-01 00:00:00")
    assert len(reports) == 6 and set(reports) >= {"v_customer_rfm"}
    with pytest.raises(KeyError):
        report_views(jobs.wh, date(2024, 2, 1), "2024-02-01 00:00:00")["v_none"]


def test_a_failure_is_logged_and_raised(spark, jobs):
    with pytest.raises(RuntimeError, match="till on fire"):
        with jobs.log.batch("load", SALES, "INCREMENTAL", "POS"):
            raise RuntimeError("till on fire")
    rows = jobs.log.batches().collect()
    assert [(r["status"], r["error_message"]) for r in rows] == [("FAILED", "till on fire")]
    assert jobs.log.watermark(SALES) == FIRST_WATERMARK


def test_watermark_is_that_of_the_last_success(spark, jobs):
    for upto, fails in (("2024-01-02", False), ("2024-01-05", True), ("2024-01-03", False)):
        try:
            with jobs.log.batch("load", SALES, "INCREMENTAL", "POS", None, upto) as batch:
                batch.count(inserted=3)
                if fails:
                    raise RuntimeError
        except RuntimeError:
            pass
    assert jobs.log.watermark(SALES) == "2024-01-03 00:00:00"
    assert jobs.log.watermark("dim.store") == FIRST_WATERMARK
    assert [r["rows_inserted"] for r in jobs.log.batches().orderBy("batch_id").collect()] == [3, 0, 3]  # a failure logs no counts


def test_latest_state_keeps_null_columns(spark):
    steps = literal_rows(spark, [(1, 1, "RUNNING", None), (2, 1, "SUCCESS", None), (1, 2, "RUNNING", "x")],
                         "step int, batch_id bigint, status string, error_message string")
    full = shaped(steps, "staging.etl_batch_log").limit(0).withColumn("step", F.lit(1))
    filled = full.unionByName(steps, allowMissingColumns=True)
    got = {r["batch_id"]: (r["status"], r["error_message"]) for r in latest_state(filled).collect()}
    assert got == {1: ("SUCCESS", None), 2: ("RUNNING", "x")}


def test_csv_empty_fields_are_null(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame(
        [("5,Gold,,M,X,true,,High,2020-01-01,,true,1",)],
        "value string",
    ).unionByName(spark.createDataFrame([], "value string")).coalesce(1).write.text(path)
    frame = spark.read.schema(STAGING["stg_customer"]).option("nullValue", "").csv(path)
    row = frame.first()
    assert row["age_band"] is None and row["loyalty_tier"] is None and row["scd_end_date"] is None
    written = scratch_path(spark, "csv")
    write_csv(frame, written, "stg_customer")
    assert read_csv(spark, written, "stg_customer").collect() == [row]
