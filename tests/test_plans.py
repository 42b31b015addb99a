"""What the optimizer makes of the jobs: pruning, pushdown and exchanges."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tezgah.operators.lookups import _spread, point_in_time
from tezgah.plans.kpi import KPI, daily_store_kpi
from tezgah.plans.marts import category_performance, customer_rfm, sales_daily, store_kpi_monthly
from tezgah.plans.publish import report_views
from tezgah.plans.sales import SALES
from tezgah.queries import QUERIES
from tezgah.sources.demo_model import AS_OF, DemoModel
from tezgah.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model(spark):
    return DemoModel(spark, FOLDER)


@pytest.fixture(scope="module")
def warehouse(spark, model):
    wh = Warehouse(spark)
    wh.append(SALES, model.sales)
    return wh


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan(frame)


def test_rfm_never_gathers_all_rows_in_one_task(model, warehouse):
    text = final_plan(customer_rfm(warehouse.read(SALES), model.customer, AS_OF))
    assert "SinglePartition" not in text and "Window" not in text


def test_kpi_window_reads_its_months_and_columns(model, warehouse):
    window = warehouse.read(SALES, date(1998, 6, 15), date(1998, 7, 10))
    assert {path.split("year_month=")[1][:6] for path in window.inputFiles()} == {"199806", "199807"}
    text = plan(daily_store_kpi(window, model.customer))
    assert "PushedFilters" in text and "GreaterThanOrEqual(date_id,19980615)" in text
    assert "unit_list_price" not in text.split("ReadSchema")[1].split("\n")[0]


def test_category_report_shuffles_keys_and_not_text(model, warehouse):
    report = category_performance(
        warehouse.read(SALES), model.calendar, model.store, model.product, model.category, model.region
    )
    text = plan(report)
    grouped = [line for line in text.splitlines() if "Aggregate" in line and "_receipt" in line and "keys=" in line]
    assert grouped and all("department_name" not in line.split("functions=")[0] for line in grouped)


def test_unknown_customers_are_spread_in_a_shuffled_join(spark, model):
    """With broadcasts off, no partition of the customer join holds the anonymous third."""
    lines = spark.range(30000).select(
        F.col("id").alias("transaction_id"), F.lit(1).alias("line_number"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("customer_id"),
    )
    placed = lines.withColumn("k", _spread("customer_id", ("transaction_id", "line_number"))).repartition(8, "k")
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 30000 / 8 * 1.5


def test_staged_filters_reach_the_scan(model):
    text = plan(model.sales)
    assert "GreaterThan(l_shipdate,1990-01-01" in text and "l_linestatus" not in text


SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


def test_results_hold_with_shuffled_joins_and_skew_splitting(spark):
    """The joins a large cluster would run: nothing broadcast by size, hot partitions split."""
    from tezgah.queries import QUERIES

    names = ("etl_incremental_sales", "mart_sales_daily")
    usual = {name: sorted(map(str, QUERIES[name](spark, FOLDER).collect())) for name in names}
    before = {key: spark.conf.get(key, None) for key in SHUFFLED}
    try:
        for key, value in SHUFFLED.items():
            spark.conf.set(key, value)
        for name in names:
            frame = QUERIES[name](spark, FOLDER)
            assert sorted(map(str, frame.collect())) == usual[name]
            text = plan(frame)
            assert "SortMergeJoin" in text and "CartesianProduct" not in text
    finally:
        _restore(spark, before)


def _restore(spark, settings):
    for key, value in settings.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_store_is_split_in_the_version_join(spark):
    """A third of the lines are one store's: adaptive execution splits its partition."""
    lines = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("line"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("store_id"),
        F.lit(date(2024, 1, 15)).alias("day"),
        F.repeat(F.lit("x"), 50).alias("payload"),
    )
    versions = spark.range(1000).select(
        F.col("id").alias("store_id"), (F.col("id") + 5000).alias("store_sk"),
        F.lit(date(2020, 1, 1)).alias("scd_start_date"), F.lit(None).cast("date").alias("scd_end_date"),
    )
    before = {key: spark.conf.get(key, None) for key in SHUFFLED}
    try:
        for key, value in SHUFFLED.items():
            spark.conf.set(key, value)
        joined = point_in_time(lines, versions, "store_id", F.col("day"), {"store_sk": "store_sk"})
        rows = joined.collect()
        assert len(rows) == 60000 and all(r["store_sk"] == r["store_id"] + 5000 for r in rows)
        assert "skew=true" in plan(joined)
    finally:
        _restore(spark, before)


def _garble(wh, table, but):
    """Makes every file of the table unreadable but those of one month."""
    for path in {p for p in wh.read(table).inputFiles() if f"year_month={but}" not in p}:
        with open(path.removeprefix("file://"), "wb") as file:
            file.write(b"not a Parquet file")


def test_a_month_filter_on_reports_opens_that_month_only(spark, model):
    wh = Warehouse(spark)
    wh.append(SALES, model.sales)
    wh.replace("dim.date", model.calendar)
    days = wh.read("dim.date")
    rest = (model.store, model.product, model.category)
    daily = sales_daily(wh.read(SALES), days, *rest, model.customer, model.campaign, model.region).filter("yil = 1998 AND month_number = 7")
    category = category_performance(wh.read(SALES), days, *rest, model.region).filter("year_number = 1998 AND month_number = 7")
    one_day = sales_daily(wh.read(SALES), days, *rest, model.customer, model.campaign, model.region).filter("full_date = DATE '1998-07-15'")
    expected = [sorted(map(str, frame.collect())) for frame in (daily, category, one_day)]
    assert all(expected)
    for frame in (daily, category, one_day):
        assert "dynamicpruning" in plan(frame)
    _garble(wh, SALES, 199807)
    with pytest.raises(Exception, match="Checksum|not a Parquet file"):
        wh.read(SALES).agg(F.sum("quantity")).collect()
    again = [sorted(map(str, frame.filter("1 = 1").collect())) for frame in (daily, category, one_day)]
    assert again == expected


def test_the_monthly_report_prunes_months(spark, model):
    wh = Warehouse(spark)
    wh.append(KPI, daily_store_kpi(model.stored_sales, model.customer))
    wh.replace("dim.date", model.calendar)
    report = store_kpi_monthly(wh.read(KPI), wh.read("dim.date"), model.store, model.region).filter("yil = 1998 AND month_number = 7")
    expected = sorted(map(str, report.collect()))
    _garble(wh, KPI, 199807)
    assert expected and sorted(map(str, report.filter("1 = 1").collect())) == expected


def test_the_category_report_scans_the_lines_once(model):
    text = plan(category_performance(model.sales, model.calendar, model.store, model.product, model.category, model.region))
    assert sum("lineitem.parquet" in line for line in text.splitlines()) == 1


def test_a_published_report_sends_its_few_stores(spark, model):
    wh = Warehouse(spark)
    wh.append(SALES, model.sales)
    tables = {"date": model.calendar, "store": model.store, "product": model.product, "product_category": model.category, "customer": model.customer, "campaign": model.campaign, "region": model.region}
    for name, frame in tables.items():
        wh.replace(f"dim.{name}", frame)
    key, default = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "1")
    try:
        text = plan(report_views(wh, AS_OF, "2002-01-01 00:00:00")["v_sales_daily"])
    finally:
        spark.conf.set(key, default)
    joins = [line for line in text.splitlines() if "Join [store_sk" in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)


def test_the_published_query_loads_without_a_written_fact(spark, monkeypatch):
    monkeypatch.setattr(DemoModel, "stored_sales", property(lambda m: pytest.fail("the fact is written before it is loaded")))
    assert QUERIES["mart_published"](spark, FOLDER).count()
