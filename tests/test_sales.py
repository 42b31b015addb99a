from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.frames import ALWAYS, ONE_PRODUCT, ONE_STORE, campaigns, customers, employees, products, staged, stores
from tezgah.operators.dedupe import insert_skip_conflicts, keep_first, keep_first_stored, repeated
from tezgah.plans.sales import bulk_load, incremental_sales

FROM, TO = "2024-01-14 00:00:00", "2024-01-16 00:00:00"


def load(spark, lines, store_rows=ONE_STORE, product_rows=ONE_PRODUCT, existing=None, window=(FROM, TO), shared=False):
    return incremental_sales(
        staged(spark, lines), stores(spark, store_rows), products(spark, product_rows),
        customers(spark, [5]), employees(spark), campaigns(spark),
        watermark_from=window[0], watermark_to=window[1], existing=existing, shared=shared,
    )


def test_window_is_open_below_and_closed_above(spark):
    moments = [datetime(2024, 1, 14), datetime(2024, 1, 14, 0, 0, 1), datetime(2024, 1, 16), datetime(2024, 1, 16, 0, 0, 1)]
    lines = [{"transaction_id": i, "transaction_datetime": at} for i, at in enumerate(moments)]
    assert sorted(r["transaction_id"] for r in load(spark, lines).rows.collect()) == [1, 2]


def test_versions_as_of_the_sale_and_keys_as_of_now(spark):
    versions = [(11, 1, ALWAYS, date(2024, 1, 14), False, 1), (12, 1, date(2024, 1, 15), None, True, 2)]
    lines = [
        {"transaction_id": 1, "transaction_datetime": datetime(2024, 1, 14, 9), "customer_id": 77, "employee_id": 8},
        {"transaction_id": 2, "transaction_datetime": datetime(2024, 1, 15, 9), "customer_id": 5, "campaign_id": 30},
        {"transaction_id": 3, "customer_id": None, "campaign_id": 99},
    ]
    rows = {r["transaction_id"]: r for r in load(spark, lines, versions).rows.collect()}
    assert [rows[i]["store_sk"] for i in (1, 2, 3)] == [11, 12, 12]
    assert [rows[i]["customer_sk"] for i in (1, 2, 3)] == [-1, 105, -1]
    assert [rows[i]["employee_sk"] for i in (1, 2, 3)] == [None, 507, 507]
    assert [rows[i]["campaign_sk"] for i in (1, 2, 3)] == [-1, 3, -1]
    assert rows[2]["net_sales_amount"] == D("8.00") and rows[2]["source_system"] == "POS"


def test_rejects_carry_their_reason(spark):
    lines = [
        {"transaction_id": 1, "store_id": 9}, {"transaction_id": 2, "product_id": 9},
        {"transaction_id": 3, "store_id": 9, "product_id": 9}, {"transaction_id": 4},
    ]
    got = load(spark, lines)
    assert {r["transaction_id"]: r["reject_reason"] for r in got.rejects.collect()} == {
        1: "no_store", 2: "no_product", 3: "both",
    }
    assert [r["transaction_id"] for r in got.rows.collect()] == [4]


def test_sales_of_a_store_from_before_its_first_version_are_rejected(spark):
    opened_today = [(11, 1, date(2024, 1, 16), None, True, 1)]
    got = load(spark, [{}], opened_today)
    assert got.rows.count() == 0 and got.rejects.count() == 1


def test_loading_a_window_again_adds_nothing(spark):
    lines = [{"transaction_id": i} for i in range(5)]
    first = load(spark, lines).rows
    assert load(spark, [*lines, {"transaction_id": 9}], existing=first).rows.select("transaction_id").collect() == [(9,)]


def test_one_copy_per_line_and_day(spark):
    lines = [
        {"product_id": 1, "quantity": D("3")}, {"product_id": 1, "quantity": D("2")},
        {"line_number": 2}, {"transaction_datetime": datetime(2024, 1, 14, 8)},
    ]
    rows = load(spark, lines).rows.select("line_number", "date_id", "quantity").collect()
    assert sorted(map(tuple, rows)) == [(1, 20240114, D("1.000")), (1, 20240115, D("2.000")), (2, 20240115, D("1.000"))]


def test_an_overlap_of_versions_does_not_double_the_fact(spark):
    overlapping = [(11, 1, ALWAYS, None, True, 1), (12, 1, date(2024, 1, 1), None, True, 2)]
    assert load(spark, [{}], overlapping).rows.count() == 1


def test_bulk_load_binds_to_current_versions(spark):
    versions = [(11, 1, ALWAYS, date(2024, 2, 1), False, 1), (12, 1, date(2024, 2, 2), None, True, 2)]
    rows = bulk_load(
        staged(spark, [{"customer_id": -1}, {"transaction_id": 2, "store_id": 9}]), stores(spark, versions),
        products(spark, ONE_PRODUCT), customers(spark, [5]), campaigns(spark),
    ).collect()
    assert [(r["store_sk"], r["customer_sk"], r["employee_sk"]) for r in rows] == [(12, -1, None)]


def test_skewed_copies_and_hot_keys_lose_nothing(spark):
    """A third of the lines copy one line, a third are anonymous, all are one store's."""
    n = 3000
    one = staged(spark, [{}])
    values = {f.name: F.lit(one.first()[f.name]).cast(f.dataType) for f in one.schema}
    copied, anonymous = F.col("id") % 3 == 0, F.col("id") % 3 == 1
    values["transaction_id"] = F.when(copied, 0).otherwise(F.col("id"))
    values["customer_id"] = F.when(anonymous, -1).otherwise(5).cast("bigint")
    lines = spark.range(n).select(*[value.alias(name) for name, value in values.items()])
    got = incremental_sales(
        lines, stores(spark, ONE_STORE), products(spark, ONE_PRODUCT), customers(spark, [5]), employees(spark),
        campaigns(spark), watermark_from=FROM, watermark_to=TO,
    ).rows.cache()
    assert got.count() == n - n // 3 + 1
    assert got.filter("customer_sk = -1").count() == n // 3
    assert got.filter("customer_sk = 105").count() == n // 3 + 1


def test_keep_first_is_the_minimum_over_all_columns(spark):
    rows = [(1, "b", None), (1, "a", 9), (1, "a", 3), (2, "z", 1)]
    frame = spark.createDataFrame(rows, "k int, o string, rest int")
    assert sorted(map(tuple, keep_first(frame, ["k"], ["o"]).collect())) == [(1, "a", 3), (2, "z", 1)]


@pytest.mark.parametrize("sent", [0, 5, 1000])
@pytest.mark.parametrize("share", [0, 3, 50, 100])
def test_counting_keys_first_keeps_the_same_rows(spark, tmp_path, sent, share):
    """Of 3,000 rows ``share`` % are copies of some key, a third of these of one key; keys may be NULL."""
    copied = F.col("id") % 100 < share
    key = F.when(copied & (F.col("id") % 3 == 0), 7).when(copied, F.col("id") % 211).otherwise(F.col("id") + 1000)
    rows = spark.range(3000).select(
        F.when(key % 97 != 5, key).alias("k"), (key % 2).alias("j"), F.xxhash64("id").alias("o"), F.col("id").cast("string").alias("rest")
    )
    rows.write.parquet(f"{tmp_path}/rows")
    read = spark.read.parquet(f"{tmp_path}/rows")
    got = keep_first_stored(read, ["k", "j"], ["o"], sent)
    assert got.columns == read.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, keep_first(read, ["k", "j"], ["o"]).collect()))


def test_keys_are_counted_by_a_narrow_hash_and_single_rows_pass_unshuffled(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 1990).alias("k"), F.col("id").alias("o"), F.lit("wide").alias("rest"))
    rows.write.parquet(f"{tmp_path}/rows")
    read = spark.read.parquet(f"{tmp_path}/rows")
    count = repeated(read, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in count and "SortAggregate" not in count and "rest" not in count
    got = keep_first_stored(read, ["k"], ["o"])
    assert got.count() == 1990
    whole = got._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in whole.splitlines() if " Exchange " in line]
    assert whole.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in whole
    assert len(exchanges) == 1 and "Exchange hashpartitioning(k" in exchanges[0]  # that of the copies


def test_a_shared_load_gives_the_rows_of_a_lazy_one(spark):
    lines = [{"transaction_id": i // 2, "quantity": D(str(1 + i % 3))} for i in range(40)] + [{"transaction_id": 99, "store_id": 9}]
    lazy, shared = load(spark, lines), load(spark, lines, shared=True)
    assert sorted(map(str, lazy.rows.drop("etl_loaded_at").collect())) == sorted(map(str, shared.rows.drop("etl_loaded_at").collect()))
    assert sorted(map(str, lazy.rejects.collect())) == sorted(map(str, shared.rejects.collect()))


@pytest.mark.parametrize("known, expected", [([], [1, 2]), ([(2, "x")], [1])])
def test_insert_skips_known_keys(spark, known, expected):
    target = spark.createDataFrame(known, "k int, v string")
    incoming = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert sorted(r["k"] for r in insert_skip_conflicts(target, incoming, ["k"], ["v"]).collect()) == expected
