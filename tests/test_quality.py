from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.frames import ALWAYS, stores
from tezgah.dictionaries import dictionary
from tezgah.functions.literals import literal_rows
from tezgah.operators import quality
from tezgah.schemas import shaped
from tezgah.sources.shared import scratch_path


def found(frame):
    return {(r["table_name"], r["rule"]): r["violations"] for r in frame.collect() if r["violations"]}


def parents(spark):
    """The tables that stores and KPIs refer to, with the rows they need."""
    days = shaped(literal_rows(spark, [(20240101,), (20240102,)], "date_id int"), "dim.date")
    return {
        "dim.date": days, "dim.region": shaped(literal_rows(spark, [(1, 1)], "region_sk bigint, region_id bigint"), "dim.region"),
        "dict.d_day_type": dictionary(spark, "d_day_type"), "dict.d_store_format": dictionary(spark, "d_store_format"),
    }


def test_keys_of_several_columns_and_nulls_are_told_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "x"), (None, "x"), ("-", "x"), ("1:a", "b"), ("1:a", "b"), ("1:a", "b")]
    frame = literal_rows(spark, rows, "p string, q string")
    counts = sorted(r["count"] for r in frame.groupBy(quality._value(["p", "q"])).count().collect())
    assert counts == [1, 1, 1, 2, 3]


def test_all_references_of_a_table_come_from_one_scan(spark):
    kpi = shaped(literal_rows(spark, [(1, 20240101, 11)], "kpi_sk bigint, date_id int, store_sk bigint"), "fact.daily_store_kpi")
    path = scratch_path(spark, "kpi")
    kpi.write.parquet(path)
    sites = stores(spark, [(11, 1, ALWAYS, None, True, 1)])
    frames = parents(spark) | {"dim.store": sites, "fact.daily_store_kpi": spark.read.schema(kpi.schema).parquet(path)}
    for job in (quality.orphans, quality.duplicate_keys):
        text = job(frames)._jdf.queryExecution().executedPlan().toString()
        assert sum("FileScan" in line for line in text.splitlines()) == 1


def test_duplicates_and_orphans(spark):
    sites = stores(spark, [(11, 1, ALWAYS, None, True, 1), (11, 2, ALWAYS, None, True, 1), (11, 3, ALWAYS, None, True, 1)])
    kpi = literal_rows(spark, [(1, 20240101, 11), (2, 20240101, 11), (3, 20240102, 99), (4, 20240102, 98)],
                       "kpi_sk bigint, date_id int, store_sk bigint")
    frames = {"dim.store": sites, "fact.daily_store_kpi": shaped(kpi, "fact.daily_store_kpi")}
    with pytest.raises(ValueError, match="dict.d_store_format, dim.region"):
        quality.orphans(frames)
    frames |= parents(spark)
    assert found(quality.duplicate_keys(frames)) == {
        ("dim.store", "store_sk"): 2, ("fact.daily_store_kpi", "date_id,store_sk"): 1,
    }
    assert found(quality.orphans(frames)) == {("fact.daily_store_kpi", "store_sk->dim.store"): 2}


def test_nulls_domains_widths(spark):
    people = literal_rows(spark, [(1, "M", "x" * 16), (None, "X", "18-24"), (3, None, None)],
                          "customer_id bigint, gender string, age_band string")
    frames = {"dim.customer": shaped(people, "dim.customer").withColumn("is_current", F.lit(True))}
    nulls = found(quality.not_null(frames))
    assert nulls[("dim.customer", "customer_id")] == 1 and ("dim.customer", "is_current") not in nulls
    assert found(quality.domain(frames)) == {("dim.customer", "gender"): 1}
    assert found(quality.width(frames)) == {("dim.customer", "age_band"): 1}


def test_status_too_wide_for_its_column(spark):
    goods = shaped(literal_rows(spark, [("DISCONTINUED",), ("ACTIVE",)], "status_code string"), "dim.product")
    assert found(quality.width({"dim.product": goods})) == {("dim.product", "status_code"): 1}


def test_versions(spark):
    sites = stores(spark, [
        (1, 1, ALWAYS, date(2024, 1, 31), False, 1), (2, 1, date(2024, 2, 1), None, True, 2),  # sound
        (3, 2, ALWAYS, date(2024, 2, 1), False, 1), (4, 2, date(2024, 2, 1), None, True, 2),  # overlap
        (5, 3, ALWAYS, None, True, 1), (6, 3, date(2024, 2, 1), None, True, 3),  # gap, two current
    ])
    assert found(quality.scd2({"dim.store": sites})) == {
        ("dim.store", "one_current"): 1, ("dim.store", "version_gaps"): 1, ("dim.store", "overlap"): 1,
    }
