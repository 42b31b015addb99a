from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.frames import ALWAYS, ONE_PRODUCT, products, stores
from tezgah.functions.calendar import date_range, dim_date
from tezgah.functions.literals import literal_rows
from tezgah.plans import marts
from tezgah.schemas import TABLES, shaped


@pytest.mark.parametrize(
    "scores, label",
    [
        ((5, 5, 5), "Şampiyon"), ((4, 4, 3), "Sadık Müşteri"), ((3, 3, 1), "Sadık Müşteri"), ((4, 2, 1), "Yeni Müşteri"),
        ((3, 2, 3), "Potansiyel Sadık"), ((3, 1, 2), "İzlemede"), ((2, 3, 1), "Risk Altında"), ((1, 5, 5), "Risk Altında"),
        ((1, 1, 5), "Kayıp Müşteri"), ((2, 1, 1), "İzlemede"), ((1, 2, 1), "İzlemede"),
    ],
)
def test_rfm_labels(spark, scores, label):
    r, f, m = map(F.lit, scores)
    assert spark.range(1).select(marts.rfm_segment(r, f, m)).first()[0] == label


def alert_frames(spark):
    places = shaped(spark.createDataFrame([(1, "X")], "region_sk bigint, city string"), "dim.region")
    kinds = shaped(spark.createDataFrame([(1, "D")], "category_sk bigint, department_name string"), "dim.product_category")
    calendar = dim_date(date_range(spark, date(2024, 1, 15), date(2024, 1, 15)))
    return calendar, stores(spark, [(11, 1, ALWAYS, None, True, 1), (12, 1, ALWAYS, None, False, 1)]), products(
        spark, ONE_PRODUCT), kinds, places


def test_stock_classes_in_order(spark):
    rows = [
        (11, D("0"), True, True, True, "🔴 Stok Tükendi"), (11, D("2.99"), False, True, False, "🟠 Kritik Stok"),
        (11, D("3"), False, False, True, "🟡 Düşük Stok"), (11, D("7"), False, True, True, "🔵 Fazla Stok"),
        (11, None, False, False, True, "⚫ Yavaş Hareket"), (11, None, False, False, False, None),
        (11, D("9"), False, False, False, None), (12, D("1"), True, False, False, None),
    ]
    inventory = literal_rows(
        spark, [(20240115, sk, 21, left, out, over, slow) for sk, left, out, over, slow, _ in rows],
        "date_id int, store_sk bigint, product_sk bigint, days_of_stock decimal(18,2), is_stockout boolean, "
        "is_overstock boolean, is_slow_mover boolean",
    )
    calendar, sites, goods, kinds, places = alert_frames(spark)
    stock = shaped(inventory, "fact.inventory_snapshot")
    got = marts.inventory_alert(stock, calendar, sites, goods, kinds, places)
    assert len(got.columns) == 20
    assert sorted(r["stok_durumu"] for r in got.collect()) == sorted(label for *_, label in rows if label)
    assert marts.inventory_alert(stock, calendar, sites, goods, kinds, places, history="as_was").count() == 6


def test_history_is_checked(spark):
    calendar, sites, goods, kinds, places = alert_frames(spark)
    with pytest.raises(ValueError, match="history"):
        marts.inventory_alert(shaped(spark.range(0), "fact.inventory_snapshot"), calendar, sites, goods, kinds, places,
                              history="never")


def test_monitor(spark):
    at = datetime(2024, 1, 1)
    rows = [(1, "SUCCESS", at.replace(second=1, microsecond=600000)), (2, "RUNNING", None), (3, "FAILED", at),
            (4, "PARTIAL", at.replace(second=2, microsecond=500000))]
    log = literal_rows(spark, [(i, s, at, e) for i, s, e in rows],
                       "batch_id bigint, status string, start_time timestamp_ntz, end_time timestamp_ntz")
    got = marts.etl_monitor(shaped(log, "staging.etl_batch_log"), "2024-01-01 00:01:00").collect()
    assert [(r["batch_id"], r["sure_saniye"], r["durum_icon"]) for r in got] == [
        (4, 3, "⚠️"), (3, 0, "❌"), (2, 60, "⏳"), (1, 2, "✅"),
    ]


def test_categories_with_equal_attributes_form_one_group(spark):
    kinds = literal_rows(
        spark, [(1, "D", None), (2, "D", None), (3, "E", None)],
        "category_sk bigint, department_code string, department_name string",
    )
    goods = products(spark, [(21, 1, ALWAYS, None, True, 1), (22, 2, ALWAYS, None, True, 1), (23, 3, ALWAYS, None, True, 1)])
    goods = goods.withColumn("category_sk", F.col("product_sk") - 20)
    sales = literal_rows(
        spark, [(1, 21, D("2.00")), (1, 22, D("3.00")), (2, 23, D("4.00"))],
        "transaction_id bigint, product_sk bigint, net_sales_amount decimal(14,2)",
    ).withColumns({"date_id": F.lit(20240115), "store_sk": F.lit(11), "transaction_type_id": F.lit(1)})
    calendar, sites, _, _, places = alert_frames(spark)
    got = marts.category_performance(
        shaped(sales, "fact.sales_transaction"), calendar, sites, goods, shaped(kinds, "dim.product_category"), places
    ).collect()
    assert sorted((r["department_code"], r["islem_sayisi"], r["urun_cesidi"], r["net_satis"]) for r in got) == [
        ("D", 1, 2, D("5.00")), ("E", 1, 1, D("4.00")),
    ]
    assert len(got[0].asDict()) == 23


def test_catalogue_of_tables():
    assert len(TABLES) == 20
    assert sum(len(t.unique) for t in TABLES.values()) == 7
