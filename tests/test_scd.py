from datetime import date

import pytest
from pyspark.sql import functions as F

from tezgah.functions.expressions import attribute_hash
from tezgah.operators.scd import STORE, Parent, scd1_upsert, scd2_apply
from tezgah.schemas import shaped

FIRST, SECOND = date(2020, 1, 1), date(2024, 3, 1)


def staged(spark, rows):
    """rows: (store_id, cluster, region_id, address)"""
    frame = spark.createDataFrame(rows, "store_id bigint, cluster string, region_id bigint, address string")
    return frame.withColumns(
        {
            "store_code": F.lit("S"), "store_name": F.lit("N"), "format_code": F.lit("SUPER"),
            "store_sqm": F.lit(100), "selling_sqm": F.lit(70), "headcount": F.lit(4), "is_franchise": F.lit(False),
        }
    )


@pytest.fixture
def parent(spark):
    return Parent(spark.createDataFrame([(1, 10), (2, 20)], "region_id bigint, region_sk bigint"), "region_id", "region_sk")


@pytest.fixture
def empty(spark):
    return shaped(spark.range(0), "dim.store")


def rows(frame):
    picked = frame.select("store_id", "scd_version", "cluster", "scd_start_date", "scd_end_date", "is_current", "region_sk")
    return sorted(tuple(r) for r in picked.collect())


def test_life_of_a_store(spark, empty, parent):
    first = scd2_apply(empty, staged(spark, [(1, "A", 1, "x"), (2, "B", 2, "y")]), STORE, FIRST, parent)
    assert rows(first.rows) == [
        (1, 1, "A", FIRST, None, True, 10), (2, 1, "B", FIRST, None, True, 20),
    ]
    # 1 changes, 2 is missing from the delivery and stays open, 3 is new
    second = scd2_apply(first.rows, staged(spark, [(1, "C", 2, "x"), (3, "D", 1, "z")]), STORE, SECOND, parent)
    assert rows(second.rows) == [
        (1, 1, "A", FIRST, date(2024, 2, 29), False, 10), (1, 2, "C", SECOND, None, True, 20),
        (2, 1, "B", FIRST, None, True, 20), (3, 1, "D", SECOND, None, True, 10),
    ]
    assert (second.inserted.count(), second.expired.count(), second.rejected.count()) == (2, 1, 0)
    keys = [r["store_sk"] for r in second.rows.collect()]
    assert len(set(keys)) == len(keys)


def test_the_same_delivery_twice_changes_nothing(spark, empty, parent):
    delivery = staged(spark, [(1, "A", 1, "x")])
    first = scd2_apply(empty, delivery, STORE, FIRST, parent)
    again = scd2_apply(first.rows, delivery, STORE, SECOND, parent)
    assert rows(again.rows) == rows(first.rows)
    assert again.inserted.count() == 0


def test_untracked_attributes_never_update(spark, empty, parent):
    first = scd2_apply(empty, staged(spark, [(1, "A", 1, "old")]), STORE, FIRST, parent)
    moved = scd2_apply(first.rows, staged(spark, [(1, "A", 1, "new")]), STORE, SECOND, parent)
    assert [r["address"] for r in moved.rows.collect()] == ["old"]


def test_unknown_parent_closes_the_old_version_and_rejects(spark, empty, parent):
    first = scd2_apply(empty, staged(spark, [(1, "A", 1, "x")]), STORE, FIRST, parent)
    lost = scd2_apply(first.rows, staged(spark, [(1, "A", 99, "x")]), STORE, SECOND, parent)
    assert rows(lost.rows) == [(1, 1, "A", FIRST, date(2024, 2, 29), False, 10)]
    assert (lost.inserted.count(), lost.rejected.count()) == (0, 1)


def test_version_without_hash(spark, empty, parent):
    first = scd2_apply(empty, staged(spark, [(1, "A", 1, "x")]), STORE, FIRST, parent)
    blank = first.rows.withColumn("scd_hash", F.lit(None).cast("string"))
    delivery = staged(spark, [(1, "Z", 1, "x")])
    assert scd2_apply(blank, delivery, STORE, SECOND, parent).inserted.count() == 0
    assert scd2_apply(blank, delivery, STORE, SECOND, parent, hash_null="changed").inserted.count() == 1


def test_two_changes_on_one_day_leave_an_empty_span(spark, empty, parent):
    one = scd2_apply(empty, staged(spark, [(1, "A", 1, "x")]), STORE, FIRST, parent)
    two = scd2_apply(one.rows, staged(spark, [(1, "B", 1, "x")]), STORE, SECOND, parent)
    three = scd2_apply(two.rows, staged(spark, [(1, "C", 1, "x")]), STORE, SECOND, parent)
    assert (1, 2, "B", SECOND, date(2024, 2, 29), False, 10) in rows(three.rows)
    assert (1, 3, "C", SECOND, None, True, 10) in rows(three.rows)


def test_repeated_keys_raise(spark, empty, parent):
    with pytest.raises(ValueError, match="store_id"):
        scd2_apply(empty, staged(spark, [(1, "A", 1, "x"), (1, "B", 1, "x")]), STORE, FIRST, parent)


def test_hash_is_over_the_nine_attributes(spark):
    row = staged(spark, [(1, "A", 1, "x")]).select(
        attribute_hash(STORE.tracked).alias("h"), F.md5(F.lit("S|N|SUPER|100|70|1|A|4|false")).alias("e")
    ).first()
    assert row["h"] == row["e"]


def test_upsert_overwrites_and_keeps(spark):
    target = shaped(
        spark.createDataFrame(
            [(1, 1, "old", "kept"), (2, 2, "other", "kept")],
            "region_sk bigint, region_id bigint, region_name string, district string",
        ),
        "dim.region",
    )
    delivery = spark.createDataFrame([(1, "new"), (9, "fresh")], "region_id bigint, region_name string")
    after = scd1_upsert(target, delivery, "region_id", "region_sk", {"timezone": F.lit("Europe/Istanbul")})
    got = sorted(tuple(r) for r in after.select("region_sk", "region_id", "region_name", "district", "timezone").collect())
    assert got == [
        (1, 1, "new", "kept", None), (2, 2, "other", "kept", None), (3, 9, "fresh", None, "Europe/Istanbul"),
    ]
