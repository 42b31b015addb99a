import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tezgah.operators.ranking import Score, global_row_number, ntiles


def numbers(spark, n):
    """n rows with many ties and some NULLs."""
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 7 != 3, F.col("id") * 31 % 5).alias("tied"),
        (F.lit(0)).alias("same"),
        (F.col("id") * 7919 % 1009 / F.lit(4)).cast("decimal(12,2)").alias("spread"),
    )


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 1003])
def test_ntiles_equal_the_window_function(spark, n):
    frame = numbers(spark, n)
    scores = {
        "up": Score("tied"), "down": Score("tied", descending=True), "flat": Score("same"), "money": Score("spread"),
    }
    ranked = ntiles(frame, "k", scores, 5)
    expected = frame.select(
        "k",
        F.ntile(5).over(W.orderBy(F.asc_nulls_last("tied"), "k")).alias("up"),
        F.ntile(5).over(W.orderBy(F.desc_nulls_first("tied"), "k")).alias("down"),
        F.ntile(5).over(W.orderBy("same", "k")).alias("flat"),
        F.ntile(5).over(W.orderBy("spread", "k")).alias("money"),
    )
    assert sorted(ranked.select(*expected.columns).collect()) == sorted(expected.collect())


def test_row_numbers_are_dense(spark):
    frame = numbers(spark, 1003)
    rows = global_row_number(frame, ["k"], "n", start=10).orderBy("k").collect()
    assert [r["n"] for r in rows] == list(range(10, 1013))
