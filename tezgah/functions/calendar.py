"""The calendar dimension as column expressions over a date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tezgah.functions.expressions import date_key

# Turkish names, Monday first and January first.
DAY_NAMES_TR = ("Pazartesi", "Salı", "Çarşamba", "Perşembe", "Cuma", "Cumartesi", "Pazar")
MONTH_NAMES_TR = (
    "Ocak", "Şubat", "Mart", "Nisan", "Mayıs", "Haziran",
    "Temmuz", "Ağustos", "Eylül", "Ekim", "Kasım", "Aralık",
)
# Season by calendar quarter of the month shifted by one (Dec-Feb first).
SEASONS_TR = ("Kış", "İlkbahar", "Yaz", "Sonbahar")
FISCAL_START_MONTH = 2
WEEKS_PER_MONTH = "4.33"


def _pick(names: tuple[str, ...], position: Column) -> Column:
    """``names[position]``, counted from 1, as a constant-array lookup."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def calendar_columns(day: str | Column) -> dict[str, Column]:
    """The calendar attributes of ``day``, keyed by column name in table order."""
    day = F.col(day) if isinstance(day, str) else day
    iso_day = F.weekday(day) + 1
    month = F.month(day)
    fiscal_month = F.pmod(month - FISCAL_START_MONTH, F.lit(12)) + 1
    fiscal_year = F.year(day) - F.when(month < FISCAL_START_MONTH, 1).otherwise(0)
    return {
        "date_id": date_key(day),
        "full_date": day,
        "day_of_week": iso_day,
        "day_name": F.date_format(day, "EEEE"),
        "day_name_tr": _pick(DAY_NAMES_TR, iso_day),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "week_start_date": F.trunc(day, "week"),
        "month_number": month,
        "month_name": F.date_format(day, "MMMM"),
        "month_name_tr": _pick(MONTH_NAMES_TR, month),
        "month_short": F.date_format(day, "MMM"),
        "quarter_number": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "year_number": F.year(day),
        "fiscal_week": F.ceil(fiscal_month * F.lit(WEEKS_PER_MONTH).cast("decimal(3,2)")).cast("int"),
        "fiscal_month": fiscal_month,
        "fiscal_quarter": F.ceil(fiscal_month / F.lit(3)).cast("int"),
        "fiscal_year": fiscal_year,
        "is_weekend": iso_day >= 6,
        "is_public_holiday": F.lit(False),
        "is_religious_day": F.lit(False),
        "holiday_name": F.lit(None).cast("string"),
        "day_type_id": F.when(iso_day == 7, 3).when(iso_day == 6, 2).otherwise(1),
        "season": _pick(SEASONS_TR, F.floor(F.pmod(month, F.lit(12)) / F.lit(3)).cast("int") + 1),
    }


def date_range(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included, as column ``day``."""
    span = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(span).alias("day"))


def dim_date(
    days: DataFrame, holidays: DataFrame | None = None, day: str = "day"
) -> DataFrame:
    """The calendar for a frame of days.

    ``holidays(full_date, holiday_name, is_public_holiday, is_religious_day)``
    is optional; without it no day is a holiday. Public holidays get day type
    4 and religious ones 5.
    """
    calendar = days.select(*[c.alias(n) for n, c in calendar_columns(day).items()])
    if holidays is None:
        return calendar
    marks = holidays.select(
        "full_date",
        F.col("holiday_name").alias("_name"),
        F.col("is_public_holiday").alias("_public"),
        F.col("is_religious_day").alias("_religious"),
    )
    marked = calendar.join(marks, "full_date", "left").withColumns(
        {
            "is_public_holiday": F.coalesce("_public", "is_public_holiday"),
            "is_religious_day": F.coalesce("_religious", "is_religious_day"),
            "holiday_name": F.col("_name"),
            "day_type_id": F.when(F.col("_religious"), 5)
            .when(F.col("_public"), 4)
            .otherwise(F.col("day_type_id")),
        }
    )
    return marked.select(*calendar.columns)
