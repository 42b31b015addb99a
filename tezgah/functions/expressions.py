"""Column expressions shared by the jobs. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = -1  # surrogate and business key of the "unknown" dimension member
MONEY = "decimal(16,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d: str | Column) -> Column:
    """YYYYMMDD as an integer, by arithmetic (no string formatting per row)."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(date_id: str | Column) -> Column:
    """YYYYMM of a YYYYMMDD key: the partition column of the facts."""
    return F.floor(col(date_id) / F.lit(100)).cast("int")


def half_up_int(c: str | Column) -> Column:
    """Numeric to integer, halves away from zero (a plain cast truncates)."""
    return F.round(col(c), 0).cast("int")


def guarded_ratio(
    num: str | Column,
    den: str | Column,
    per: int = 1,
    otherwise: float | None = None,
    guard: str = "positive",
) -> Column:
    """``num / den * per`` as DOUBLE where the divisor is usable.

    ``guard='positive'`` asks for ``den > 0`` (the report and KPI rule);
    ``guard='nonzero'`` only for ``den <> 0`` (the data-frame rule, where a
    zero divisor becomes missing). Under ANSI mode the guard also is what
    keeps the division from raising.
    """
    num, den = col(num), col(den)
    usable = den > 0 if guard == "positive" else den != 0
    value = num.cast("double") / den.cast("double")
    if per != 1:
        value = value * F.lit(float(per))
    return F.when(usable, value).otherwise(F.lit(otherwise).cast("double"))


def stored_ratio(
    num: Column, den: Column, dtype: str, per: int = 1, otherwise: int | None = 0
) -> Column:
    """The ratio in exact decimals, rounded half-up once to a stored type.

    Both sides are narrowed first (quantities have 3 decimals, amounts 2):
    from there Spark keeps 18 or more fractional digits in the quotient, so
    the rounding to 2 or 4 digits is that of the exact quotient.
    """
    num = num.cast("decimal(17,3)")
    den = den.cast(MONEY)
    if per != 1:
        num = num * F.lit(per)
    return F.when(den > 0, num / den).otherwise(F.lit(otherwise)).cast(dtype)


def minor_units(c: str | Column, digits: int = 2) -> Column:
    """An amount of a DECIMAL(14,2) or finer column as whole minor units (BIGINT).

    Sums of BIGINT run several times faster than those of wide decimals and
    are as exact; a sum beyond 63 bits raises.
    """
    return (col(c) * F.lit(10**digits)).cast("bigint")


def major_units(c: str | Column, digits: int = 2) -> Column:
    """Whole minor units back as DECIMAL with ``digits`` decimals."""
    return col(c).cast("decimal(19,0)") * F.lit(f"1e-{digits}").cast(f"decimal({digits + 1},{digits})")


def exact_sum(c: str | Column, digits: int = 2) -> Column:
    """SUM of a decimal with at most ``digits`` decimals, taken in minor units."""
    return major_units(F.sum(minor_units(c, digits)), digits)


def finite_or_null(df: DataFrame) -> DataFrame:
    """NaN and both infinities become NULL in every floating-point column."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    inf = float("inf")
    return df.withColumns(
        {c: F.when(~F.isnan(c) & ~F.col(c).isin(inf, -inf), F.col(c)) for c in floats}
    )


def attribute_hash(columns: Iterable[str | Column]) -> Column:
    """MD5 over the ``|``-joined text of the tracked attributes, NULLs skipped."""
    return F.md5(F.concat_ws("|", *[col(c).cast("string") for c in columns]))


def sales_measures(df: DataFrame) -> DataFrame:
    """Adds the generated columns of the sales fact, with its column defaults."""
    amount = "decimal(14,2)"
    df = df.withColumns(
        {
            "discount_amount": F.coalesce("discount_amount", F.lit(0)).cast(amount),
            "customer_sk": F.coalesce("customer_sk", F.lit(UNKNOWN).cast("bigint")),
            "campaign_sk": F.coalesce("campaign_sk", F.lit(UNKNOWN).cast("bigint")),
        }
    )
    quantity = F.col("quantity")
    selling = quantity * F.col("unit_selling_price")
    cost = quantity * F.col("unit_cost")
    return df.withColumns(
        {
            "gross_sales_amount": (quantity * F.col("unit_list_price")).cast(amount),
            "net_sales_amount": (selling - F.col("discount_amount")).cast(amount),
            "cogs_amount": cost.cast(amount),
            "gross_margin_amount": (selling - cost).cast(amount),
        }
    )


def ntz(moment: date | datetime | str) -> Column:
    """A timestamp literal without zone, so that filters on it reach the scan."""
    return F.lit(str(moment)).cast("timestamp_ntz")
