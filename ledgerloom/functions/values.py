"""Money, integer, text and time rules used when casting and comparing columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"

FLOATS = (T.DoubleType, T.FloatType)


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, FLOATS)


def money(df: DataFrame, name: str) -> Column:
    """Exact two-decimal money.

    Floating input is scaled before it is rounded (1.005 is stored slightly below 1.005 and
    becomes 1.00); text and decimal input is cast directly.
    """
    value = F.col(name)
    if not _is_float(df, name):
        return value.cast(MONEY)
    cents = F.round(value * F.lit(100.0)).cast("decimal(20,0)")
    return (cents * F.lit(Decimal("0.01"))).cast(MONEY)


def whole(df: DataFrame, name: str) -> Column:
    """BIGINT cast that rounds halves to even instead of truncating."""
    value = F.col(name)
    return (F.bround(value, 0) if _is_float(df, name) else value).cast("bigint")


def local_time(name: str) -> Column:
    """Zone-less timestamp."""
    return F.col(name).cast("timestamp_ntz")


def month_of(name: str) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(F.to_date(F.col(name)), "month")


def total(column: Column | str) -> Column:
    """Sum of money with room for every control total."""
    return F.sum(column).cast(TOTAL)


def count_of(condition: Column) -> Column:
    """Rows for which the condition is true."""
    return F.count_if(condition)


def differs(left: Column, right: Column) -> Column:
    """IS DISTINCT FROM."""
    return ~left.eqNullSafe(right)


def is_true(column: Column | str) -> Column:
    """IS TRUE: never NULL."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(False))


def rate(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """Ratio as a rounded double; NULL when the denominator is zero."""
    ratio = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.round(ratio, digits)


def require_exact_money(df: DataFrame, *names: str) -> DataFrame:
    """Reject floating-point money before it reaches an aggregate."""
    wrong = [n for n in names if not isinstance(df.schema[n].dataType, T.DecimalType)]
    if wrong:
        raise ValueError(f"Floating-point money is not accepted: {', '.join(wrong)}")
    return df
