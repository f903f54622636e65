"""Exact money arithmetic.

Sums of doubles depend on row order, and so would everything rounded from
them. Money therefore stays decimal, and means are rounded from whole cents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.scalars import integer_quotient
from granary.schemas import MONEY, MONEY_SUM

_WHOLE = T.DecimalType(38, 0)


def rounded_quotient(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to two digits, half away from zero, in one rounding.

    Decimal division keeps only a few digits and would round twice. Whole
    cents avoid that. NULL for a zero denominator.
    """
    cents = (numerator.cast(MONEY_SUM) * 100).cast(_WHOLE)
    count = denominator.cast("bigint")
    doubled = (F.abs(cents) * 2 + count).cast(_WHOLE)
    whole = integer_quotient(doubled, (count * 2).cast(_WHOLE))
    signed = F.when(cents < 0, -whole).otherwise(whole)
    value = (signed.cast(T.DecimalType(20, 0)) / F.lit(100)).cast(MONEY)
    return F.when(denominator != 0, value)


def is_exact(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DecimalType, T.IntegralType))


def rounded_total(total: Column) -> Column:
    return F.round(total, 2)


def rounded_mean(total: Column, count: Column, exact: bool) -> Column:
    """Mean of a column from its sum and its count of non-NULL values."""
    if exact:
        return rounded_quotient(total, count)
    return F.when(count != 0, F.round(total / count, 2))


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for readers that have no decimal type."""
    decimals = {
        f.name: F.col(f.name).cast("double")
        for f in df.schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    return df.withColumns(decimals) if decimals else df
