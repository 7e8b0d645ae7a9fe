"""Lenient and rounding conversions as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a lenient numeric parser takes: Spark's own cast would also take "1d" and "1f".
NUMERIC_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*\z"


def numeric_or_null(col: Column, dtype: T.DataType) -> Column:
    """Value as DOUBLE; anything that is not a number (NaN included) becomes NULL."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return col.cast("double")
    if isinstance(dtype, T.BooleanType):
        return col.cast("int").cast("double")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        wide = col.cast("double")
        return F.when(~F.isnan(wide), wide)
    if isinstance(dtype, T.StringType):
        return F.when(col.rlike(NUMERIC_TEXT), F.trim(col).try_cast("double"))
    return F.lit(None).cast("double")


def double_or(col: Column, dtype: T.DataType, default: float = 0.0) -> Column:
    return F.coalesce(numeric_or_null(col, dtype), F.lit(float(default)))


def int_or(col: Column, dtype: T.DataType, default: int = 0) -> Column:
    """Truncating BIGINT conversion with a default for what is not a finite number.

    Numbers beyond 64 bits become the nearest one.
    """
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return F.coalesce(col.cast("bigint"), F.lit(int(default)).cast("bigint"))
    value = numeric_or_null(col, dtype)
    whole = (
        F.when(value >= 2.0**63, F.lit(2**63 - 1))
        .when(value < -(2.0**63), F.lit(-(2**63)))
        .otherwise(value.try_cast("bigint"))
    )
    finite = F.when(F.abs(value) < float("inf"), whole)
    return F.coalesce(finite, F.lit(int(default)).cast("bigint"))


def bool_or(col: Column, dtype: T.DataType, default: bool = False) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(col, F.lit(default))
    return F.coalesce(F.lower(col.cast("string")).isin("true", "1", "yes"), F.lit(default))


def round_half_even(col: Column, to: str) -> Column:
    """DOUBLE to integer with ties to even; a plain cast would truncate."""
    return F.rint(col).cast(to)


def strict_int(col: Column, dtype: T.DataType) -> Column:
    """Integer cast that rejects bad text; fractional input rounds half to even."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return col.cast("int")
    return round_half_even(col.cast("double"), "int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient, 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator.cast("double")
    )


def two_decimals(col: Column) -> Column:
    """Text with two decimals, ties to even as in C's printf."""
    return F.format_number(col, 2)
