"""Guarded division, portable rounding and exact sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal text a metric may be written in; "1.5d", "0x10" or "inf" is no number.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else 0."""
    num, den = as_col(numerator).cast("double"), as_col(denominator).cast("double")
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def ratio_any_sign(numerator: Column, denominator: Column) -> Column:
    """Division that yields 0 for a null or zero denominator or a null numerator.

    Unlike :func:`ratio` a negative denominator divides normally.
    """
    num, den = as_col(numerator).cast("double"), as_col(denominator).cast("double")
    return F.coalesce(num / F.nullif(den, F.lit(0.0)), F.lit(0.0))


def rounded(sql: str, digits: int) -> str:
    """SQL text that rounds a double half up with IEEE arithmetic only.

    ``round`` on doubles differs between engines at half-way values. Beyond
    2**53 steps a double has no such digits and is returned as it is, which
    also keeps ``floor`` inside the bigint range.
    """
    step = f"1e{digits}D"
    return f"(CASE WHEN abs({sql}) < 9007199254740992D / {step} THEN floor({sql} * {step} + 0.5D) / {step} ELSE {sql} END)"


def round_half_up(value: Column | str, digits: int) -> Column:
    """:func:`rounded` for a Column."""
    v = as_col(value)
    step = float(10**digits)
    return F.when(F.abs(v) < F.lit(2.0**53 / step), F.floor(v * step + 0.5) / F.lit(step)).otherwise(v)


def round_columns(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.expr(rounded(f"`{n}`", digits)) for n in names})


def number_or_null(value: Column, data_type: T.DataType) -> Column:
    """Lenient cast to double: text that is not a finite decimal number is null."""
    if isinstance(data_type, T.StringType):
        return F.when(value.rlike(NUMBER_TEXT), value.try_cast("double"))
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def is_integral(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def exact_sum(df: DataFrame, name: str) -> Column:
    """Sum that does not depend on row order or task retries.

    Integer and decimal columns add up as such. A sum of doubles changes with the
    order in which tasks finish, so doubles are split into whole units, 1e-9 and
    1e-18 parts, each added up as bigint and put together as a decimal with 16
    digits after the point. Amounts of 1 or more are taken to 9 digits after the
    point, as what follows is noise of their representation; smaller ones to 18.
    Values that are not finite count as null. A value beyond the range of bigint
    raises an error, and so does a sum beyond it in ANSI mode (the default).
    """
    data_type = df.schema[name].dataType
    if is_integral(data_type):
        return F.expr(f"sum(cast(`{name}` AS bigint))")
    if isinstance(data_type, T.DecimalType):
        return F.expr(f"sum(`{name}`)")
    return F.expr(exact_sum_sql(f"`{name}`"))


def exact_sum_sql(x: str) -> str:
    """SQL text of :func:`exact_sum` for a double."""
    finite = f"CASE WHEN abs({x}) < double('Infinity') THEN {x} END"
    nano = f"(({finite}) - floor({finite})) * 1e9D"
    half = f"CASE WHEN abs({x}) >= 1D THEN 0.5D ELSE 0D END"
    # floor of a double stops at the end of bigint without a word
    whole_units = f"CASE WHEN abs({x}) >= 9223372036854775807D AND abs({x}) < double('Infinity') THEN cast(raise_error('a value beyond bigint cannot be summed') AS bigint) ELSE floor({finite}) END"
    units, nanos = f"sum({whole_units})", f"sum(cast(floor({nano} + {half}) AS bigint))"
    attos = f"sum(cast(CASE WHEN abs({x}) < 1D THEN floor(({nano} - floor({nano})) * 1e9D + 0.5D) ELSE 0 END AS bigint))"
    whole, billionths = f"cast({units} AS decimal(19,0))", f"cast({nanos} AS decimal(19,0)) * 0.000000001BD"
    rest = f"cast({attos} AS decimal(19,0)) * cast(0.000000000000000001BD AS decimal(18,18))"
    return f"cast({whole} + {billionths} + {rest} AS decimal(38,16))"


def total(df: DataFrame, name: str) -> Column:
    """:func:`exact_sum` with null and empty input as 0, typed bigint or double."""
    summed = F.coalesce(exact_sum(df, name), F.lit(0))
    return summed.cast("bigint" if is_integral(df.schema[name].dataType) else "double")


def round_total(df: DataFrame, name: str, digits: int) -> Column:
    """Exact sum rounded as a decimal, as a double."""
    return F.coalesce(F.round(exact_sum(df, name).cast("decimal(38,16)"), digits).cast("double"), F.lit(0.0))
