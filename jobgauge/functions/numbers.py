"""Numbers: column expressions and a filter."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgauge.schemas import WIDE

INFINITY = float("inf")


def finite_number(value: Column) -> Column:
    """Double from any column type; NULL for text that is not a number, for NaN and for infinities."""
    number = value.try_cast("double")
    return F.when(F.abs(number) < INFINITY, number)


def misfits(value: Column) -> Column:
    """How many values are not NULL and no finite number."""
    return F.count_if(value.isNotNull() & finite_number(value).isNull())


def decimal_number(value: Column) -> Column:
    """The number as a wide decimal; NULL where `finite_number` is, and for numbers that do not fit."""
    return finite_number(value).try_cast(WIDE)


def decimal_avg(value: Column) -> Column:
    """Average through a wide decimal, for streams that can aggregate only once; see `decimal_misfits`."""
    return F.try_sum(decimal_number(value)).cast("double") / F.nullif(F.count(decimal_number(value)), F.lit(0))


def decimal_misfits(value: Column) -> Column:
    """How many values are not NULL and take no part in `decimal_avg`."""
    return F.count_if(value.isNotNull() & decimal_number(value).isNull())


def filter_min_value(df: DataFrame, minimum: float, column: str = "value") -> DataFrame:
    """Rows above `minimum`; NULL, NaN, infinities and text that is not a number drop out.

    Plain comparisons with a numeric column reach the scan.
    """
    kind = dict(df.dtypes)[column]
    value = finite_number(F.col(column)) if kind == "string" else F.col(column)
    above = value > minimum
    return df.filter(above & (value < INFINITY) if kind in ("double", "float") else above)
