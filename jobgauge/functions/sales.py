"""Column expressions of the sales tables."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Timestamp from text; NULL where the text does not fit the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def tax_rate(region: Column, rates: Mapping[str, float], default: float) -> Column:
    """The rate of a region; the default for other regions and for NULL."""
    rate = F.lit(None).cast("double")
    for name, value in rates.items():
        rate = F.when(region == name, F.lit(value)).otherwise(rate)
    return F.coalesce(rate, F.lit(default))


def month_name(stamp: Column) -> Column:
    return F.date_format(stamp, "MMMM")


def year_text(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy")


def distinct_with_null(column: Column) -> Column:
    """Distinct count in which NULL counts as one value."""
    return F.count_distinct(column) + F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))
