"""Row rules of the silver table."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge.functions.numbers import filter_min_value, finite_number
from jobgauge.functions.sales import month_name, tax_rate, year_text
from jobgauge.rules import SALES_DEFAULTS, SalesRules


def high_value(df: DataFrame, rules: SalesRules = SALES_DEFAULTS) -> DataFrame:
    return filter_min_value(df, rules.high_value)


def priority_regions(df: DataFrame, rules: SalesRules = SALES_DEFAULTS) -> DataFrame:
    return df.filter(F.col("region").isin(*rules.priority_regions))


def add_tax(df: DataFrame, rules: SalesRules = SALES_DEFAULTS) -> DataFrame:
    value = finite_number(F.col("value"))
    rate = tax_rate(F.col("region"), rules.tax_rates, rules.default_tax_rate)
    return df.withColumn("tax_rate", rate).withColumns(
        {"tax_amount": value * F.col("tax_rate"), "value_with_tax": value + value * F.col("tax_rate")}
    )


def add_calendar(df: DataFrame, stamp: str = "data_date") -> DataFrame:
    return df.withColumns({"month": month_name(F.col(stamp)), "year": year_text(F.col(stamp))})


def add_month(df: DataFrame, stamp: str = "data_date") -> DataFrame:
    """Add data_month, the first day of the month: a partition column that `between_dates` can prune by."""
    return df.withColumn("data_month", F.trunc(F.col(stamp).cast("date"), "month"))


def between_dates(df: DataFrame, first: dt.date, last: dt.date, stamp: str = "data_date") -> DataFrame:
    """The rows from `first` to `last`; of a table partitioned by data_month only the months between are read."""
    day = F.col(stamp).cast("date")
    months = F.col("data_month").between(F.lit(first.replace(day=1)), F.lit(last))
    return df.filter(months & day.between(F.lit(first), F.lit(last)))


def apply_business_rules(df: DataFrame, rules: SalesRules = SALES_DEFAULTS) -> DataFrame:
    return add_calendar(add_tax(df, rules))
