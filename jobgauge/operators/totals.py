"""Aggregates of the silver table. Totals are exact sums of doubles, rounded once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge.functions.exact import exact_aggregate
from jobgauge.functions.numbers import misfits
from jobgauge.operators.prefix_sums import with_prefix_sum
from jobgauge.sources.scratch import written


def daily_totals(df: DataFrame) -> DataFrame:
    """Total, average and row count per date and region, and how many values are not in the total."""
    keys, value = ["data_date", "region"], F.col("value")
    totals = exact_aggregate(df, keys, {"total_value": value}, _counts("transaction_count"))
    average = F.col("total_value") / F.nullif("total_value_count", F.lit(0))
    return totals.select(*keys, "total_value", average.alias("avg_value"), "transaction_count", "value_misfits")


def _counts(rows: str) -> dict:
    """Rows, and values that are no number, as mergeable aggregates."""
    return {rows: (F.count(F.lit(1)), F.sum), "value_misfits": (misfits(F.col("value")), F.sum)}


def category_metrics(df: DataFrame) -> DataFrame:
    """Row count, total and values not in it, per category, in one pass; rows without a category are left out."""
    named = df.filter(F.col("category").isNotNull())
    metrics = exact_aggregate(named, ["category"], {"category_total": F.col("value")}, _counts("count"))
    return metrics.select("category", "count", "category_total", "value_misfits")


def with_running_total(daily: DataFrame) -> DataFrame:
    """Add the total of all rows up to and including each date, or time stamp; rows of one date share it.

    The aggregate is needed twice, so it is computed once and kept in the scratch space.
    """
    return with_prefix_sum(written(daily, "daily"), "total_value", ["data_date"], "running_total")


def with_regional_running_total(daily: DataFrame) -> DataFrame:
    """As with_running_total, per region; a region with most of the rows is split over many tasks, too."""
    return with_prefix_sum(written(daily, "daily"), "total_value", ["data_date"], "running_total", ["region"])


def top_days(daily: DataFrame, rows: int) -> DataFrame:
    return daily.orderBy(F.desc("total_value"), "data_date", "region").limit(rows)
