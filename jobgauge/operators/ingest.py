"""Source to bronze."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge.functions.numbers import filter_min_value
from jobgauge.functions.sales import distinct_with_null, parse_date
from jobgauge.rules import SALES_DEFAULTS, SalesRules


def cross_reference(
    df: DataFrame, reference: DataFrame, column: str, order_by: Sequence[str], rows: int, alias: str
) -> DataFrame:
    """Pair every row with the first `rows` values of a reference column.

    The few values travel as one array from a scalar subquery and are exploded in place, so the large side is neither
    joined nor shuffled and filters still reach its scan.
    """
    first = reference.orderBy(*order_by).limit(rows).agg(F.collect_list(F.struct(F.col(column).alias("v"))))
    paired = df.withColumn("_reference", first.scalar()).withColumn("_value", F.explode("_reference"))
    return paired.withColumn(alias, F.col("_value.v")).drop("_reference", "_value")


def transform_sales(
    source: DataFrame,
    rules: SalesRules = SALES_DEFAULTS,
    order_by: Sequence[str] = ("date", "region"),
    reference: DataFrame | None = None,
) -> DataFrame:
    """Filter, stamp, parse dates, upper-case the category and pair with the reference regions.

    The reference regions come from the source itself unless `reference` is given. Finding the first ones of a large
    source reads it once more, so pass a small table with the `order_by` columns where there is one.
    """
    kept = filter_min_value(source, rules.ingest_min_value).withColumns(
        {
            "processed_timestamp": F.current_timestamp(),
            "data_date": parse_date(F.col("date")),
            "CATEGORY_UPPERCASE": F.upper("category"),
        }
    )
    regions = source if reference is None else reference
    return cross_reference(kept, regions, "region", order_by, rules.reference_rows, "ref_region")


#: Registers of a distinct sketch, as a power of two. One standard error is 1.04 / 2^(SKETCH_BITS / 2), here 1.6 percent.
SKETCH_BITS = 12


def batch_sketches(bronze: DataFrame, column: str = "category", batch: str = "batch_id") -> DataFrame:
    """One small row per batch, to be kept with it: rows, whether the column has NULL, and a sketch of its distinct values.

    Sketches merge, so `distinct_over_batches` needs no rows of the batches any more.
    """
    return bronze.groupBy(batch).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.max(F.col(column).isNull()).alias("has_null"),
        F.hll_sketch_agg(column, SKETCH_BITS).alias("sketch"),
    )


def distinct_over_batches(sketches: DataFrame) -> DataFrame:
    """One row: rows and about how many distinct values all batches have together; NULL counts as one, as in ingest_metrics."""
    distinct = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)) + F.coalesce(F.max(F.col("has_null").cast("int")), F.lit(0))
    return sketches.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), distinct.cast("long").alias("distinct_estimate"))


def ingest_metrics(bronze: DataFrame) -> DataFrame:
    """Row count, distinct categories (NULL counts as one) and rows without a date."""
    return bronze.agg(
        F.count(F.lit(1)).alias("row_count"),
        distinct_with_null(F.col("category")).alias("distinct_categories"),
        F.count_if(F.col("data_date").isNull()).alias("rows_without_date"),
    )
