"""Bronze to silver job."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from jobgauge.operators.business import add_month, apply_business_rules
from jobgauge.operators.joins import lookup
from jobgauge.operators.totals import category_metrics, daily_totals, with_running_total
from jobgauge.rules import SALES_DEFAULTS, SalesRules
from jobgauge.sources.publish import publish_tables
from jobgauge.sources.tables import read_bronze, read_regions
from jobgauge.sources.writers import export_copy, write_table, write_tables

TARGETS = ("main", "daily_agg", "category_metrics", "export")


def silver_table(bronze: DataFrame, regions: DataFrame, rules: SalesRules = SALES_DEFAULTS) -> DataFrame:
    return apply_business_rules(lookup(bronze, regions, "region_id"), rules)


def aggregate_data(df: DataFrame) -> dict[str, DataFrame]:
    return {"daily_agg": with_running_total(daily_totals(df)), "category_metrics": category_metrics(df)}


def write_silver(
    silver: DataFrame, target_paths: Mapping[str, str], partition_by: Sequence[str] = ("data_month",)
) -> Mapping[str, str]:
    """Write the main table, then build the other outputs from it, and a copy of it as `export`.

    The written table takes the place of a cache: the join and the rules run once, the aggregates read only the
    columns they need, and a lost executor costs no recomputation.
    """
    silver = add_month(silver) if "data_month" in partition_by else silver
    write_table(silver, target_paths["main"], partition_by=partition_by)
    main = silver.sparkSession.read.schema(silver.schema).parquet(target_paths["main"])
    write_tables({target_paths[name]: aggregate for name, aggregate in aggregate_data(main).items()})
    export_copy(main, target_paths["export"])
    return target_paths


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    region_path: str,
    target_paths: Mapping[str, str],
    rules: SalesRules = SALES_DEFAULTS,
    region_format: str = "csv",
) -> Mapping[str, str]:
    """Write the four silver outputs named in TARGETS and return their paths."""
    bronze = read_bronze(spark, bronze_path)
    regions = read_regions(spark, region_path, region_format)
    return write_silver(silver_table(bronze, regions, rules), target_paths)


def publish_silver(
    spark: SparkSession,
    bronze_path: str,
    region_path: str,
    base_path: str,
    rules: SalesRules = SALES_DEFAULTS,
    region_format: str = "csv",
) -> dict[str, str]:
    """`run_silver` with its four outputs published together below `base_path`; see `sources.publish.published`."""

    def write(folder: str) -> Mapping[str, str]:
        targets = {name: f"{folder}/{name}" for name in TARGETS}
        return run_silver(spark, bronze_path, region_path, targets, rules, region_format)

    return publish_tables(spark, base_path, write)
