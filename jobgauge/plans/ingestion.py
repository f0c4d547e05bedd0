"""Source to bronze job."""

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgauge import schemas
from jobgauge.operators.business import add_calendar, add_month
from jobgauge.operators.ingest import ingest_metrics, transform_sales
from jobgauge.rules import SALES_DEFAULTS, SalesRules
from jobgauge.sources.tables import read_source
from jobgauge.sources.writers import write_table


def run_ingestion(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    source_format: str = "csv",
    mode: str = "overwrite",
    rules: SalesRules = SALES_DEFAULTS,
    partition_by: Sequence[str] = ("data_month",),
    reference: DataFrame | None = None,
    reference_order: Sequence[str] = ("date", "region"),
    batch_id: str | None = None,
) -> DataFrame:
    """Write the rows of one run to the bronze table, as a batch of their own, and return the metrics of this run.

    The metrics read three columns of the batch just written: nothing is cached, a task that ran twice counts once, and
    batches of earlier runs do not count. Give a small `reference` table with the `reference_order` columns and region
    where there is one; without it, the regions come from a second scan of the source.

    The write does not shuffle: rows go from the tasks that paired them to the directories of their months.

    With the mode "batch", the batch replaces an earlier one of its id, months that it no longer has included, and all other
    batches stay; a repeated run changes nothing. Its id is letters, digits, dots, underscores and dashes then.
    """
    batch_id = batch_id or uuid.uuid4().hex
    if mode == "batch" and not re.fullmatch(r"[\w.-]+", batch_id, re.ASCII):
        raise ValueError(f"Not an id of a batch: {batch_id!r}")
    source = read_source(spark, source_path, source_format, schemas.SALES)
    bronze = transform_sales(source, rules, reference_order, reference)
    if {"year", "month"} & set(partition_by):
        bronze = add_calendar(bronze)
    if "data_month" in partition_by:
        bronze = add_month(bronze)
    if mode == "batch":
        write_table(bronze, f"{target_path}/batch_id={batch_id}", "overwrite", partition_by, rebalance=False)
    bronze = bronze.withColumn("batch_id", F.lit(batch_id))
    if mode != "batch":
        write_table(bronze, target_path, mode, ("batch_id", *partition_by), rebalance=False)
    return ingest_metrics(spark.read.schema(bronze.schema).parquet(target_path).filter(F.col("batch_id") == batch_id))
