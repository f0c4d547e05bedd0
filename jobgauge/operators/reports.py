"""Report tables, chart data and the status record."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgauge import rules as R
from jobgauge.functions.runs import one_decimal
from jobgauge.operators.costs import job_cost


def report_summary(analysis: DataFrame) -> DataFrame:
    return analysis.agg(
        F.count(F.lit(1)).alias("jobs"),
        F.count_if(F.col("severity") == "HIGH").alias("high_priority"),
        F.count_if(F.col("severity") == "MEDIUM").alias("medium_priority"),
    )


def report_job_table(analysis: DataFrame) -> DataFrame:
    return analysis.select(
        "job_id",
        "job_name",
        one_decimal(F.col("avg_runtime")).alias("avg_runtime_text"),
        "num_workers",
        "severity",
        "recommendation",
    )


def report_details(suggestions: DataFrame) -> DataFrame:
    """One row per suggested code change; a job without any keeps one row."""
    return suggestions.select(
        "job_id",
        "job_name",
        "severity",
        F.col("current_config.driver_size").alias("driver_size"),
        F.col("current_config.worker_size").alias("worker_size"),
        F.col("current_config.num_workers").alias("num_workers"),
        F.col("suggested_config.driver_size").alias("suggested_driver_size"),
        F.col("suggested_config.worker_size").alias("suggested_worker_size"),
        F.col("suggested_config.num_workers").alias("suggested_num_workers"),
        F.posexplode_outer("code_changes").alias("change_no", "code_change"),
    )


def chart_runtime(analysis: DataFrame) -> DataFrame:
    return analysis.select("job_id", "job_name", "avg_runtime").orderBy(F.desc("avg_runtime"), "job_id")


def chart_scatter(analysis: DataFrame) -> DataFrame:
    return analysis.select("job_id", "job_name", "num_workers", "avg_runtime")


def chart_cost(analysis: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS) -> DataFrame:
    return job_cost(analysis, rules).select("job_id", "job_name", "cost_estimate")


def advisor_status(runs: DataFrame, analysis: DataFrame) -> DataFrame:
    """One row: completed with the number of suggestions, or failed for want of data.

    Of the runs one row is read at most, when the result is.
    """
    first = runs.limit(1).agg(F.count(F.lit(1)).alias("rows"))
    found = analysis.agg(F.count(F.lit(1)).alias("found")).withColumn("loaded", first.scalar() > 0)
    return found.select(
        F.when(F.col("loaded"), F.lit("completed")).otherwise(F.lit("failed")).alias("status"),
        F.when(F.col("loaded"), F.col("found")).alias("suggestions"),
        F.when(~F.col("loaded"), F.lit(R.NO_DATA_TEXT)).alias("error"),
    )


def failed_status(spark: SparkSession) -> DataFrame:
    """The status row of a run without data."""
    nothing = spark.range(1)
    return nothing.select(
        F.lit("failed").alias("status"),
        F.lit(None).cast("bigint").alias("suggestions"),
        F.lit(R.NO_DATA_TEXT).alias("error"),
    )
