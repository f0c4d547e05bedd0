"""Cost of jobs and runs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge import rules as R
from jobgauge.functions.exact import exact_aggregate
from jobgauge.functions.numbers import finite_number, misfits
from jobgauge.functions.runs import config_fields, run_cost


def job_cost(analysis: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS) -> DataFrame:
    """Analysis with the worker cost of an average run."""
    cost = run_cost(F.col("num_workers"), F.col("avg_runtime"), rules.worker_hourly_rate)
    return analysis.withColumn("cost_estimate", cost)


def full_run_cost(runs: DataFrame, thresholds: R.ConfiguredThresholds = R.CONFIGURED_DEFAULTS) -> DataFrame:
    """Each run with its worker and driver cost."""
    hourly = F.col("num_workers") * thresholds.worker_hourly_rate + thresholds.driver_hourly_rate
    minutes = finite_number(F.col("runtime_minutes"))
    return runs.withColumn("num_workers", config_fields(F.col("configuration"))["num_workers"]).withColumn(
        "run_cost", hourly * minutes / 60
    )


def full_job_cost(runs: DataFrame, thresholds: R.ConfiguredThresholds = R.CONFIGURED_DEFAULTS) -> DataFrame:
    """Worker and driver cost of all runs of a job, from exact sums of minutes and worker minutes.

    Runtimes that are not finite numbers cost nothing and are counted.
    """
    minutes = finite_number(F.col("runtime_minutes"))
    workers = config_fields(F.col("configuration"))["num_workers"]
    costed = runs.filter(F.col("job_id").isNotNull()).select("job_id", "runtime_minutes", minutes.alias("m"), (minutes * workers).alias("w"))
    counts = {"runs": (F.count(F.lit(1)), F.sum), "runtime_misfits": (misfits(F.col("runtime_minutes")), F.sum)}
    sums = exact_aggregate(costed, ["job_id"], {"minutes": F.col("m"), "worker_minutes": F.col("w")}, counts)
    sums = sums.select("job_id", "runs", "minutes", "worker_minutes", "runtime_misfits")
    cost = (
        F.col("worker_minutes") * thresholds.worker_hourly_rate + F.col("minutes") * thresholds.driver_hourly_rate
    ) / 60
    return sums.withColumn("total_cost", cost)


def cost_target(costs: DataFrame, thresholds: R.ConfiguredThresholds = R.CONFIGURED_DEFAULTS) -> DataFrame:
    """Current cost and the cost after the configured cut."""
    kept = F.lit(1 - thresholds.cost_reduction_percent / 100)
    return costs.select(
        "job_id",
        F.col("cost_estimate").alias("current_cost"),
        (F.col("cost_estimate") * kept).alias("target_cost"),
    )
