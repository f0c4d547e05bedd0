"""Suggestions and their order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgauge import rules as R
from jobgauge.functions.runs import grown_workers, severity_rank
from jobgauge.operators.summary import by_reason


def suggest(
    analysis: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS, literal: bool = False
) -> DataFrame:
    """One suggestion per analysed job, unordered.

    The branch follows the runtime rule that fired. `literal` instead looks for the words "increase cluster size" in
    the recommendation, which none contains, so long-running jobs keep their size.
    """
    suggested = analysis
    if literal:
        text = F.lower("recommendation")
        reason = (
            F.when(F.contains(text, F.lit("increase cluster size")), F.lit("long_running"))
            .when(F.contains(text, F.lit("data skew")), F.lit("skew"))
            .otherwise(F.lit("acceptable"))
        )
        suggested = analysis.withColumn("reason", reason)
    workers = F.col("num_workers")
    grown = grown_workers(workers, rules.worker_growth, rules.worker_floor)
    no_hints = F.array().cast("array<string>")
    return suggested.select(
        "job_id",
        "job_name",
        _cluster(workers).alias("current_config"),
        "recommendation",
        "severity",
        _cluster(by_reason(grown, workers, workers)).alias("suggested_config"),
        by_reason(_texts(R.LONG_RUNNING_HINTS), _texts(R.SKEW_HINTS), no_hints).alias("code_changes"),
        "avg_runtime",
        severity_rank(F.col("severity")).alias("severity_rank"),
    )


def prioritized(df: DataFrame, literal: bool = False) -> DataFrame:
    """Most severe first, then slowest. `literal` orders the severity names backwards as text."""
    severity = F.desc("severity") if literal else severity_rank(F.col("severity"))
    return df.orderBy(severity, F.desc("avg_runtime"), "job_id")


def top_priority(df: DataFrame) -> DataFrame:
    return prioritized(df).limit(1)


def suggestions_for(suggestions: DataFrame, requested: DataFrame) -> DataFrame:
    """The suggestions of requested jobs; a job without one keeps its row, with NULLs."""
    return requested.select("job_id").distinct().join(suggestions, "job_id", "left")


def _cluster(workers: Column) -> Column:
    return F.struct("driver_size", "worker_size", workers.alias("num_workers"))


def _texts(texts) -> Column:
    return F.array(*[F.lit(text) for text in texts])
