"""Summaries of runs kept in a table that is bucketed by job, so that analyses of all batches need no shuffle."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from jobgauge import rules as R
from jobgauge.operators.summary import analyze_summary, merge_summaries, partial_summaries


def store_summaries(
    runs: DataFrame,
    table: str,
    path: str,
    buckets: int,
    rules: R.AdvisorRules = R.ADVISOR_DEFAULTS,
    tiebreak: Sequence[str] = (),
) -> None:
    """Append the partial summaries of a batch of runs, each batch once, to the table at `path`.

    Summaries are kept, not runs: a job has a few rows per batch however many runs it has, so no bucket outgrows a task
    because of one job. A batch adds one file per bucket. All batches have one number of buckets, which should make a bucket of
    the finished table fit a task. Runs without a job are left out; a batch without runs adds nothing.
    """
    partials = partial_summaries(runs, rules, tiebreak).repartition(buckets, "job_id")
    partials.write.mode("append").bucketBy(buckets, "job_id").sortBy("job_id").option("path", path).saveAsTable(table)


def stored_analysis(
    spark: SparkSession, table: str, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """`analyze_runs` of all runs in all stored batches, without an exchange; `tiebreak` as when they were stored."""
    return analyze_summary(merge_summaries(spark.table(table), tiebreak), rules)
