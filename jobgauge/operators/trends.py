"""Durations, late starts and throughput."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgauge.operators.logs import log_metrics

DAY_MINUTES = 24 * 60


def duration_check(runs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole minutes between start and end, next to the reported minutes."""
    elapsed = F.timestamp_diff("MINUTE", F.col("start_time"), F.col("end_time"))
    return runs.select(
        "job_id", "start_time", *keep, "runtime_minutes", elapsed.alias("elapsed_minutes")
    ).withColumn("gap_minutes", F.col("elapsed_minutes") - F.col("runtime_minutes"))


def late_starts(runs: DataFrame) -> DataFrame:
    """Per job, the earliest and the latest minute of the day it started at, and the minutes between them.

    The day is a circle: all starts lie in the arc that the widest gap without a start leaves, so 23:58 and 00:03 are
    five minutes apart. Of equally wide gaps the one over midnight counts, then the first. The aggregate keeps a job's
    different minutes, 1,440 at most.
    """
    minute = F.hour("start_time") * 60 + F.minute("start_time")
    starts = runs.filter(F.col("job_id").isNotNull()).groupBy("job_id").agg(F.sort_array(F.collect_set(minute)).alias("minutes"))
    first, last = F.get("minutes", F.lit(0)), F.get("minutes", F.size("minutes") - 1)
    over_midnight = F.struct((first + DAY_MINUTES - last).alias("gap"), F.lit(1).alias("order"), first.alias("to"), last.alias("from"))

    def gap(minute: Column, place: Column) -> Column:
        before = F.get("minutes", place - 1)
        return F.struct((minute - before).alias("gap"), (-place).alias("order"), minute.alias("to"), before.alias("from"))

    inner = F.filter(F.transform("minutes", gap), lambda g: g["from"].isNotNull())
    widest = F.array_max(F.concat(F.array(over_midnight), inner))
    return starts.withColumn("_widest", F.when(F.size("minutes") > 0, widest)).select(
        "job_id",
        F.col("_widest.to").alias("earliest_minute"),
        F.col("_widest.from").alias("latest_minute"),
        (DAY_MINUTES - F.col("_widest.gap")).alias("late_minutes"),
    )


def throughput_trend(runs: DataFrame, tiebreak: Sequence[str] = (), bucket: str = "day") -> DataFrame:
    """Rows per minute of each run, that of the job's previous run, and the change.

    The previous run is looked up inside (job, time bucket) groups, so a job with a large share of all runs is spread
    over many tasks. The first run of a bucket takes the last value of the job's previous bucket from a table with one
    row per job and bucket. Both read the same shuffle: the logs are searched once.
    """
    metrics = log_metrics(runs, keep=("runtime_minutes", *tiebreak)).filter(F.col("job_id").isNotNull())
    order = ["start_time", *tiebreak]
    rate = F.when(F.col("runtime_minutes") > 0, F.col("rows_processed") / F.col("runtime_minutes"))
    rated = metrics.select(
        "job_id",
        *order,
        F.coalesce(F.date_trunc(bucket, "start_time"), F.lit(0).cast("timestamp")).alias("_bucket"),
        # A run without a usable rate still is a run: the struct keeps it apart from "no previous run".
        F.struct(rate.alias("rows_per_minute")).alias("_run"),
    ).repartition("job_id", "_bucket")
    last = rated.groupBy("job_id", "_bucket").agg(F.max(F.struct(*order, "_run"))["_run"].alias("_last"))
    by_bucket = Window.partitionBy("job_id").orderBy("_bucket")
    before = last.select("job_id", "_bucket", F.lag("_last").over(by_bucket).alias("_before"))
    in_bucket = Window.partitionBy("job_id", "_bucket").orderBy(*order, "_run")
    previous = F.coalesce(F.col("_previous"), F.col("_before"))["rows_per_minute"]
    return (
        rated.withColumn("_previous", F.lag("_run").over(in_bucket))
        .join(before, ["job_id", "_bucket"])
        .select("job_id", *order, "_run.rows_per_minute", previous.alias("previous_rows_per_minute"))
        .withColumn("change", F.col("rows_per_minute") - F.col("previous_rows_per_minute"))
    )
