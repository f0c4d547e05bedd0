"""Continuous monitoring of job runs that arrive as files."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from jobgauge import rules as R
from jobgauge import schemas
from jobgauge.operators.history import append_history
from jobgauge.operators.summary import analyze_summary, merge_summaries, partial_summaries, prepare_runs, window_runtime_columns


def read_run_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = schemas.RUNS,
    files_per_trigger: int = 1000,
    name_pattern: str = "*.parquet",
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", name_pattern)
        .parquet(path)
    )


def monitor_history(
    runs: DataFrame,
    history_path: str,
    checkpoint_path: str,
    rules: R.AdvisorRules = R.ADVISOR_DEFAULTS,
    tiebreak: Sequence[str] = (),
    on_analysis: Callable[[DataFrame, int], None] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Process all available files; each trigger appends one snapshot of every job to the history.

    The state holds one summary row per job and bin of its runtimes, a few rows per job. Snapshots are stored by batch id, so a replayed batch replaces its own.
    The first start fixes the number of state partitions; the session's shuffle partitions if not given.
    """

    def save(partials: DataFrame, batch_id: int) -> None:
        analysis = analyze_summary(merge_summaries(partials, tiebreak), rules)
        append_history(analysis, history_path, batch_id)
        if on_analysis is not None:
            on_analysis(analysis, batch_id)

    writer = partial_summaries(runs, rules, tiebreak).writeStream.outputMode("complete").foreachBatch(save)
    return _start(runs.sparkSession, writer, checkpoint_path, state_partitions)


def daily_runtimes(runs: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Runtimes per job and day over a stream; a day closes once the watermark passes its end.

    State holds open days only. Runs later than `lateness` behind the newest run, and runs without a start, are left out,
    as for any watermark; `left_out_runs` counts them.
    """
    stamped = prepare_runs(runs).withColumn("start_time", F.col("start_time").cast("timestamp"))
    return (
        stamped.withWatermark("start_time", lateness)
        .groupBy("job_id", F.window("start_time", "1 day").alias("day"))
        .agg(*window_runtime_columns())
        .select("job_id", F.col("day.start").alias("day_start"), F.col("day.end").alias("day_end"),
                "runs", "avg_runtime", "max_runtime", "min_runtime")
    )


def monitor_daily(
    runs: DataFrame,
    output_path: str,
    checkpoint_path: str,
    lateness: str = "1 day",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append closed days to a Parquet table."""
    days = daily_runtimes(runs, lateness)
    writer = days.writeStream.outputMode("append").format("parquet").option("path", output_path)
    return _start(runs.sparkSession, writer, checkpoint_path, state_partitions)


def left_out_runs(runs: DataFrame, days: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Per job and day, the runs that the daily table `days` does not hold: a batch query over the run files.

    `reason` is "undated" for runs without a start, "open" for days that end less than `lateness` before the newest run,
    and "late" for all others: they came when their day was closed.
    """
    day = F.date_trunc("day", F.col("start_time").cast("timestamp"))
    arrived = (
        runs.filter(F.col("job_id").isNotNull())
        .groupBy("job_id", day.alias("day_start"))
        .agg(F.count(F.lit(1)).alias("arrived"))
    )
    closed = days.select(F.col("job_id").alias("_job"), F.col("day_start").alias("_day"), F.col("runs").alias("_runs"))
    same = (F.col("job_id") == F.col("_job")) & F.col("day_start").eqNullSafe(F.col("_day"))
    newest = runs.agg(F.max(F.col("start_time").cast("timestamp"))).scalar()
    missing = F.col("arrived") - F.coalesce("_runs", F.lit(0))
    reason = (
        F.when(F.col("day_start").isNull(), "undated")
        .when(F.col("day_start") + F.expr("INTERVAL 1 DAY") > F.col("_newest") - F.expr(f"INTERVAL {lateness}"), "open")
        .otherwise("late")
    )
    return (
        arrived.join(closed, same, "left")
        .withColumn("_newest", newest)
        .select("job_id", "day_start", missing.alias("runs"), reason.alias("reason"))
        .filter("runs > 0")
    )


def _start(
    spark: SparkSession, writer: DataStreamWriter, checkpoint_path: str, state_partitions: int | None
) -> StreamingQuery:
    """Start on all available files. The query keeps the settings the session has now."""
    writer = writer.option("checkpointLocation", checkpoint_path).trigger(availableNow=True)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, state_partitions or before)
    try:
        return writer.start()
    finally:
        spark.conf.set(setting, before)
