import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import config, plan, rows, run
from jobgauge import schemas
from jobgauge.operators import history, logs, summary, trends
from jobgauge.streaming import monitor
from workload import run_queries
from workload.views import runs as runs_of


@pytest.fixture
def run_files(spark, path):
    """Thirty runs of five jobs over ten days, one file per two days, with ascending file times."""
    data = [run(i % 5, 20 + i, 1 + i // 3, f"log {i}", config(i % 9), hour=i % 3) for i in range(30)]
    runs = spark.createDataFrame(data, schemas.RUNS)
    for number in range(5):
        part = runs.filter(F.floor((F.dayofmonth("start_time") - 1) / 2) == number)
        part.coalesce(1).write.mode("append").parquet(path("runs"))
    return path("runs"), runs


def test_last_snapshot_equals_the_batch_analysis(spark, run_files, path):
    folder, runs = run_files
    stream = monitor.read_run_stream(spark, folder, files_per_trigger=1)
    seen = []
    query = monitor.monitor_history(
        stream, path("history"), path("state"), on_analysis=lambda analysis, batch_id: seen.append(batch_id)
    )
    query.awaitTermination()
    assert seen == [0, 1, 2, 3, 4]
    snapshots = history.read_history(spark, path("history"))
    last = snapshots.filter("batch_id = 4").select("job_id", "avg_runtime", "recommendation")
    batch = summary.analyze_runs(runs).select("job_id", "avg_runtime", "recommendation")
    assert rows(last) == rows(batch)
    # Started again, the stream goes on where it stopped.
    late = spark.createDataFrame([run(77, 50, 12), run(77, 60, 13)], schemas.RUNS)
    late.coalesce(1).write.mode("append").parquet(folder)
    monitor.monitor_history(stream, path("history"), path("state")).awaitTermination()
    assert history.read_history(spark, path("history")).filter("batch_id = 5 and job_id = 77").count() == 1


def test_the_stream_splits_usual_runtimes_without_logarithms(run_files):
    _, runs = run_files
    assert plan(summary.partial_summaries(runs)).upper().count("LOG2(") <= 2


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_a_table_of_one_row_group_arrives_in_files_of_several_tasks(spark, path):
    """Six days in one file: two days in each group, without every tenth run of the first day, which comes last."""
    ids = F.col("id")
    day = F.least(F.floor(ids / 20_000), F.lit(6))
    events = spark.range(120_001).select(
        ids.alias("event_id"), F.when(day < 6, F.timestamp_seconds(day * 86_400 + ids % 1000)).cast("timestamp_ntz").alias("ts"),
        (ids % 50).alias("user_id"), F.lit("click").alias("event_type"), (ids % 9).cast("double").alias("value"),
        F.lit('{"k": 3}').alias("props"),
    )
    events.coalesce(1).write.parquet(path("events.parquet"))
    files, arrived = [], []
    setting = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1b")
    try:
        for _ in run_queries._run_streams(spark, path(""), path("stream")):
            there = spark.read.schema(events.schema).option("recursiveFileLookup", "true").parquet(path("stream/files"))
            files.append(len(there.inputFiles()))
            arrived.append(there.count())
    finally:
        spark.conf.set(setting, before)
    assert all(more - fewer > 1 for fewer, more in zip([0, *files], files, strict=False))
    assert arrived == [38_000, 78_000, 120_001]
    assert there.exceptAll(events).isEmpty() and events.exceptAll(there).isEmpty()


@pytest.mark.parametrize("hours", [0, 5])
def test_a_stream_over_groups_without_runs(spark, path, hours):
    """All runs on one day, which leaves the second group empty, and no runs at all."""
    data = [(i, dt.datetime(2024, 3, 1, i % 5), i % 3, "view", float(i), '{"k": 4}') for i in range(hours * 6)]
    spark.createDataFrame(data, EVENTS).write.parquet(path("events.parquet"))
    last = run_queries.monitor_stream(spark, path(""))
    batch = summary.analyze_runs(runs_of(spark, path("")), run_queries.RUN_RULES, run_queries.TIEBREAK)
    assert rows(last) == rows(batch.select("job_id", "avg_runtime", "recommendation"))


def test_replayed_batch_replaces_its_snapshot(spark, run_files, path):
    _, runs = run_files
    analysis = summary.analyze_runs(runs)
    for ts in ("2024-03-20", "2024-03-21"):
        history.append_history(analysis, path("history"), 1, F.lit(ts))
    history.append_history(analysis, path("history"), 2, F.lit("2024-03-22"))
    stored = history.read_history(spark, path("history"))
    assert stored.count() == 10
    rolled = {r.job_id: r for r in history.history_rollup(stored).collect()}
    assert len(rolled) == 5 and rolled[0].snapshots == 2 and rolled[0].change == 0
    assert rolled[0].first_ts == dt.datetime(2024, 3, 21) and rolled[0].last_ts == dt.datetime(2024, 3, 22)
    assert [r.job_id for r in history.history_timeline(stored).collect()] == sorted(list(range(5)) * 2)


def test_closed_days_equal_the_batch(spark, run_files, path):
    folder, runs = run_files
    stream = monitor.read_run_stream(spark, folder, files_per_trigger=1)
    monitor.monitor_daily(stream, path("days"), path("state")).awaitTermination()
    closed = runs.filter(F.date_trunc("day", "start_time") <= F.lit(dt.datetime(2024, 3, 8)))
    expected = (
        closed.groupBy("job_id", F.date_trunc("day", "start_time").alias("day_start"))
        .agg(F.count(F.lit(1)).alias("runs"), F.avg("runtime_minutes"), F.max("runtime_minutes"), F.min("runtime_minutes"))
    )
    assert rows(spark.read.parquet(path("days")).drop("day_end", "runtime_misfits")) == rows(expected)


def test_throughput_equals_the_direct_window(spark):
    """A job with most of the runs, runs that report no rows, equal start times and runs without a start."""
    rng = random.Random(3)
    data = []
    for run_id in range(600):
        job = 1 if run_id % 3 else rng.randrange(2, 30)
        start = None if run_id % 50 == 0 else dt.datetime(2024, 3, 1) + dt.timedelta(hours=rng.randrange(400))
        output = None if run_id % 7 == 0 else f"INFO: Processed {rng.randrange(5000):,} rows"
        minutes = None if run_id % 11 == 0 else float(rng.randrange(0, 9))
        data.append((run_id, job, start, minutes, output))
    runs = spark.createDataFrame(data, "run_id long, job_id long, start_time timestamp, runtime_minutes double, output string")
    trend = trends.throughput_trend(runs, ("run_id",))
    direct = F.lag("rows_per_minute").over(Window.partitionBy("job_id").orderBy("start_time", "run_id"))
    base = trend.select("job_id", "start_time", "run_id", "rows_per_minute")
    assert trend.count() == 600
    expected = base.withColumn("previous_rows_per_minute", direct)
    expected = expected.withColumn("change", F.col("rows_per_minute") - F.col("previous_rows_per_minute"))
    assert rows(trend) == rows(expected)
    assert rows(trends.throughput_trend(runs, ("run_id",), bucket="hour")) == rows(expected)


LOG = (
    r"INFO: Started\nWARN: Tasks waited long for executor scheduling\nWARN: Shuffle spill (memory) of 2.5 GB and (disk) of 11 GB"
    r"\nWARN: Join shows skew\nINFO: Processed 1,234,567 rows\nINFO: Found 35 distinct categories\nno level here"
)


def test_log_mining(spark):
    runs = spark.createDataFrame([run(1, 10, output=LOG), run(1, 10, 2, output=None), run(2, 5, output="INFO: x")], schemas.RUNS)
    lines = logs.log_lines(runs)
    assert lines.filter("job_id = 1").count() == 7
    assert lines.filter("level is null").first().message == "no level here"
    assert rows(logs.warning_counts(runs)) == [(1, 3, 1, 0, 1, 1), (2, 0, 0, 0, 0, 0)]
    metrics = {tuple(r)[2:] for r in logs.log_metrics(runs).collect()}
    assert metrics == {(1234567, 35, 2.5, 11.0), (None, None, None, None)}


def test_durations_and_late_starts(spark):
    runs = spark.createDataFrame([run(1, 30, 1, hour=1), run(1, 31, 2, hour=1), run(1, 30, 3, hour=2)], schemas.RUNS)
    shifted = runs.withColumn("runtime_minutes", F.col("runtime_minutes") + 2)
    assert {r.gap_minutes for r in trends.duration_check(shifted).collect()} == {-2.0}
    assert rows(trends.late_starts(runs)) == [(1, 60, 120, 60)]


def test_trend_spreads_a_job_over_its_days_by_one_shuffle_of_the_runs(run_files):
    _, runs = run_files
    trend = trends.throughput_trend(runs)
    assert plan(trend).split("Window [lag(_run")[1].split("hashpartitioning(")[1].split(")")[0].count("_bucket#") == 1
    trend.collect()
    assert "ReusedExchange" in plan(trend)
