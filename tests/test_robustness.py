"""Values and rows that must not be lost, multiplied or end a job."""

import datetime as dt
import os
from fractions import Fraction

from pyspark.sql import functions as F

from helpers import config, rows, run
from jobgauge import schemas
from jobgauge.operators import business, changes, costs, joins, logs, summary, totals, trends
from jobgauge.operators.advice import suggest
from jobgauge.plans.advisor import advise, run_advisor
from jobgauge.sources import run_log
from jobgauge.sources.scratch import remove, scratch_path, written
from jobgauge.streaming import monitor

DAY = dt.datetime(2024, 1, 1)


def runs_of(spark, data):
    return spark.createDataFrame(data, schemas.RUNS)


def test_values_far_apart_add_up(spark):
    small = spark.range(10_000).select(F.lit(DAY).alias("data_date"), F.lit("x").alias("region"), F.lit(0.00004).alias("value"))
    row = totals.daily_totals(small).first()
    total = float(10_000 * Fraction(0.00004))
    assert row.total_value == total and row.avg_value == total / 10_000 and row.value_misfits == 0
    values = [1e14, 0.25, 1e30, -1e30, float("nan"), None]
    large = spark.createDataFrame([(DAY, "x", v) for v in values], "data_date timestamp, region string, value double")
    row = totals.with_running_total(totals.daily_totals(large)).first()
    assert row.running_total == 100000000000000.25 and (row.transaction_count, row.value_misfits) == (6, 1)
    jobs = runs_of(spark, [(job, "x", "", m, DAY, DAY, "") for job, m in ((1, 1e12), (1, 1.0), (2, 1e30), (2, 2.0))])
    stats = {r.job_id: r for r in summary.summarize_runs(jobs).collect()}
    assert stats[1].avg_runtime == (1e12 + 1) / 2 and stats[1].runtime_misfits == 0
    assert stats[2].avg_runtime == 5e29 and stats[2].runtime_misfits == 0
    cost = {r.job_id: r for r in costs.full_job_cost(jobs).collect()}
    assert cost[1].minutes == 1e12 + 1 and (cost[2].minutes, cost[2].runtime_misfits) == (1e30, 0)


def test_a_run_without_data_leaves_good_output_alone(spark, path):
    good = runs_of(spark, [run(1, 40), run(1, 50, 2)])
    run_advisor(spark, good, path("out"), batch_id=1)
    status = run_advisor(spark, good.limit(0), path("out"), batch_id=2).first()
    assert (status.status, status.error) == ("failed", "No job data loaded")
    assert spark.read.parquet(path("out") + "/analysis").count() == 1
    assert os.listdir(path("out") + "/history") == ["batch_id=1"]
    assert advise(spark, path("nowhere"), path("out"), 3).first().status == "failed"


LINES = [
    '1,"etl, ""daily""",{"cluster_config": {"num_workers": 3}},45,,,"INFO: a"',
    '2,"etl",,45,,,',
    '3,etl, daily,{"a": 1},45,,,',
    '4,x,not json,45,,,',
    '5,,"{""a"": 1}",45,,,',
]


def test_run_lines_are_split_only_where_they_can_be(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "line string")
    parsed = {r.job_id: (r.job_name, r.configuration) for r in run_log.parse_run_lines(lines).collect()}
    assert parsed == {
        1: ('etl, "daily"', '{"cluster_config": {"num_workers": 3}}'),
        2: ("etl", None),
        5: (None, '{"a": 1}'),
    }
    assert {r.line[0] for r in run_log.rejected_run_lines(lines).collect()} == {"3", "4"}
    assert rows(run_log.run_line_counts(lines)) == [(3, 2)]


def test_rows_without_nulls_win_a_lookup(spark):
    side = spark.createDataFrame([(1, None), (1, "NORTH"), (1, "SOUTH"), (2, None)], "k int, region string")
    fact = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(joins.lookup(fact, side, "k")) == [(1, "NORTH"), (2, None), (3, None)]
    assert rows(joins.repeated_keys(side, "k")) == [(1, 3)]


def test_a_run_without_a_start_is_not_the_first(spark):
    undated = (1, "undated", config(9), 10.0, None, None, "INFO: x")
    row = summary.analyze_runs(runs_of(spark, [undated, run(1, 10, name="dated"), run(1, 10, 2)])).first()
    assert (row.job_name, row.num_workers) == ("dated", 2)
    row = summary.analyze_runs(runs_of(spark, [undated, undated])).first()
    assert (row.job_name, row.num_workers) == ("undated", 9)


def test_filters_and_costs_ignore_what_is_no_number(spark):
    text = spark.createDataFrame([("1e9",), ("much",), ("NaN",), ("Infinity",), (None,)], "value string")
    assert business.high_value(text).count() == 1
    assert business.high_value(text.select(F.col("value").try_cast("double"))).count() == 1
    cost = costs.full_run_cost(runs_of(spark, [(1, "x", config(2), float("nan"), DAY, DAY, "")])).first()
    assert cost.run_cost is None


def test_the_day_is_a_circle_for_late_starts(spark):
    def at(job, *minutes):
        return [(job, "x", "", 1.0, dt.datetime(2024, 3, 1 + i, *divmod(m, 60)), None, "") for i, m in enumerate(minutes)]

    data = at(1, 1438, 3) + at(2, 60, 90, 75) + at(3, 5) + at(4, 0, 720) + [(5, "x", "", 1.0, None, None, "")]
    found = {r.job_id: tuple(r)[1:] for r in trends.late_starts(runs_of(spark, data)).collect()}
    assert found == {1: (1438, 3, 5), 2: (60, 90, 30), 3: (5, 5, 0), 4: (0, 720, 720), 5: (None, None, None)}


def test_quiet_jobs_have_no_warnings(spark):
    found = logs.warning_counts(runs_of(spark, [run(1, 1, output=None), run(2, 1, output="INFO: x"), run(3, 1, output=r"WARN: skew\nWARN: y")]))
    assert {r.job_id: r.warnings for r in found.collect()} == {1: 0, 2: 0, 3: 2}


def test_one_change_per_job(spark):
    suggestions = suggest(summary.analyze_runs(runs_of(spark, [run(1, 40), run(1, 50, 2)])))
    existing = spark.createDataFrame([(1, '{"b": 1}'), (1, '{"a": 1}'), (1, None)], "job_id long, content string")
    (request,) = changes.change_request(suggestions, existing).collect()
    assert request.config_action == "update" and '"a": 1' in request.config_content
    assert request.config_message == "Optimize configuration for job 1"
    assert request.hints_message == "Add optimization suggestions for job 1" and request.branch.startswith("optimize-job-1-")
    (created,) = changes.change_request(suggestions, existing.limit(0)).collect()
    assert created.config_message == "Add configuration for job 1"


def test_runs_left_out_by_the_stream_are_counted(spark, path):
    def files(*batches):
        for data in batches:
            runs_of(spark, data).coalesce(1).write.mode("append").parquet(path("runs"))

    undated = (1, "x", config(1), 5.0, None, None, "")
    files([run(1, 10, 1), undated], [run(1, 10, 20)], [run(1, 10, 21)], [run(1, 10, 2), run(1, 10, 1)])
    stream = monitor.read_run_stream(spark, path("runs"), files_per_trigger=1)
    monitor.monitor_daily(stream, path("days"), path("state")).awaitTermination()
    left_out = monitor.left_out_runs(spark.read.parquet(path("runs")), spark.read.parquet(path("days")))
    assert sorted((r.reason, r.runs) for r in left_out.collect()) == [("late", 1), ("late", 1), ("open", 1), ("open", 1), ("undated", 1)]


def test_scratch_tables_can_be_removed(spark):
    table = written(spark.range(5), "test")
    assert table.count() == 5
    folder = scratch_path(spark, "gone")
    spark.range(3).write.parquet(folder)
    remove(spark, folder)
    assert not os.path.exists(folder)
