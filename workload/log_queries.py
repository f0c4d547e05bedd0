"""Queries over run logs: parsing, mining, trends."""

from pyspark.sql import functions as F

from jobgauge.operators import logs, trends
from jobgauge.sources.run_log import parse_run_lines, read_run_records, rejected_run_lines, run_line_counts
from jobgauge.sources.scratch import scratch_path
from workload.registry import query
from workload.views import runs, with_runs


def _run_lines(spark, sf_dir):
    """Runs rendered as lines with unquoted JSON; views have no configuration, signups no start that can be read.

    Clicks have a quoted name with a comma, purchases every other time an unquoted one, which cannot be split.
    """
    seconds = "yyyy-MM-dd HH:mm:ss"
    name = F.col("job_name")
    comma = (name == "purchase_job") & (F.col("run_id") % 2 == 0)
    shown = F.when(name == "click_job", F.lit('"click, ""fast"""')).when(comma, F.lit("purchase, job")).otherwise(name)
    start = F.when(name == "signup_job", F.lit("soon")).otherwise(F.date_format("start_time", seconds))
    fields = [
        F.col("job_id").cast("string"),
        shown,
        F.when(name == "view_job", F.lit("")).otherwise(F.col("configuration")),
        F.col("runtime_minutes").cast("decimal(18,2)").cast("string"),
        start,
        F.date_format("end_time", seconds),
        F.concat(F.lit('"'), "output", F.lit('"')),
    ]
    line = F.concat_ws(",", *fields)
    return runs(spark, sf_dir).select(line.alias("line"))


CONFIGURATION_SQL = """
'{"cluster_config": {"driver_node_type_id": "' || kind || '_driver", "node_type_id": "' || kind
|| '", "num_workers": ' || k || '}}'
"""


@query(with_runs(f"""
SELECT job_id, CASE WHEN kind = 'click' THEN 'click, "fast"' ELSE job_name END AS job_name,
       CASE WHEN kind <> 'view' THEN {CONFIGURATION_SQL} END AS configuration, runtime_minutes,
       date_trunc('second', start_time) AS start_time, date_trunc('second', end_time) AS end_time,
       array_to_string(log_list, '\\n') AS output
FROM runs WHERE kind <> 'signup' AND NOT (kind = 'purchase' AND run_id % 2 = 0)
"""))
def job_runs_parse(spark, sf_dir):
    parsed = parse_run_lines(_run_lines(spark, sf_dir))
    return parsed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


@query(with_runs(f"""
SELECT job_id || ',' || CASE WHEN kind = 'purchase' THEN 'purchase, job' ELSE job_name END || ',' || {CONFIGURATION_SQL} || ','
       || runtime_minutes::decimal(18,2) || ','
       || CASE WHEN kind = 'signup' THEN 'soon' ELSE strftime(start_time, '%Y-%m-%d %H:%M:%S') END || ','
       || strftime(end_time, '%Y-%m-%d %H:%M:%S') || ',"' || array_to_string(log_list, '\\n') || '"' AS line
FROM runs WHERE kind = 'signup' OR (kind = 'purchase' AND run_id % 2 = 0)
"""))
def job_runs_rejected(spark, sf_dir):
    return rejected_run_lines(_run_lines(spark, sf_dir))


@query("""
SELECT count(*) FILTER (NOT rejected) AS parsed, count(*) FILTER (rejected) AS rejected
FROM (SELECT event_type = 'signup' OR (event_type = 'purchase' AND event_id % 2 = 0) AS rejected FROM events)
""")
def job_run_line_counts(spark, sf_dir):
    return run_line_counts(_run_lines(spark, sf_dir))


def _broken_log(spark, sf_dir):
    """The run log as files in which every real line of an output is a line of the file."""
    path = scratch_path(spark, "run-log")
    lines = _run_lines(spark, sf_dir).select(F.replace("line", F.lit(r"\n"), F.lit("\n")).alias("value"))
    lines.write.text(path)
    return read_run_records(spark, path)


@query(with_runs(f"""
SELECT job_id, CASE WHEN kind = 'click' THEN 'click, "fast"' ELSE job_name END AS job_name,
       CASE WHEN kind <> 'view' THEN {CONFIGURATION_SQL} END AS configuration, runtime_minutes,
       date_trunc('second', start_time) AS start_time, date_trunc('second', end_time) AS end_time,
       array_to_string(log_list, chr(10)) AS output
FROM runs WHERE kind <> 'signup' AND NOT (kind = 'purchase' AND run_id % 2 = 0)
"""))
def job_runs_over_lines(spark, sf_dir):
    """Runs whose outputs hold real line breaks."""
    parsed = _broken_log(spark, sf_dir).runs
    return parsed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")})


@query(with_runs(f"""
SELECT unnest(string_split(job_id || ',' || CASE WHEN kind = 'purchase' THEN 'purchase, job' ELSE job_name END || ',' || {CONFIGURATION_SQL} || ','
       || runtime_minutes::decimal(18,2) || ','
       || CASE WHEN kind = 'signup' THEN 'soon' ELSE strftime(start_time, '%Y-%m-%d %H:%M:%S') END || ','
       || strftime(end_time, '%Y-%m-%d %H:%M:%S') || ',"' || array_to_string(log_list, chr(10)) || '"', chr(10))) AS line
FROM runs WHERE kind = 'signup' OR (kind = 'purchase' AND run_id % 2 = 0)
"""))
def job_lines_rejected(spark, sf_dir):
    """The lines of runs over several lines that do not parse."""
    return _broken_log(spark, sf_dir).rejected


LINES_SQL = r"""
, lines AS (
    SELECT run_id, job_id, generate_subscripts(log_list, 1)::int - 1 AS line_no, unnest(log_list) AS line FROM runs
), mined AS (
    SELECT run_id, job_id, line_no, split_part(line, ': ', 1) AS level,
           substr(line, length(split_part(line, ': ', 1)) + 3) AS message
    FROM lines
)
"""


@query(with_runs(f"{LINES_SQL} SELECT run_id, job_id, line_no, level, message FROM mined"))
def log_lines(spark, sf_dir):
    return logs.log_lines(runs(spark, sf_dir), keep=("run_id",)).drop("start_time")


@query(with_runs(f"""{LINES_SQL}
SELECT job_id, count(*) FILTER (loud) AS warnings,
       count(*) FILTER (WHERE loud AND message LIKE '%executor scheduling%') AS scheduling_delay,
       count(*) FILTER (WHERE loud AND message LIKE '%cartesian join%') AS cartesian_join,
       count(*) FILTER (WHERE loud AND message LIKE '%skew%') AS skew,
       count(*) FILTER (WHERE loud AND message LIKE '%Shuffle spill%') AS shuffle_spill
FROM (SELECT *, level = 'WARN' AND job_id % 3 <> 0 AS loud FROM mined) GROUP BY job_id
"""))
def log_warning_counts(spark, sf_dir):
    """Every third job is quiet: it keeps the first line of its logs only."""
    quiet = F.when(F.col("job_id") % 3 == 0, F.substring_index("output", "\\n", 1)).otherwise(F.col("output"))
    return logs.warning_counts(runs(spark, sf_dir).withColumn("output", quiet))


METRICS_SQL = """
, metrics AS (
    SELECT run_id, job_id, start_time, runtime_minutes, (run_id * 37 + 1000)::bigint AS rows_processed,
           k::bigint AS distinct_categories,
           CASE WHEN kind = 'purchase' THEN runtime_minutes END AS spill_memory_gb,
           CASE WHEN kind = 'purchase' THEN 1.5::double END AS spill_disk_gb
    FROM runs
)
"""


@query(with_runs(f"""{METRICS_SQL}
SELECT run_id, job_id, rows_processed, distinct_categories, spill_memory_gb, spill_disk_gb FROM metrics
"""))
def log_metrics(spark, sf_dir):
    return logs.log_metrics(runs(spark, sf_dir), keep=("run_id",)).drop("start_time")


@query(with_runs("""
SELECT run_id, job_id, runtime_minutes, elapsed_minutes, elapsed_minutes - runtime_minutes AS gap_minutes
FROM (SELECT *, datesub('minute', start_time, end_time) AS elapsed_minutes FROM runs)
"""))
def duration_check(spark, sf_dir):
    return trends.duration_check(runs(spark, sf_dir), keep=("run_id",)).drop("start_time")


@query(with_runs("""
SELECT job_id, arg_max(m, wide)::int AS earliest_minute, arg_max(before, wide)::int AS latest_minute, (1440 - max(gap))::int AS late_minutes
FROM (
    SELECT job_id, m, coalesce(before, last) AS before, gap, gap * 10000 + CASE WHEN before IS NULL THEN 9999 ELSE 5000 - m END AS wide
    FROM (
        SELECT *, CASE WHEN before IS NULL THEN m + 1440 - last ELSE m - before END AS gap
        FROM (
            SELECT job_id, m, lag(m) OVER (PARTITION BY job_id ORDER BY m) AS before, max(m) OVER (PARTITION BY job_id) AS last
            FROM (SELECT DISTINCT job_id, hour(start_time) * 60 + minute(start_time) AS m FROM runs)
        )
    )
) GROUP BY job_id
"""))
def late_starts(spark, sf_dir):
    return trends.late_starts(runs(spark, sf_dir))


@query(with_runs(f"""{METRICS_SQL}
, rated_runs AS (
    SELECT *, CASE WHEN runtime_minutes > 0 THEN rows_processed / runtime_minutes END AS rows_per_minute FROM metrics
)
SELECT run_id, job_id, rows_per_minute, previous_rows_per_minute, rows_per_minute - previous_rows_per_minute AS change
FROM (
    SELECT *, lag(rows_per_minute) OVER (PARTITION BY job_id ORDER BY start_time, run_id) AS previous_rows_per_minute
    FROM rated_runs
)
"""))
def throughput_trend(spark, sf_dir):
    return trends.throughput_trend(runs(spark, sf_dir), ("run_id",)).drop("start_time")
