"""Queries over job runs: summary, rules, suggestions, outputs, history, streaming."""

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from jobgauge import rules as R
from jobgauge.functions.runs import config_fields, grown_workers, matching_patterns
from jobgauge.operators import advice, changes, costs, history, history_store, reports, summary, summary_store
from jobgauge.plans.advisor import publish_advisor
from jobgauge.sources.publish import published
from jobgauge.sources.scratch import moved, scratch_path
from jobgauge.sources.writers import write_table
from jobgauge.streaming import monitor
from workload.registry import query
from workload.views import RUN_RULES, as_runs, exact_sum_sql, runs, table, with_runs

TIEBREAK = ("run_id",)
CLUSTER = "driver_size, worker_size, num_workers"


def _summary(spark, sf_dir):
    return summary.summarize_runs(runs(spark, sf_dir), RUN_RULES, TIEBREAK)


def _analysis(spark, sf_dir):
    return summary.analyze_summary(_summary(spark, sf_dir), RUN_RULES)


def _suggestions(spark, sf_dir):
    return advice.suggest(_analysis(spark, sf_dir), RUN_RULES)


@query(with_runs("SELECT job_id, runs, avg_runtime, max_runtime, min_runtime FROM stats"))
def job_runtime_stats(spark, sf_dir):
    prepared = summary.prepare_runs(runs(spark, sf_dir), RUN_RULES)
    return summary.runtimes_per_job(prepared).drop("runtime_misfits")


@query(with_runs("SELECT job_id, runs FROM stats WHERE runs >= 67"))
def min_history(spark, sf_dir):
    prepared = summary.prepare_runs(runs(spark, sf_dir), RUN_RULES)
    counted = prepared.groupBy("job_id").agg(F.count(F.lit(1)).alias("runs"))
    return summary.with_min_history(counted, R.AdvisorRules(min_runs=67))


@query(with_runs("""
SELECT job_id, e.job_name, l.kind AS latest_worker_size, l.k AS latest_workers,
       array_to_string(l.errors, ', ') AS latest_errors
FROM earliest e JOIN latest l USING (job_id)
"""))
def first_last_per_job(spark, sf_dir):
    prepared = summary.prepare_runs(runs(spark, sf_dir), RUN_RULES, TIEBREAK)
    bounds = prepared.groupBy("job_id").agg(*summary.boundary_columns(TIEBREAK))
    config = config_fields(F.col("configuration"))
    return bounds.select(
        "job_id",
        "job_name",
        config["worker_size"].alias("latest_worker_size"),
        config["num_workers"].alias("latest_workers"),
        F.col("errors").alias("latest_errors"),
    )


# The documents of clicks are cut short and those of views hold no cluster, to reach the defaults.
@query(with_runs("""
SELECT run_id, kind <> 'click' AS readable,
       CASE WHEN kind IN ('click', 'view') THEN 'unknown' ELSE kind || '_driver' END AS driver_size,
       CASE WHEN kind IN ('click', 'view') THEN 'unknown' ELSE kind END AS worker_size,
       CASE WHEN kind IN ('click', 'view') THEN 0 ELSE k END AS num_workers
FROM runs
"""))
def config_extract(spark, sf_dir):
    name, whole = F.col("job_name"), F.col("configuration")
    configuration = (
        F.when(name == "click_job", F.substring_index(whole, "}", 1))
        .when(name == "view_job", F.lit("{}"))
        .otherwise(whole)
    )
    config = runs(spark, sf_dir).select("run_id", config_fields(configuration).alias("config"))
    return config.select("run_id", "config.*")


@query(with_runs("SELECT run_id, array_to_string(errors, ', ') AS errors_found FROM runs"))
def error_patterns(spark, sf_dir):
    found = matching_patterns(F.col("output"), RUN_RULES.error_patterns)
    return runs(spark, sf_dir).select("run_id", found.alias("errors_found"))


@query(with_runs("""
SELECT job_id, reason,
       CASE reason WHEN 'long_running' THEN 'HIGH' WHEN 'skew' THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM rated
"""))
def severity_rules(spark, sf_dir):
    prepared = summary.prepare_runs(runs(spark, sf_dir), RUN_RULES)
    stats = summary.runtimes_per_job(prepared)
    rated = summary.classify(summary.with_min_history(stats, RUN_RULES), RUN_RULES)
    return rated.select("job_id", "reason", "severity")


JOB_ANALYSIS_SQL = with_runs("SELECT * FROM analysis")


@query(JOB_ANALYSIS_SQL)
def job_analysis(spark, sf_dir):
    return _analysis(spark, sf_dir)


@query(JOB_ANALYSIS_SQL)
def job_analysis_stored(spark, sf_dir):
    """The analysis from the stored summaries of three batches, which share jobs."""
    table_name, path = f"summaries_{uuid.uuid4().hex}", scratch_path(spark, "summaries")
    for batch in range(3):
        arrived = runs(spark, sf_dir).filter(F.col("run_id") % 3 == batch)
        summary_store.store_summaries(arrived, table_name, path, 8, RUN_RULES, TIEBREAK)
    return summary_store.stored_analysis(spark, table_name, RUN_RULES, TIEBREAK)


@query(with_runs("""
SELECT job_id, num_workers, greatest(2, trunc(num_workers * 1.5::double)::int) AS grown_workers FROM analysis
"""))
def resize_plan(spark, sf_dir):
    grown = grown_workers(F.col("num_workers"), RUN_RULES.worker_growth, RUN_RULES.worker_floor)
    return _analysis(spark, sf_dir).select("job_id", "num_workers", grown.alias("grown_workers"))


SUGGESTION_SQL = f"""
job_id, job_name, {CLUSTER}, driver_size AS suggested_driver_size, worker_size AS suggested_worker_size,
suggested_num_workers, recommendation, severity, severity_rank, avg_runtime,
array_to_string(code_changes, '|') AS code_changes
"""


def _flat(suggestions):
    return suggestions.select(
        "job_id",
        "job_name",
        *[F.col(f"current_config.{name}") for name in CLUSTER.split(", ")],
        *[F.col(f"suggested_config.{name}").alias(f"suggested_{name}") for name in CLUSTER.split(", ")],
        "recommendation",
        "severity",
        "severity_rank",
        "avg_runtime",
        F.array_join("code_changes", "|").alias("code_changes"),
    )


@query(with_runs(f"SELECT {SUGGESTION_SQL} FROM suggestions"))
def suggestions(spark, sf_dir):
    return _flat(_suggestions(spark, sf_dir))


@query(with_runs("""
SELECT job_id, job_name, recommendation, severity, avg_runtime, suggested_num_workers::double AS suggested_num_workers
FROM (SELECT DISTINCT c_custkey AS job_id FROM customer) LEFT JOIN suggestions USING (job_id)
"""))
def suggestions_for_jobs(spark, sf_dir):
    """Requested jobs come from customer keys; most have no suggestion."""
    requested = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job_id"))
    found = advice.suggestions_for(_suggestions(spark, sf_dir), requested)
    workers = F.col("suggested_config.num_workers").cast("double").alias("suggested_num_workers")
    return found.select("job_id", "job_name", "recommendation", "severity", "avg_runtime", workers)


@query(with_runs("SELECT job_id, job_name, severity, severity_rank, avg_runtime FROM suggestions"))
def prioritized_jobs(spark, sf_dir):
    columns = ["job_id", "job_name", "severity", "severity_rank", "avg_runtime"]
    return advice.prioritized(_suggestions(spark, sf_dir).select(*columns))


@query(with_runs("""
SELECT job_id, job_name, severity, avg_runtime, suggested_num_workers
FROM suggestions ORDER BY severity_rank, avg_runtime DESC, job_id LIMIT 1
"""))
def top_priority_job(spark, sf_dir):
    top = advice.top_priority(_suggestions(spark, sf_dir))
    workers = F.col("suggested_config.num_workers").alias("suggested_num_workers")
    return top.select("job_id", "job_name", "severity", "avg_runtime", workers)


COST_SQL = "num_workers * avg_runtime / 60 * 0.5::double"


@query(with_runs(f"SELECT job_id, job_name, {COST_SQL} AS cost_estimate FROM analysis"))
def job_cost(spark, sf_dir):
    return reports.chart_cost(_analysis(spark, sf_dir), RUN_RULES)


@query(with_runs(f"""
SELECT job_id, runs, minutes, worker_minutes, runtime_misfits, (worker_minutes * 0.5::double + minutes * 0.7::double) / 60 AS total_cost
FROM (
    SELECT job_id, count(*) AS runs, {exact_sum_sql('runtime_minutes')} AS minutes, 0::bigint AS runtime_misfits,
           {exact_sum_sql('runtime_minutes * k')} AS worker_minutes
    FROM runs GROUP BY job_id
)
"""))
def job_cost_full(spark, sf_dir):
    return costs.full_job_cost(runs(spark, sf_dir))


@query(with_runs("""
SELECT run_id, k AS num_workers, (k * 0.5::double + 0.7::double) * runtime_minutes / 60 AS run_cost FROM runs
"""))
def run_cost_full(spark, sf_dir):
    return costs.full_run_cost(runs(spark, sf_dir)).select("run_id", "num_workers", "run_cost")


@query(with_runs("""
SELECT job_id, avg_runtime,
       CASE WHEN avg_runtime > 53 THEN 'HIGH' WHEN avg_runtime > 47 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       k AS num_workers, k + CASE WHEN avg_runtime > 53 THEN 2 ELSE 0 END AS suggested_workers
FROM rated
"""))
def severity_configured(spark, sf_dir):
    thresholds = R.ConfiguredThresholds(high_minutes=53.0, medium_minutes=47.0)
    return summary.configured_severity(summary.with_min_history(_summary(spark, sf_dir), RUN_RULES), thresholds)


@query(with_runs(f"""
SELECT job_id, {COST_SQL} AS current_cost, {COST_SQL} * (1 - 15.0::double / 100) AS target_cost FROM analysis
"""))
def cost_target(spark, sf_dir):
    return costs.cost_target(costs.job_cost(_analysis(spark, sf_dir), RUN_RULES))


@query(with_runs("SELECT job_id, job_name, avg_runtime FROM analysis"))
def chart_runtime(spark, sf_dir):
    return reports.chart_runtime(_analysis(spark, sf_dir))


@query(with_runs("SELECT job_id, job_name, num_workers, avg_runtime FROM analysis"))
def chart_scatter(spark, sf_dir):
    return reports.chart_scatter(_analysis(spark, sf_dir))


@query(with_runs("""
SELECT count(*) AS jobs, count(*) FILTER (WHERE severity = 'HIGH') AS high_priority,
       count(*) FILTER (WHERE severity = 'MEDIUM') AS medium_priority
FROM analysis
"""))
def report_summary(spark, sf_dir):
    return reports.report_summary(_analysis(spark, sf_dir))


@query(with_runs("""
SELECT job_id, job_name, printf('%.1f', avg_runtime) AS avg_runtime_text, num_workers, severity, recommendation
FROM analysis
"""))
def report_job_table(spark, sf_dir):
    return reports.report_job_table(_analysis(spark, sf_dir))


@query(with_runs(f"""
SELECT job_id, job_name, severity, {CLUSTER}, driver_size AS suggested_driver_size,
       worker_size AS suggested_worker_size, suggested_num_workers, code_changes[change_no + 1] AS code_change
FROM (
    SELECT *, unnest(CASE WHEN len(code_changes) = 0 THEN [NULL] ELSE range(len(code_changes)) END)::int AS change_no
    FROM suggestions
)
"""))
def report_details(spark, sf_dir):
    return reports.report_details(_suggestions(spark, sf_dir)).drop("change_no")


@query("""
SELECT 'completed' AS status, count(*) AS suggestions, NULL::varchar AS error
FROM (SELECT user_id FROM events GROUP BY user_id HAVING count(*) >= 2)
""")
def advisor_status(spark, sf_dir):
    return reports.advisor_status(runs(spark, sf_dir), _analysis(spark, sf_dir))


def _existing_configs(spark, sf_dir):
    """A document per job from its first run: one with further keys, one without cluster, one malformed, or none."""
    first = F.min(F.struct("start_time", "run_id", "job_name"))["job_name"]
    named = runs(spark, sf_dir).groupBy("job_id").agg(first.alias("name"))
    content = (
        F.when(F.col("name") == "click_job", '{"owner": "é", "cluster_config": {"num_workers": 1, "zone": 1.50}, "tags": []}')
        .when(F.col("name") == "view_job", '{"retries": 3}')
        .when(F.col("name") == "error_job", '{"cluster_config": ')
    )
    return named.select("job_id", content.alias("content")).filter(F.col("content").isNotNull())


@query(with_runs(r"""
, sized AS (
    SELECT *, '{
    "driver_node_type_id": "' || driver_size || '",
    "node_type_id": "' || worker_size || '",
    "num_workers": ' || suggested_num_workers || '
  }' AS cluster FROM suggestions
)
SELECT job_id, 'jobs/' || job_id || '/job_config.json' AS path, suggested_num_workers AS num_workers,
       CASE WHEN job_name IN ('click_job', 'view_job') THEN 'update' ELSE 'create' END AS action,
       CASE job_name
       WHEN 'click_job' THEN '{
  "owner": "\u00e9",
  "cluster_config": {
    "num_workers": ' || suggested_num_workers || ',
    "zone": 1.5
  },
  "tags": []
}'
       WHEN 'view_job' THEN '{
  "retries": 3,
  "cluster_config": ' || cluster || '
}'
       ELSE '{
  "job_id": ' || job_id || ',
  "job_name": "' || job_name || '",
  "cluster_config": ' || cluster || '
}' END AS content
FROM sized
"""))
def config_changeset(spark, sf_dir):
    return changes.config_changeset(_suggestions(spark, sf_dir), _existing_configs(spark, sf_dir))


@query(with_runs("""
SELECT job_id, 'jobs/' || job_id || '/OPTIMIZATIONS.md' AS path,
       '# Optimization Suggestions for ' || job_name || chr(10) || chr(10) || '## Suggested Code Changes'
       || chr(10) || chr(10) || array_to_string(list_transform(code_changes, lambda c: '- ' || c || chr(10)), '') AS content
FROM suggestions WHERE len(code_changes) > 0
"""))
def hints_docs(spark, sf_dir):
    return changes.hints_documents(_suggestions(spark, sf_dir))


@query(with_runs("""
SELECT job_id, 'Optimize job ' || job_name || ' (ID: ' || job_id || ')' AS title, array_to_string([
    '# Job Optimization PR', '',
    'This PR contains suggested optimizations for job **' || job_name || '**.', '',
    '## Current Configuration', '- Driver Size: ' || driver_size, '- Worker Size: ' || worker_size,
    '- Workers: ' || num_workers, '',
    '## Suggested Configuration', '- Driver Size: ' || driver_size, '- Worker Size: ' || worker_size,
    '- Workers: ' || suggested_num_workers, '',
    '## Recommendation', recommendation, '',
    '## Performance Analysis', '- Average Runtime: ' || printf('%.1f', avg_runtime) || ' minutes',
    '- Priority: ' || severity], chr(10)) AS body
FROM suggestions
"""))
def change_descriptions(spark, sf_dir):
    return changes.change_descriptions(_suggestions(spark, sf_dir))


JOB_TABLES = (
    "analysis", "suggestions", "report_jobs", "chart_runtime", "chart_scatter", "chart_cost", "change_descriptions", "history",
)


@query(with_runs(f"""
, top AS (SELECT job_id FROM suggestions ORDER BY severity_rank, avg_runtime DESC, job_id LIMIT 1)
SELECT unnest({list(JOB_TABLES)}) AS output, job_id::varchar AS label, 1::bigint AS row_count FROM analysis
UNION ALL SELECT 'config_changes', 'create', count(*) FROM analysis
UNION ALL SELECT 'hint_documents', job_id::varchar, 1 FROM suggestions WHERE len(code_changes) > 0
UNION ALL SELECT 'report_details', job_id::varchar, greatest(1, len(code_changes)) FROM suggestions
UNION ALL SELECT unnest(['top_priority', 'top_change_request']), job_id::varchar, 1 FROM top
UNION ALL SELECT 'report_summary', 'HIGH', count(*) FROM analysis WHERE severity = 'HIGH'
UNION ALL SELECT 'status', 'completed', count(*) FROM analysis
UNION ALL SELECT 'status without runs', 'failed', NULL
"""))
def advisor_run(spark, sf_dir):
    """The whole advisor job, checked by the rows of all its tables, after a second run that found no data."""
    path = scratch_path(spark, "advisor")
    status = publish_advisor(spark, runs(spark, sf_dir), path, batch_id=1, rules=RUN_RULES, tiebreak=TIEBREAK)

    def rows_of(name, label):
        rows = spark.read.parquet(paths[name]).groupBy(label.alias("label"))
        return rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("output"), "label", "row_count")

    failed = publish_advisor(spark, runs(spark, sf_dir).limit(0), path, batch_id=2, rules=RUN_RULES, tiebreak=TIEBREAK)
    paths = published(spark, path) | {"history": f"{path}/history"}
    written = rows_of("config_changes", F.col("action"))
    for name in (*JOB_TABLES, "hint_documents", "report_details", "top_priority", "top_change_request"):
        written = written.union(rows_of(name, F.col("job_id").cast("string")))
    summed = spark.read.parquet(paths["report_summary"])
    written = written.union(summed.select(F.lit("report_summary"), F.lit("HIGH"), "high_priority"))
    written = written.union(status.select(F.lit("status"), "status", "suggestions"))
    return written.union(failed.select(F.lit("status without runs"), "status", "suggestions"))


@query(f"""
WITH span AS (SELECT date_trunc('day', min(ts))::date AS first, date_trunc('day', max(ts))::date AS last FROM events),
cuts AS (
    SELECT unnest([first + (last - first)::int // 3 + 1, first + (last - first)::int * 2 // 3 + 1, last + 1])::date AS cut
    FROM span
),
snapshots AS (
    SELECT cut, user_id AS job_id, {exact_sum_sql('value')} / count(value) AS avg_runtime, max(value) AS peak
    FROM cuts JOIN events ON ts < cut GROUP BY cut, user_id HAVING count(*) >= 2
)
SELECT job_id, count(*) AS snapshots, min(cut)::timestamp AS first_ts, max(cut)::timestamp AS last_ts,
       arg_min(avg_runtime, cut) AS first_avg_runtime, arg_max(avg_runtime, cut) AS last_avg_runtime,
       arg_max(avg_runtime, cut) - arg_min(avg_runtime, cut) AS change
FROM snapshots GROUP BY job_id
""")
def history_rollup(spark, sf_dir):
    """Analyses after a third, two thirds and all of the days, each over the runs so far, appended to a history."""
    path = scratch_path(spark, "history")
    first, last = runs(spark, sf_dir).agg(F.to_date(F.min("start_time")), F.to_date(F.max("start_time"))).first()
    days = (last - first).days
    for batch_id, day in enumerate((days // 3, days * 2 // 3, days)):
        cut = first + dt.timedelta(days=day + 1)
        so_far = runs(spark, sf_dir).filter(F.col("start_time") < F.lit(cut))
        analysis = summary.analyze_runs(so_far, RUN_RULES, TIEBREAK)
        history.append_history(analysis, path, batch_id, F.lit(cut))
    rolled = history.history_rollup(history.read_history(spark, path)).drop("recommendation")
    return rolled.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


@query(f"""
WITH span AS (SELECT min(ts)::date AS first, max(ts)::date AS last FROM events),
cuts AS (SELECT (first + 1 + ((last - first) * i // 4)::int)::date AS cut FROM span, range(5) AS steps(i)),
snapshots AS (
    SELECT cut, user_id AS job_id, {exact_sum_sql('value')} / count(value) AS avg_runtime
    FROM cuts JOIN events ON ts < cut GROUP BY cut, user_id HAVING count(*) >= 2
)
SELECT job_id, count(*) AS snapshots, min(cut)::timestamp AS first_ts, max(cut)::timestamp AS last_ts,
       arg_min(avg_runtime, cut) AS first_avg_runtime, arg_max(avg_runtime, cut) AS last_avg_runtime,
       arg_max(avg_runtime, cut) - arg_min(avg_runtime, cut) AS change
FROM snapshots GROUP BY job_id
""")
def history_compacted(spark, sf_dir):
    """Five growing snapshots, compacted after each in spans of two: the rollup of a merged span and an open batch."""
    path, store = scratch_path(spark, "history"), scratch_path(spark, "spans")
    first, last = runs(spark, sf_dir).agg(F.to_date(F.min("start_time")), F.to_date(F.max("start_time"))).first()
    for batch_id in range(5):
        cut = first + dt.timedelta(days=1 + (last - first).days * batch_id // 4)
        so_far = runs(spark, sf_dir).filter(F.col("start_time") < F.lit(cut))
        history.append_history(summary.analyze_runs(so_far, RUN_RULES, TIEBREAK), path, batch_id, F.lit(cut))
        history_store.compact_history(spark, path, store, fanout=2)
    rolled = history_store.compacted_rollup(spark, path, store).drop("recommendation")
    return rolled.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


def _run_streams(spark, sf_dir, path, groups=3):
    """The stream over the runs, each time that a group of files has arrived; groups follow each other in time.

    The table is written once. However few row groups it has, one shuffle deals its rows evenly over tasks, in stretches so
    that rows near each other stay so, and each task writes files for every group. Group by group is then moved to where the
    stream looks. Of the first day's runs every tenth comes in the last group.
    """
    events = table(spark, sf_dir, "events")
    by_day = Window.orderBy("day")
    share, first_day = F.ntile(groups).over(by_day) - 1, F.min("day").over(by_day)
    days = events.select(F.to_date("ts").alias("day")).distinct()
    days = days.select("day", share.alias("group"), first_day.alias("first_day"))
    placed = events.withColumn("day", F.to_date("ts")).join(F.broadcast(days), "day", "left")
    held_back = (F.col("day") == F.col("first_day")) & (F.col("event_id") % 10 == 0)
    group = F.when(held_back, groups - 1).otherwise(F.coalesce("group", F.lit(groups - 1)))
    stretch = F.floor(F.monotonically_increasing_id() / 16384)
    placed = placed.select(*events.columns, group.alias("group"), stretch.alias("_stretch"))
    dealt = placed.repartition("_stretch").drop("_stretch")
    write_table(dealt, f"{path}/coming", partition_by=["group"], max_records_per_file=250_000, rebalance=False)
    for group in range(groups):
        arrived = f"{path}/files/group={group}"
        if not moved(spark, f"{path}/coming/group={group}", arrived):
            spark.createDataFrame([], events.schema).write.parquet(arrived)
        yield as_runs(monitor.read_run_stream(spark, f"{path}/files/*", events.schema))


@query(with_runs("SELECT job_id, avg_runtime, recommendation FROM analysis"))
def monitor_stream(spark, sf_dir):
    """The last snapshot a stream over the run files leaves in the history."""
    path = scratch_path(spark, "monitor")
    partitions = spark.sparkContext.defaultParallelism
    for stream in _run_streams(spark, sf_dir, path):
        query = monitor.monitor_history(
            stream, f"{path}/history", f"{path}/state", RUN_RULES, TIEBREAK, state_partitions=partitions
        )
        query.awaitTermination()
    snapshots = history.read_history(spark, f"{path}/history")
    last = snapshots.agg(F.max("batch_id")).scalar()
    return snapshots.filter(F.col("batch_id") == last).select("job_id", "avg_runtime", "recommendation")


@query(with_runs("""
SELECT job_id, date_trunc('day', start_time)::timestamp AS day_start, count(*) AS runs,
       sum(runtime_minutes::varchar::decimal(38,18))::varchar::double / count(runtime_minutes) AS avg_runtime,
       max(runtime_minutes) AS max_runtime, min(runtime_minutes) AS min_runtime
FROM runs
WHERE date_trunc('day', start_time) + INTERVAL 1 DAY <= (SELECT max(start_time) - INTERVAL 1 DAY FROM runs WHERE run_id % 50 <> 7)
  AND run_id % 50 <> 7
  AND NOT (run_id % 10 = 0 AND date_trunc('day', start_time) = (SELECT min(date_trunc('day', start_time)) FROM runs))
GROUP BY ALL
"""))
def monitor_daily(spark, sf_dir):
    """The days a stream over the run files has closed; some runs are late and some have no start."""
    days, _ = _closed_days(spark, sf_dir)
    return days.withColumn("day_start", F.col("day_start").cast("timestamp_ntz")).drop("day_end", "runtime_misfits")


@query(with_runs("""
SELECT job_id, day_start, count(*) AS runs, reason
FROM (
    SELECT job_id, CASE WHEN run_id % 50 <> 7 THEN date_trunc('day', start_time)::timestamp END AS day_start,
           CASE WHEN run_id % 50 = 7 THEN 'undated'
                WHEN date_trunc('day', start_time) + INTERVAL 1 DAY
                     > (SELECT max(start_time) - INTERVAL 1 DAY FROM runs WHERE run_id % 50 <> 7) THEN 'open'
                WHEN run_id % 10 = 0 AND date_trunc('day', start_time) = (SELECT min(date_trunc('day', start_time)) FROM runs)
                THEN 'late' END AS reason
    FROM runs
)
WHERE reason IS NOT NULL GROUP BY ALL
"""))
def monitor_left_out(spark, sf_dir):
    """The runs that the closed days do not hold."""
    days, arrived = _closed_days(spark, sf_dir)
    left_out = monitor.left_out_runs(arrived, days)
    return left_out.withColumn("day_start", F.col("day_start").cast("timestamp_ntz"))


def _closed_days(spark, sf_dir):
    def dated(rows):
        return rows.withColumn("start_time", F.when(F.col("run_id") % 50 != 7, F.col("start_time")))

    path = scratch_path(spark, "daily")
    partitions = spark.sparkContext.defaultParallelism
    for stream in _run_streams(spark, sf_dir, path):
        query = monitor.monitor_daily(dated(stream), f"{path}/days", f"{path}/state", state_partitions=partitions)
        query.awaitTermination()
    return spark.read.parquet(f"{path}/days"), dated(runs(spark, sf_dir))
