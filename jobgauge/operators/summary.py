"""Per-job summary and severity."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgauge import rules as R
from jobgauge.functions.exact import Merged, exact_partials, exact_totals
from jobgauge.functions.numbers import decimal_avg, decimal_misfits, finite_number, misfits
from jobgauge.functions.runs import config_fields, matching_patterns


def prepare_runs(runs: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The columns the summary needs; rows without a job drop out.

    Logs are searched here, so only the few matches of a log, never its text, reach a shuffle.
    """
    return runs.filter(F.col("job_id").isNotNull()).select(
        "job_id",
        "job_name",
        finite_number(F.col("runtime_minutes")).alias("runtime_minutes"),
        "start_time",
        *tiebreak,
        "configuration",
        matching_patterns(F.col("output"), rules.error_patterns).alias("errors"),
    )


def window_runtime_columns() -> list[Column]:
    """Runtimes of a stream's window, which can be aggregated only once: the average goes through a wide decimal."""
    minutes = F.col("runtime_minutes")
    return [
        F.count(F.lit(1)).alias("runs"),
        decimal_avg(minutes).alias("avg_runtime"),
        F.max(minutes).alias("max_runtime"),
        F.min(minutes).alias("min_runtime"),
        decimal_misfits(minutes).alias("runtime_misfits"),
    ]


def _runtime_aggregates() -> dict[str, Merged]:
    minutes = F.col("runtime_minutes")
    return {
        "runs": (F.count(F.lit(1)), F.sum),
        "max_runtime": (F.max(minutes), F.max),
        "min_runtime": (F.min(minutes), F.min),
        "runtime_misfits": (misfits(minutes), F.sum),
    }


def _boundary_aggregates(tiebreak: Sequence[str]) -> dict[str, Merged]:
    first, latest = _boundaries(tiebreak)
    return {"_first": (F.min(first), F.min), "_latest": (F.max(latest), F.max)}


def runtimes_per_job(prepared: DataFrame) -> DataFrame:
    """One row per job: run count, average, largest and smallest runtime, and runtimes that are no number."""
    return _merged(exact_partials(prepared, ["job_id"], {"_total": F.col("runtime_minutes")}, _runtime_aggregates()), ())


def _merged(partials: DataFrame, tiebreak: Sequence[str] | None) -> DataFrame:
    others = _runtime_aggregates()
    if "_first" in partials.columns:
        others |= _boundary_aggregates(tiebreak)
    merged = exact_totals(partials, ["job_id"], ["_total"], others)
    average = F.col("_total") / F.nullif("_total_count", F.lit(0))
    runtimes = [F.col("runs"), average.alias("avg_runtime"), *map(F.col, ("max_runtime", "min_runtime", "runtime_misfits"))]
    names = []
    if "_first" in partials.columns:
        names = [F.col("_first.job_name"), F.col("_latest.configuration"), F.col("_latest.errors")]
    return merged.select("job_id", *runtimes, *names)


def _boundaries(tiebreak: Sequence[str]) -> tuple[Column, Column]:
    order = ["start_time", *tiebreak]
    return (
        F.struct(F.col("start_time").isNull().alias("undated"), *order, "job_name"),
        F.struct(*order, "configuration", "errors"),
    )


def boundary_columns(tiebreak: Sequence[str] = ()) -> list[Column]:
    """First name, latest configuration and latest errors by (start_time, tiebreak); a run without a start is neither,
    unless no run has one.

    The values end the ordering struct, so ties left by the order columns resolve the same way in every run.
    """
    first, latest = _boundaries(tiebreak)
    first, latest = F.min(first), F.max(latest)
    return [
        first["job_name"].alias("job_name"),
        latest["configuration"].alias("configuration"),
        latest["errors"].alias("errors"),
    ]


def summarize_runs(
    runs: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per job: run count, runtimes, first name, latest configuration and errors.

    One shuffle of partial rows, one per task, job and bin of its runtimes, and another one of the few rows per job."""
    return merge_summaries(partial_summaries(runs, rules, tiebreak), tiebreak)


def partial_summaries(
    runs: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Summaries that `merge_summaries` puts together: one row per job and bin of its runtimes, also of a stream."""
    aggregates = _runtime_aggregates() | _boundary_aggregates(tiebreak)
    return exact_partials(prepare_runs(runs, rules, tiebreak), ["job_id"], {"_total": F.col("runtime_minutes")}, aggregates)


def merge_summaries(partials: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    return _merged(partials, tiebreak)


def with_min_history(summary: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS) -> DataFrame:
    return summary.filter(F.col("runs") >= rules.min_runs)


def runtime_reason(rules: R.AdvisorRules = R.ADVISOR_DEFAULTS) -> Column:
    """Which runtime rule fires. NULL runtimes fire none."""
    average = F.col("avg_runtime")
    return (
        F.when(average > rules.high_minutes, F.lit("long_running"))
        .when(F.col("max_runtime") > average * F.lit(rules.spike_ratio), F.lit("skew"))
        .otherwise(F.lit("acceptable"))
    )


def by_reason(long_running, skew, otherwise) -> Column:
    reason = F.col("reason")
    return F.when(reason == "long_running", long_running).when(reason == "skew", skew).otherwise(otherwise)


def classify(summary: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS) -> DataFrame:
    """Add reason and severity from the runtimes alone."""
    severity = by_reason(F.lit("HIGH"), F.lit("MEDIUM"), F.lit("LOW"))
    return summary.withColumn("reason", runtime_reason(rules)).withColumn("severity", severity)


def analyze_summary(summary: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS) -> DataFrame:
    """Analysis rows from the output of summarize_runs."""
    rated = classify(with_min_history(summary, rules), rules)
    rated = rated.withColumn("config", config_fields(F.col("configuration")))
    readable = F.col("config.readable")
    few_workers = (F.col("avg_runtime") > rules.high_minutes) & (F.col("config.num_workers") < rules.worker_limit)
    failed = readable & (F.col("errors") != "")
    text = by_reason(F.lit(R.LONG_RUNNING_TEXT), F.lit(R.SKEW_TEXT), F.lit(R.ACCEPTABLE_TEXT))
    fix_errors = F.concat(F.lit(R.FIX_ERRORS_SUFFIX), "errors")
    return rated.select(
        "job_id",
        "job_name",
        "avg_runtime",
        "max_runtime",
        "min_runtime",
        "config.driver_size",
        "config.worker_size",
        "config.num_workers",
        F.concat(
            text,
            F.when(readable & few_workers, F.lit(R.MORE_WORKERS_SUFFIX)).otherwise(F.lit("")),
            F.when(failed, fix_errors).otherwise(F.lit("")),
        ).alias("recommendation"),
        F.when(failed, F.lit("HIGH")).otherwise(F.col("severity")).alias("severity"),
        "reason",
    )


def analyze_runs(
    runs: DataFrame, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS, tiebreak: Sequence[str] = ()
) -> DataFrame:
    return analyze_summary(summarize_runs(runs, rules, tiebreak), rules)


def configured_severity(
    summary: DataFrame, thresholds: R.ConfiguredThresholds = R.CONFIGURED_DEFAULTS
) -> DataFrame:
    """Severity by the two configured limits on the average, with the fixed worker step for HIGH jobs."""
    average = F.col("avg_runtime")
    severity = (
        F.when(average > thresholds.high_minutes, F.lit("HIGH"))
        .when(average > thresholds.medium_minutes, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )
    workers = config_fields(F.col("configuration"))["num_workers"]
    step = F.when(severity == "HIGH", F.lit(thresholds.worker_step)).otherwise(F.lit(0))
    return summary.select(
        "job_id",
        "avg_runtime",
        severity.alias("severity"),
        workers.alias("num_workers"),
        (workers + step).alias("suggested_workers"),
    )
