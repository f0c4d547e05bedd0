"""Job-run advisor: analysis, suggestions and all output tables."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgauge import rules as R
from jobgauge.operators import changes, reports
from jobgauge.operators.advice import prioritized, suggest, top_priority
from jobgauge.operators.history import append_history
from jobgauge.operators.summary import analyze_runs
from jobgauge.sources.publish import publish_tables
from jobgauge.sources.run_log import read_run_log
from jobgauge.sources.writers import write_table, write_tables


#: Tables of one run of the advisor, without the history.
TABLES = (
    "analysis", "suggestions", "top_priority", "report_summary", "report_jobs", "report_details", "chart_runtime",
    "chart_scatter", "chart_cost", "config_changes", "hint_documents", "change_descriptions", "top_change_request",
)


def advisor_tables(
    analysis: DataFrame, existing_configs: DataFrame | None = None, rules: R.AdvisorRules = R.ADVISOR_DEFAULTS
) -> dict[str, DataFrame]:
    """Every table the advisor offers, by name."""
    suggestions = suggest(analysis, rules)
    if existing_configs is None:
        existing_configs = analysis.sparkSession.createDataFrame([], "job_id bigint, content string")
    return {
        "suggestions": prioritized(suggestions),
        "top_priority": top_priority(suggestions),
        "report_summary": reports.report_summary(analysis),
        "report_jobs": reports.report_job_table(analysis),
        "report_details": reports.report_details(suggestions),
        "chart_runtime": reports.chart_runtime(analysis),
        "chart_scatter": reports.chart_scatter(analysis),
        "chart_cost": reports.chart_cost(analysis, rules),
        "config_changes": changes.config_changeset(suggestions, existing_configs),
        "hint_documents": changes.hints_documents(suggestions),
        "change_descriptions": changes.change_descriptions(suggestions),
        "top_change_request": changes.change_request(top_priority(suggestions), existing_configs),
    }


def run_advisor(
    spark: SparkSession,
    runs: DataFrame,
    output_path: str,
    batch_id: int,
    existing_configs: DataFrame | None = None,
    rules: R.AdvisorRules = R.ADVISOR_DEFAULTS,
    tiebreak: Sequence[str] = (),
    history_path: str | None = None,
) -> DataFrame:
    """Write the analysis, every table derived from it and a history snapshot; return the status row with their place.

    The runs are aggregated once; all other tables read the written analysis, which holds one row per job. Without any
    run nothing is written: earlier output and history stay as they are, and the status is failed. The history is a folder
    of the output unless `history_path` names another.
    """
    if runs.isEmpty():
        return reports.failed_status(spark).withColumn("output_path", F.lit(None).cast("string"))
    analysis_path = f"{output_path}/analysis"
    computed = analyze_runs(runs, rules, tiebreak)
    write_table(computed, analysis_path)
    analysis = spark.read.schema(computed.schema).parquet(analysis_path)
    tables = advisor_tables(analysis, existing_configs, rules)
    write_tables({f"{output_path}/{name}": table for name, table in tables.items()})
    append_history(analysis, history_path or f"{output_path}/history", batch_id)
    return reports.advisor_status(runs, analysis).withColumn("output_path", F.lit(output_path))


def publish_advisor(spark: SparkSession, runs: DataFrame, base_path: str, batch_id: int, **options) -> DataFrame:
    """`run_advisor` with its tables published together below `base_path`; see `sources.publish.published`.

    The history is shared by all versions. Its snapshot is written after the tables and before they are published, so a run
    that failed in between is made good by repeating its batch, which replaces the snapshot.
    """
    status = []

    def write(folder: str) -> Sequence[str]:
        status.append(run_advisor(spark, runs, folder, batch_id, history_path=f"{base_path}/history", **options))
        done = status[0].filter("output_path IS NOT NULL")
        return () if done.isEmpty() else TABLES

    publish_tables(spark, base_path, write)
    return status[0]


def advise(spark: SparkSession, run_path: str, output_path: str, batch_id: int, **options) -> DataFrame:
    """`run_advisor` on the run log below `run_path`; where there is no such path, the status is failed."""
    try:
        runs = read_run_log(spark, run_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return reports.failed_status(spark).withColumn("output_path", F.lit(None).cast("string"))
    return run_advisor(spark, runs, output_path, batch_id, **options)
