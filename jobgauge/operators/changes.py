"""Configuration changes, hint documents and change descriptions, one row per job."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge import rules as R
from jobgauge.functions.documents import resized_document
from jobgauge.functions.runs import one_decimal

CLUSTER = ("driver_size", "worker_size", "num_workers")


def config_changeset(suggestions: DataFrame, existing: DataFrame) -> DataFrame:
    """The configuration document each job should have, from its existing one (job_id, content) if any.

    Of several documents of a job the smallest that is not NULL counts.
    """
    cluster = [F.col(f"suggested_config.{name}") for name in CLUSTER]
    joined = suggestions.join(existing.groupBy("job_id").agg(F.min("content").alias("content")), "job_id", "left")
    return joined.select(
        "job_id",
        F.format_string(R.CONFIG_PATH, "job_id").alias("path"),
        F.col("suggested_config.num_workers").alias("num_workers"),
        resized_document(F.col("content"), F.col("job_id"), F.col("job_name"), *cluster).alias("edited"),
    ).select("job_id", "path", "num_workers", "edited.action", "edited.content")


def hints_documents(suggestions: DataFrame) -> DataFrame:
    """A text per job that has hints."""
    bullets = F.transform("code_changes", lambda hint: F.concat(F.lit(R.HINTS_BULLET), hint, F.lit("\n")))
    return suggestions.filter(F.size("code_changes") > 0).select(
        "job_id",
        F.format_string(R.HINTS_PATH, "job_id").alias("path"),
        F.concat(F.format_string(R.HINTS_HEADER, "job_name"), F.array_join(bullets, "")).alias("content"),
    )


def change_descriptions(suggestions: DataFrame) -> DataFrame:
    """Title and body of the change request of each job."""
    clusters = [F.col(f"{config}.{name}") for config in ("current_config", "suggested_config") for name in CLUSTER]
    average = one_decimal(F.col("avg_runtime"))
    return suggestions.select(
        "job_id",
        F.format_string(R.CHANGE_TITLE, "job_name", "job_id").alias("title"),
        F.format_string(R.CHANGE_BODY, "job_name", *clusters, "recommendation", average, "severity").alias("body"),
    )


def change_request(suggestions: DataFrame, existing: DataFrame) -> DataFrame:
    """Everything a change request of a job consists of: branch, title, body, documents and commit messages."""
    documents = config_changeset(suggestions, existing)
    action = F.col("action")
    message = F.lit(R.COMMIT_TEXTS["create"])
    for name, text in R.COMMIT_TEXTS.items():
        message = F.when(action == name, F.lit(text)).otherwise(message)
    committed = documents.select(
        "job_id",
        F.col("path").alias("config_path"),
        action.alias("config_action"),
        F.col("content").alias("config_content"),
        F.replace(message, F.lit("%s"), F.col("job_id").cast("string")).alias("config_message"),
    )
    hints = hints_documents(suggestions).select(
        "job_id",
        F.col("path").alias("hints_path"),
        F.col("content").alias("hints_content"),
        F.format_string(R.HINTS_COMMIT_TEXT, "job_id").alias("hints_message"),
    )
    return (
        change_descriptions(suggestions)
        .join(branch_names(suggestions), "job_id")
        .join(committed, "job_id")
        .join(hints, "job_id", "left")
    )


def branch_names(suggestions: DataFrame) -> DataFrame:
    """A branch name per job, stamped with the current time."""
    stamp = F.date_format(F.current_timestamp(), "yyyyMMddHHmmss")
    name = F.concat_ws("-", F.lit(R.BRANCH_PREFIX), F.col("job_id").cast("string"), stamp)
    return suggestions.select("job_id", name.alias("branch"))
