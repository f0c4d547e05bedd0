"""Analysis history: an append-only table with one row per job and analysis."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgauge import schemas


def append_history(analysis: DataFrame, path: str, batch_id: int, ts: Column | None = None) -> None:
    """Store one snapshot. Writing the same batch again replaces it, so a replayed batch leaves no duplicates."""
    stamp = F.current_timestamp() if ts is None else ts.cast("timestamp")
    snapshot = analysis.select("job_id", stamp.alias("ts"), "avg_runtime", "recommendation")
    snapshot.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.HISTORY).parquet(path)


def partial_rollups(history: DataFrame) -> DataFrame:
    """Per job: number of snapshots, the first and the last; `merged_rollups` puts several such tables together."""
    return history.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.min(F.struct("ts", "batch_id", "avg_runtime")).alias("first"),
        F.max(F.struct("ts", "batch_id", "avg_runtime", "recommendation")).alias("last"),
    )


def merged_rollups(rollups: DataFrame) -> DataFrame:
    return rollups.groupBy("job_id").agg(
        F.sum("snapshots").alias("snapshots"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def history_rollup(history: DataFrame | None = None, rollups: DataFrame | None = None) -> DataFrame:
    """Per job: number of snapshots, first and last average, change, latest recommendation; of snapshots or partial rollups.

    Plain aggregates instead of a list per job, so a long history never has to fit into one row.
    """
    rolled = partial_rollups(history) if rollups is None else merged_rollups(rollups)
    return rolled.select(
        "job_id",
        "snapshots",
        F.col("first.ts").alias("first_ts"),
        F.col("last.ts").alias("last_ts"),
        F.col("first.avg_runtime").alias("first_avg_runtime"),
        F.col("last.avg_runtime").alias("last_avg_runtime"),
        F.col("last.recommendation").alias("recommendation"),
        (F.col("last.avg_runtime") - F.col("first.avg_runtime")).alias("change"),
    )


def history_timeline(history: DataFrame) -> DataFrame:
    """All snapshots, job by job in time order."""
    return history.orderBy("job_id", "ts", "batch_id")
