"""Several tables published together: readers see all tables of one run, or all of the run before.

Each run writes to a folder of its own below `versions`. When all its tables are there, one row is appended to the small
table `manifest`, which readers ask for the newest version. A run that fails leaves that row out, so the former tables stay
what readers get, whole; a reader that has begun on them can finish, as nothing is overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "sequence bigint, version string, tables array<string>, published_at timestamp"


def read_manifest(spark: SparkSession, base_path: str) -> DataFrame:
    """One row per published version; empty where nothing was published yet."""
    try:
        return spark.read.schema(MANIFEST).json(f"{base_path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def published(spark: SparkSession, base_path: str) -> dict[str, str]:
    """The paths of the newest version's tables, by name; none where nothing was published yet.

    Of two runs that were published at the same time, and so have one number, the version with the larger name counts.
    """
    newest = read_manifest(spark, base_path).agg(F.max(F.struct("sequence", "version", "tables")).alias("newest")).first().newest
    return {name: f"{base_path}/versions/{newest.version}/{name}" for name in newest.tables} if newest else {}


def publish_tables(spark: SparkSession, base_path: str, write: Callable[[str], Iterable[str]]) -> dict[str, str]:
    """Publish what `write` puts below the folder it is given, and return the paths by the names that it returns.

    Nothing is published where `write` raises or returns no name. The row of the manifest is one file, which Spark's commit
    moves into place whole.
    """
    version = uuid.uuid4().hex
    names = sorted(write(f"{base_path}/versions/{version}"))
    if not names:
        return {}
    last = read_manifest(spark, base_path).agg(F.max("sequence")).first()[0]
    row = spark.range(0, 1, 1, 1).select(
        F.lit((last or 0) + 1).cast("bigint").alias("sequence"),
        F.lit(version).alias("version"),
        F.array(*map(F.lit, names)).alias("tables"),
        F.current_timestamp().alias("published_at"),
    )
    row.write.mode("append").json(f"{base_path}/manifest")
    return {name: f"{base_path}/versions/{version}/{name}" for name in names}
