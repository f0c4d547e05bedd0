"""Table reads: CSV, Parquet, JSON lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobgauge import schemas

FORMATS = ("csv", "parquet", "json")


def read_source(
    spark: SparkSession, path: str, source_format: str = "csv", schema: StructType | None = None
) -> DataFrame:
    """Read `path` in one of FORMATS.

    With a schema, unparseable CSV and JSON fields become NULL instead of failing the job. CSV headers are checked
    against the schema, because Spark would otherwise assign columns by position.
    """
    if source_format not in FORMATS:
        raise ValueError(f"Unsupported format: {source_format}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if source_format == "csv":
        reader = reader.option("header", True)
        if schema is not None:
            reader = reader.option("enforceSchema", False)
    return reader.format(source_format).load(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Read all batches of bronze files; the source's own region is kept apart from the looked-up one."""
    bronze = spark.read.parquet(path)
    return bronze.withColumnRenamed("region", "src_region").drop("batch_id")


def read_regions(spark: SparkSession, path: str, source_format: str = "csv") -> DataFrame:
    """Read the region dimension as (region_id, region)."""
    regions = read_source(spark, path, source_format, schemas.REGIONS)
    return regions.select(F.col("id").alias("region_id"), "region")
