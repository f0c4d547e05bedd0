"""Fixed schemas of the tables the package reads and writes."""

from pyspark.sql import types as T

RUNS = T.StructType(
    [
        T.StructField("job_id", T.LongType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("configuration", T.StringType()),
        T.StructField("runtime_minutes", T.DoubleType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("output", T.StringType()),
    ]
)

SALES = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("region_id", T.IntegerType()),
    ]
)

REGIONS = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("region", T.StringType()),
    ]
)

HISTORY = T.StructType(
    [
        T.StructField("job_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("avg_runtime", T.DoubleType()),
        T.StructField("recommendation", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Averages of a stream's windows go through this type, so a result never depends on how the rows were split over tasks. It
# holds 20 digits before the point and 18 after it; larger numbers are left out and counted. Other sums have no such range.
WIDE = "decimal(38,18)"
