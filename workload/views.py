"""The test tables seen as sales and job runs, in Spark and in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgauge.rules import AdvisorRules, SalesRules

# The test values are larger than the default limits expect.
SALES_RULES = SalesRules(
    high_value=250_000,
    priority_regions=("AFRICA", "ASIA"),
    tax_rates={"AFRICA": 0.08, "AMERICA": 0.07, "ASIA": 0.09, "EUROPE": 0.095},
)
RUN_RULES = AdvisorRules(min_runs=2, high_minutes=50.0, spike_ratio=6.0, worker_limit=40)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Timestamps without a zone and those with one only compare equal in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customer_region = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(customer_region, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("data_date"),
        F.col("n_regionkey").alias("region_id"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("value"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region"))


def exact_sum_sql(value: str, over: str = "") -> str:
    """The exact sum of doubles below 2^46 or so, rounded once: added as multiples of 2^-80, which all their bits are."""
    unit = f"{2.0**80!r}::double"
    return f"(sum((({value}) * {unit})::hugeint){over}::varchar::double / {unit})"


SALES_SQL = f"""
sales AS (
    SELECT o_orderkey AS id, o_orderdate AS data_date, n_regionkey AS region_id,
           o_orderpriority AS category, o_totalprice AS value
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
),
enriched AS (
    SELECT sales.*, r_name AS region FROM sales LEFT JOIN region ON region_id = r_regionkey
),
daily AS (
    SELECT data_date, region, {exact_sum_sql('value')} AS total, {exact_sum_sql('value')} / count(value) AS avg_value,
           count(*) AS transaction_count, 0::bigint AS value_misfits
    FROM enriched GROUP BY data_date, region
)
"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_runs(table(spark, sf_dir, "events"))


def as_runs(events: DataFrame) -> DataFrame:
    """Events as job runs: the user is the job, the value its minutes, the event type its node type and log."""
    kind, workers = F.col("event_type"), F.col("workers")
    configuration = _concat(
        '{"cluster_config": {"driver_node_type_id": "',
        kind,
        '_driver", "node_type_id": "',
        kind,
        '", "num_workers": ',
        workers,
        "}}",
    )
    seconds = F.floor(F.col("value") * 60).cast("int")
    return events.withColumn("workers", F.get_json_object("props", "$.k")).select(
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("job_id"),
        _concat(kind, "_job").alias("job_name"),
        configuration.alias("configuration"),
        F.col("value").alias("runtime_minutes"),
        F.col("ts").alias("start_time"),
        F.timestamp_add("SECOND", seconds, F.col("ts")).alias("end_time"),
        F.concat_ws(r"\n", *_log_lines(workers)).alias("output"),
    )


def _log_lines(workers):
    kind, value = F.col("event_type"), F.col("value")
    amount = value.cast("decimal(18,2)").cast("string")
    trouble = (
        F.when(kind == "click", "WARN: Tasks waited long for executor scheduling")
        .when(kind == "view", "WARN: The plan holds a cartesian join")
        .when(kind == "signup", "WARN: Join keys show skew")
        .when(kind == "purchase", _concat("WARN: Shuffle spill (memory) of ", amount, " GB and (disk) of 1.5 GB"))
        .when(kind == "error", "ERROR: SparkException: a stage was aborted")
    )
    memory = F.when((kind == "error") & (value > 100), "ERROR: OutOfMemoryError: the heap is full")
    return [
        _concat("INFO: Started ", kind),
        trouble,
        memory,
        _concat("INFO: Processed ", F.format_number(F.col("event_id") * 37 + 1000, 0), " rows"),
        _concat("INFO: Found ", workers, " distinct categories"),
    ]


def _concat(*parts):
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


# The same rendering in SQL.
RUNS_SQL = r"""
rendered AS (
    SELECT *, json_extract(props, '$.k')::int AS k, list_filter([
        'INFO: Started ' || event_type,
        CASE event_type WHEN 'click' THEN 'WARN: Tasks waited long for executor scheduling'
                        WHEN 'view' THEN 'WARN: The plan holds a cartesian join'
                        WHEN 'signup' THEN 'WARN: Join keys show skew'
                        WHEN 'purchase' THEN 'WARN: Shuffle spill (memory) of '
                            || value::decimal(18,2)::varchar || ' GB and (disk) of 1.5 GB'
                        WHEN 'error' THEN 'ERROR: SparkException: a stage was aborted' END,
        CASE WHEN event_type = 'error' AND value > 100 THEN 'ERROR: OutOfMemoryError: the heap is full' END,
        'INFO: Processed ' || format('{:,}', event_id * 37 + 1000) || ' rows',
        'INFO: Found ' || json_extract(props, '$.k')::varchar || ' distinct categories'
    ], lambda x: x IS NOT NULL) AS log_list
    FROM events
),
runs AS (
    SELECT event_id AS run_id, user_id AS job_id, event_type || '_job' AS job_name, event_type AS kind, k,
           value AS runtime_minutes, ts AS start_time, ts + to_seconds(floor(value * 60)::bigint) AS end_time,
           log_list,
           list_filter(['OutOfMemoryError', 'SparkException', 'Error:', 'Exception:'],
                       lambda p: contains(array_to_string(log_list, '\n'), p)) AS errors
    FROM rendered
),
stats AS (
    SELECT job_id, count(*) AS runs,
           EXACT_SUM / count(runtime_minutes) AS avg_runtime,
           max(runtime_minutes) AS max_runtime, min(runtime_minutes) AS min_runtime
    FROM runs WHERE job_id IS NOT NULL GROUP BY job_id
),
latest AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY start_time DESC, run_id DESC) AS n FROM runs
    ) WHERE n = 1
),
earliest AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY start_time, run_id) AS n FROM runs
    ) WHERE n = 1
),
rated AS (
    SELECT s.*, e.job_name, l.kind, l.k, l.errors,
           CASE WHEN avg_runtime > 50 THEN 'long_running'
                WHEN max_runtime > avg_runtime * 6.0::double THEN 'skew'
                ELSE 'acceptable' END AS reason
    FROM stats s JOIN latest l USING (job_id) JOIN earliest e USING (job_id)
    WHERE s.runs >= 2
),
analysis AS (
    SELECT job_id, job_name, avg_runtime, max_runtime, min_runtime,
           kind || '_driver' AS driver_size, kind AS worker_size, k AS num_workers,
           CASE reason WHEN 'long_running' THEN 'Consider increasing cluster size or optimizing code'
                       WHEN 'skew' THEN 'Job has inconsistent performance, check for data skew'
                       ELSE 'Performance acceptable' END
           || CASE WHEN avg_runtime > 50 AND k < 40 THEN '; increase worker count' ELSE '' END
           || CASE WHEN len(errors) > 0 THEN '; fix errors: ' || array_to_string(errors, ', ') ELSE '' END AS recommendation,
           CASE WHEN len(errors) > 0 OR reason = 'long_running' THEN 'HIGH'
                WHEN reason = 'skew' THEN 'MEDIUM' ELSE 'LOW' END AS severity,
           reason
    FROM rated
),
suggestions AS (
    SELECT *,
           CASE WHEN reason = 'long_running' THEN greatest(2, trunc(num_workers * 1.5::double)::int)
                ELSE num_workers END AS suggested_num_workers,
           CASE reason
                WHEN 'long_running' THEN ['Consider using broadcast joins for small tables',
                                          'Evaluate partition count and size',
                                          'Review any UDFs for optimization opportunities']
                WHEN 'skew' THEN ['Add salting for skewed join keys',
                                  'Consider repartitioning before join operations',
                                  'Review any aggregations that might cause skew']
                ELSE [] END AS code_changes,
           CASE severity WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END AS severity_rank
    FROM analysis
)
""".replace("EXACT_SUM", exact_sum_sql("runtime_minutes"))


def with_sales(sql: str) -> str:
    return f"WITH {SALES_SQL} {sql}"


def with_runs(sql: str) -> str:
    return f"WITH {RUNS_SQL} {sql}"
