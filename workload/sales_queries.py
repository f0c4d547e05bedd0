"""Queries over sales: ingestion, enrichment, rules, totals, writes."""

from pyspark.sql import functions as F

from jobgauge import schemas
from jobgauge.functions.exact import exact_aggregate
from jobgauge.functions.sales import parse_date
from jobgauge.operators import business, ingest, joins, totals
from jobgauge.operators.prefix_sums import with_prefix_sum
from jobgauge.plans.ingestion import run_ingestion
from jobgauge.plans.silver import publish_silver, silver_table
from jobgauge.sources.publish import published
from jobgauge.sources.scratch import scratch_path, written
from jobgauge.sources.tables import read_source
from jobgauge.sources.writers import write_table
from workload.registry import query
from workload.views import SALES_RULES, exact_sum_sql, regions, sales, table, with_sales


def _enriched(spark, sf_dir):
    return joins.lookup(sales(spark, sf_dir), regions(spark, sf_dir), "region_id")


def _as_double(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _source_rows(spark, sf_dir):
    """Events as rows of the sales source: text dates, a region name, mixed-case categories."""
    kind = F.col("event_type")
    number = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("R"), number).alias("region"),
        F.when(kind != "error", F.initcap(kind)).alias("category"),
        "value",
        number.cast("int").alias("region_id"),
    )


SOURCE_SQL = """
source AS (
    SELECT strftime(ts, '%Y-%m-%d') AS date, 'R' || json_extract(props, '$.k')::varchar AS region,
           CASE WHEN event_type <> 'error'
                THEN upper(event_type[1]) || event_type[2:] END AS category,
           "value", json_extract(props, '$.k')::int AS region_id
    FROM events
),
first_regions AS (SELECT region AS ref_region FROM source ORDER BY date, region LIMIT 10),
bronze AS (
    SELECT source.*, strptime(date, '%Y-%m-%d') AS data_date, ref_region, upper(category) AS "CATEGORY_UPPERCASE"
    FROM source, first_regions WHERE "value" > 100
)
"""


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_parquet(spark, sf_dir):
    table(spark, sf_dir, "events")
    return read_source(spark, f"{sf_dir}/events.parquet", "parquet")


@query(f"WITH {SOURCE_SQL} SELECT * FROM source")
def scan_csv(spark, sf_dir):
    """Source rows written as CSV and read back with a schema."""
    path = scratch_path(spark, "csv")
    _source_rows(spark, sf_dir).write.option("header", True).csv(path)
    return read_source(spark, path, "csv", schemas.SALES)


@query(f"WITH {SOURCE_SQL} SELECT * FROM source")
def scan_json(spark, sf_dir):
    """Source rows written as JSON lines and read back with a schema."""
    path = scratch_path(spark, "json")
    _source_rows(spark, sf_dir).write.json(path)
    return read_source(spark, path, "json", schemas.SALES)


@query("SELECT event_id, value FROM events WHERE value > 100")
def filter_pushdown(spark, sf_dir):
    return ingest.filter_min_value(table(spark, sf_dir, "events"), SALES_RULES.ingest_min_value).select(
        "event_id", "value"
    )


@query("SELECT o_orderkey, date_trunc('day', o_orderdate)::timestamp AS data_date FROM orders")
def parse_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select("o_orderkey", parse_date(text).cast("timestamp_ntz").alias("data_date"))


@query("SELECT event_id, upper(event_type) AS category_uppercase FROM events")
def upper_category(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.upper("event_type").alias("category_uppercase"))


@query("""
SELECT event_id, event_type, ref_region
FROM events, (SELECT r_name AS ref_region FROM region ORDER BY r_regionkey LIMIT 10)
""")
def cross_reference(spark, sf_dir):
    region = table(spark, sf_dir, "region")
    paired = ingest.cross_reference(
        table(spark, sf_dir, "events"), region, "r_name", ["r_regionkey"], SALES_RULES.reference_rows, "ref_region"
    )
    return paired.select("event_id", "event_type", "ref_region")


@query(f"WITH {SOURCE_SQL} SELECT * FROM bronze")
def bronze_rows(spark, sf_dir):
    bronze = ingest.transform_sales(_source_rows(spark, sf_dir), SALES_RULES)
    return bronze.drop("processed_timestamp").withColumn("data_date", F.col("data_date").cast("timestamp_ntz"))


@query("""
SELECT count(*) AS row_count,
       count(DISTINCT category) + coalesce(max((category IS NULL)::int), 0) AS distinct_categories,
       0::bigint AS rows_without_date
FROM (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS category FROM events)
""")
def ingest_metrics(spark, sf_dir):
    source = _source_rows(spark, sf_dir)
    return ingest.ingest_metrics(source.withColumn("data_date", parse_date(F.col("date"))))


@query(f"""
WITH {SOURCE_SQL}
SELECT count(*) AS row_count,
       count(DISTINCT category) + coalesce(max((category IS NULL)::int), 0) AS distinct_categories,
       count(*) FILTER (WHERE data_date IS NULL) AS rows_without_date, 2::bigint AS batches, count(*) AS largest_batch
FROM bronze
""")
def bronze_ingest(spark, sf_dir):
    """The whole ingestion job, for two batches, one of them twice: CSV source to partitioned bronze, then its metrics."""
    source_path = scratch_path(spark, "source")
    _source_rows(spark, sf_dir).write.option("header", True).csv(source_path)
    target = scratch_path(spark, "bronze")
    for batch_id in ("first", "second", "second"):
        metrics = run_ingestion(spark, source_path, target, "csv", "batch", rules=SALES_RULES, batch_id=batch_id)
    rows = spark.read.parquet(target).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    batches = rows.agg(F.count(F.lit(1)).alias("batches"), F.max("n").alias("largest_batch"))
    return metrics.withColumns({name: batches.select(name).scalar() for name in batches.columns})


@query("""
SELECT count(DISTINCT date_trunc('month', ts)) AS batches, count(*) AS row_count, count(DISTINCT user_id) AS distinct_users, true AS within_error
FROM events
""")
def distinct_over_batches(spark, sf_dir):
    """Users over batches by month, from a kept sketch per batch: the estimate within four standard errors of the count."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "sketches")
    batches = events.withColumn("batch_id", F.date_format("ts", "yyyy-MM"))
    ingest.batch_sketches(batches, "user_id").write.parquet(path)
    sketches = spark.read.parquet(path)
    exact = events.agg(F.count_distinct("user_id")).scalar()
    counts = ingest.distinct_over_batches(sketches).withColumns(
        {"batches": sketches.agg(F.count(F.lit(1))).scalar(), "distinct_users": exact}
    )
    error = F.abs(F.col("distinct_estimate") - F.col("distinct_users")) / F.col("distinct_users")
    within = error <= 4 * 1.04 / 2 ** (ingest.SKETCH_BITS / 2)
    return counts.select("batches", "row_count", "distinct_users", within.alias("within_error"))


@query("SELECT o_orderkey, o_orderdate, o_totalprice, strftime(o_orderdate, '%B') AS month FROM orders")
def write_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "orders")
    orders = business.add_calendar(table(spark, sf_dir, "orders"), "o_orderdate")
    write_table(orders.select("o_orderkey", "o_orderdate", "o_totalprice", "month"), path)
    return read_source(spark, path, "parquet")


@query("""
SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%B') AS month, year(o_orderdate)::int AS year
FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3
""")
def partition_pruned_scan(spark, sf_dir):
    path = scratch_path(spark, "orders-by-month")
    orders = business.add_calendar(table(spark, sf_dir, "orders"), "o_orderdate")
    write_table(orders.select("o_orderkey", "o_totalprice", "month", "year"), path, partition_by=("year", "month"))
    written = read_source(spark, path, "parquet")
    return written.filter((F.col("year") == 1997) & (F.col("month") == "March"))


@query(with_sales("SELECT id, region_id, region, category, value FROM enriched"))
def region_enrich(spark, sf_dir):
    """Every key of the dimension repeats, without a name and with one that sorts last."""
    dimension = regions(spark, sf_dir)
    for name in (None, "ZZZ"):
        dimension = dimension.union(regions(spark, sf_dir).withColumn("region", F.lit(name)))
    joined = joins.lookup(sales(spark, sf_dir), dimension, "region_id")
    return joined.select("id", "region_id", "region", "category", "value")


@query(with_sales("SELECT id, region_id, region, value FROM enriched"))
def salted_join(spark, sf_dir):
    joined = joins.salted_lookup(
        sales(spark, sf_dir), regions(spark, sf_dir), "region_id", row_key=["id"], salts=8, hot_keys=3
    )
    return joined.select("id", "region_id", "region", "value")


@query(with_sales("SELECT id, region, value FROM enriched WHERE value > 250000"))
def high_value(spark, sf_dir):
    return business.high_value(_enriched(spark, sf_dir), SALES_RULES).select("id", "region", "value")


@query(with_sales("SELECT id, region, value FROM enriched WHERE region IN ('AFRICA', 'ASIA')"))
def priority_regions(spark, sf_dir):
    return business.priority_regions(_enriched(spark, sf_dir), SALES_RULES).select("id", "region", "value")


TAX_SQL = """
taxed AS (
    SELECT *, CASE region WHEN 'AFRICA' THEN 0.08::double WHEN 'AMERICA' THEN 0.07::double
                          WHEN 'ASIA' THEN 0.09::double WHEN 'EUROPE' THEN 0.095::double
                          ELSE 0.10::double END AS tax_rate
    FROM enriched
),
silver AS (
    SELECT *, value * tax_rate AS tax_amount, value + value * tax_rate AS value_with_tax,
           strftime(data_date, '%B') AS month, strftime(data_date, '%Y') AS year
    FROM taxed
)
"""


@query(with_sales(f", {TAX_SQL} SELECT id, region, tax_rate, tax_amount, value_with_tax FROM silver"))
def tax_rules(spark, sf_dir):
    taxed = business.add_tax(_enriched(spark, sf_dir), SALES_RULES)
    return taxed.select("id", "region", "tax_rate", "tax_amount", "value_with_tax")


@query(with_sales(f", {TAX_SQL} SELECT id, data_date, month, year FROM silver"))
def calendar_columns(spark, sf_dir):
    return business.add_calendar(sales(spark, sf_dir)).select("id", "data_date", "month", "year")


SILVER_COLUMNS = (
    "id, data_date, region_id, category, value, region, tax_rate, tax_amount, value_with_tax, month, year"
)


@query(with_sales(f", {TAX_SQL} SELECT {SILVER_COLUMNS} FROM silver"))
def business_rules(spark, sf_dir):
    silver = silver_table(sales(spark, sf_dir), regions(spark, sf_dir), SALES_RULES)
    return silver.select(*SILVER_COLUMNS.split(", "))


@query(with_sales("""
SELECT data_date, region, total AS total_value, avg_value, transaction_count, value_misfits FROM daily
"""))
def daily_agg(spark, sf_dir):
    return totals.daily_totals(_enriched(spark, sf_dir))


@query(with_sales(f"""
SELECT category, count(*) AS count, 0::bigint AS value_misfits, {exact_sum_sql('value')} AS category_total
FROM enriched WHERE category IS NOT NULL GROUP BY category
"""))
def category_metrics(spark, sf_dir):
    return totals.category_metrics(sales(spark, sf_dir))


@query(with_sales("""
SELECT data_date, region, total AS total_value, transaction_count
FROM daily ORDER BY total DESC, data_date, region LIMIT 20
"""))
def top_days(spark, sf_dir):
    top = totals.top_days(totals.daily_totals(_enriched(spark, sf_dir)), 20)
    return top.drop("avg_value", "value_misfits")


@query(f"""
WITH priced AS (SELECT o_orderkey % 97 AS k, o_orderpriority, o_totalprice FROM orders)
SELECT 'huge' AS category, count(*) AS count, 0::bigint AS value_misfits, count(*) * 5e17::double AS category_total
FROM priced WHERE k = 0 HAVING count(*) > 0
UNION ALL SELECT 'tiny', count(*), 0, count(*) * 1e-19::double FROM priced WHERE k = 1 HAVING count(*) > 0
UNION ALL SELECT 'cancelled', 3 * count(*), 0, {exact_sum_sql('o_totalprice')} FROM priced WHERE k = 2 HAVING count(*) > 0
UNION ALL
SELECT o_orderpriority, count(*), count(*) FILTER (k = 3), {exact_sum_sql('o_totalprice / 1e9')} FILTER (k <> 3)
FROM priced WHERE k > 2 AND o_orderpriority IS NOT NULL GROUP BY o_orderpriority
""".replace(f"::varchar::double / {2.0**80!r}::double) FILTER (k <> 3)", f" FILTER (k <> 3)::varchar::double / {2.0**80!r}::double)"))
def exact_totals(spark, sf_dir):
    """Totals of values far apart in size, of some that cancel out, and of some that are no number and only counted."""
    key, price = F.col("o_orderkey") % 97, F.col("o_totalprice")
    values = (
        F.when(key == 0, F.array(F.lit(5e17)))
        .when(key == 1, F.array(F.lit(1e-19)))
        .when(key == 2, F.array(F.lit(1e300), price, F.lit(-1e300)))
        .when(key == 3, F.array(F.lit(float("nan"))))
        .otherwise(F.array(price / 1e9))
    )
    category = F.when(key == 0, "huge").when(key == 1, "tiny").when(key == 2, "cancelled").otherwise(F.col("o_orderpriority"))
    orders = table(spark, sf_dir, "orders").select(category.alias("category"), F.explode(values).alias("value"))
    return totals.category_metrics(orders)


RUNNING_SQL = """
SELECT data_date, region, total AS total_value, avg_value, transaction_count, value_misfits, {running} AS running_total
FROM daily
"""


@query(with_sales(RUNNING_SQL.format(running=exact_sum_sql("total", " OVER (ORDER BY data_date)"))))
def running_total(spark, sf_dir):
    running = totals.with_running_total(totals.daily_totals(_enriched(spark, sf_dir)))
    return running


@query(with_sales(RUNNING_SQL.format(running=exact_sum_sql("total", " OVER (PARTITION BY region ORDER BY data_date)"))))
def running_total_by_region(spark, sf_dir):
    running = totals.with_regional_running_total(totals.daily_totals(_enriched(spark, sf_dir)))
    return running


@query(f"""
SELECT event_id, {exact_sum_sql('value', ' OVER (ORDER BY ts)')} AS running_total,
       {exact_sum_sql('value', ' OVER (PARTITION BY event_type ORDER BY ts)')} AS running_by_type
FROM events
""")
def running_total_by_time(spark, sf_dir):
    """Running totals over full time stamps, of all events and per type, of which there are few."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    running = with_prefix_sum(events, "value", ["ts"], "running_total")
    by_type = with_prefix_sum(written(running, "running-totals"), "value", ["ts"], "running_by_type", ["event_type"])
    return by_type.select("event_id", "running_total", "running_by_type")


@query(with_sales(f""", {TAX_SQL}
SELECT 'main' AS output, region AS label, count(*) AS row_count, {exact_sum_sql('value')} AS total
FROM silver GROUP BY region
UNION ALL
SELECT 'daily_agg', region, count(*), {exact_sum_sql('total')} FROM daily GROUP BY region
UNION ALL
SELECT 'category_metrics', category, count(*), {exact_sum_sql('value')}
FROM silver WHERE category IS NOT NULL GROUP BY category
UNION ALL
SELECT 'export', year || ' ' || month, count(*), {exact_sum_sql('value')} FROM silver GROUP BY ALL
"""))
def silver_build(spark, sf_dir):
    """The whole silver job, checked by row counts and totals of its four outputs, which are published together."""
    bronze_path, region_path = scratch_path(spark, "bronze"), scratch_path(spark, "regions")
    write_table(sales(spark, sf_dir), bronze_path)
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("region"))
    region.write.option("header", True).csv(region_path)
    base = scratch_path(spark, "silver")
    publish_silver(spark, bronze_path, region_path, base, SALES_RULES)
    paths = published(spark, base)

    def totals_of(name, label, value="value"):
        rows = read_source(spark, paths[name], "parquet").withColumn("label", label)
        counts = {"row_count": (F.count(F.lit(1)), F.sum)}
        return exact_aggregate(rows, ["label"], {"total": F.col(value)}, counts).drop("total_count")

    categories = read_source(spark, paths["category_metrics"], "parquet").select(
        F.col("category").alias("label"), F.col("count").alias("row_count"), F.col("category_total").alias("total")
    )
    outputs = {
        "main": totals_of("main", F.col("region")),
        "daily_agg": totals_of("daily_agg", F.col("region"), "total_value"),
        "category_metrics": categories,
        "export": totals_of("export", F.concat_ws(" ", "year", "month")),
    }
    merged = None
    for name, rows in outputs.items():
        labelled = rows.select(F.lit(name).alias("output"), "label", "row_count", F.col("total").cast("double"))
        merged = labelled if merged is None else merged.union(labelled)
    return merged
